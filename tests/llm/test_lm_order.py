import pytest
from test_lm_score import brute

from assaysift.llm import lm_score


def test_the_registered_query_scores_two_words_of_context(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in lm_score.op2_lm_scoring(spark, sf).collect()}
    assert len(got) == len(rows)
    for row, (n, total) in zip(rows, brute([r.text for r in rows], 3), strict=True):
        assert got[row.doc_id].n_words == n and got[row.doc_id].log_score == pytest.approx(total)
