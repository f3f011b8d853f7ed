import math
import random
from collections import Counter

import pytest

from assaysift.llm import lm_score


def brute(texts, order, backoff=0.4):
    docs = [(t or "").lower().split() for t in texts]
    counts = [Counter(tuple(d[i : i + k]) for d in docs for i in range(len(d) - k + 1)) for k in range(1, order + 1)]
    total = sum(map(len, docs))
    out = []
    for d in docs:
        own = [Counter(tuple(d[i : i + k]) for i in range(len(d) - k + 1)) for k in range(1, order + 1)]
        other = lambda g: counts[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: E731, B023

        def score(gram):
            if len(gram) == 1:
                return min(1.0, max(other(gram), 0.5) / max(1, total - len(d)))  # noqa: B023
            return other(gram) / other(gram[:-1]) if other(gram) > 0 else backoff * score(gram[1:])  # noqa: B023

        logs = [math.log(score(tuple(d[max(0, i - order + 1) : i + 1]))) for i in range(len(d))]
        out.append((len(d), sum(logs)))
    return out


@pytest.mark.parametrize(("order", "chars"), [(1, 10**9), (2, 400), (3, 1000), (3, 10**9)])
def test_scores_equal_brute_force(spark, order, chars):
    rng = random.Random(order)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "é"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 30, 80]))) for _ in range(60)]
    texts += [None, "", "  ", texts[5], texts[5], "once", "w1 " * 300]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, block string").repartition(3)
    got = {r.doc_id: r for r in lm_score.lm_scores(df, order=order, block_chars=chars, bucket_chars=chars).collect()}
    for i, (n, total) in enumerate(brute(texts, order)):
        assert got[i].n_words == n and got[i].log_score == pytest.approx(total)
        assert got[i].per_word == (pytest.approx(total / n) if n else None)


def test_empty_table_and_null_keys(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert [round(r.log_score, 6) for r in lm_score.lm_scores(df).collect()] == [round(math.log(0.5), 6)] * 3
    assert lm_score.lm_scores(df.limit(0)).count() == 0
