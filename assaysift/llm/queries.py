"""The queries of the numbered operators and of the pipeline, and the SQL they can be checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import alignment, boosting, codebooks, decontaminate, forest, language, licenses, lm_score, ngram_join, packing, tokens, toxicity, warc

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_lm_scoring": lm_score.op2_lm_scoring,
        "op3_best_fit_packing": packing.op3_best_fit_packing,
        "op4_language_id": language.op4_language_id,
        "op5_license_scan": licenses.op5_license_scan,
        "op6_ngram_jaccard_join": ngram_join.op6_ngram_jaccard_join,
        "op7_token_counts": tokens.op7_token_counts,
        "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
        "op9_warc": warc.op9_warc,
        "op10_embedding_near_dedup": forest.op10_embedding_near_dedup,
        "op11_cross_tokenizer_alignment": alignment.op11_cross_tokenizer_alignment,
        "op12_quality_classifier": boosting.op12_quality_classifier,
        "op13_vector_code_compression": codebooks.op13_vector_code_compression,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_ngram_jaccard_join": ngram_join.ORACLE_SQL,
        "op8_benchmark_decontamination": decontaminate.ORACLE_SQL,
        "op9_warc": warc.ORACLE_SQL,
        "op10_embedding_near_dedup": forest.ORACLE_SQL,
        "op13_vector_code_compression": codebooks.ORACLE_SQL,
    }
