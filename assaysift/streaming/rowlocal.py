"""Harmonise, convert and check a stream of raw rows.

These operators look at one row at a time, so they run unchanged on a streaming frame that
brings its own row key. Duplicate detection compares rows without any time bound; run it
on the stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import headers, units, validate
from ..schema import ROW_KEY
from ..sources.vocab import RuleSet, Vocabulary


def clean_stream(
    stream: DataFrame,
    vocab: Vocabulary | None = None,
    rules: RuleSet | None = None,
    keys: Sequence[str] = ROW_KEY,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cleaned rows, corrections, physics flags) of a stream; each has its own sink in append mode."""
    columns = [c for c in stream.columns if c not in keys]
    plan = headers.plan_headers(stream.sparkSession, columns, vocab)
    normalised = units.normalise_units(headers.harmonise(stream, vocab, keys, plan))
    cleaned = units.cleaned_table(normalised)
    return cleaned, units.correction_log(normalised, keys), validate.physics_flags(cleaned, rules, keys)
