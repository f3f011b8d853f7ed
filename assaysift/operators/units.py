"""Number parsing and unit conversion over the numeric fields of a harmonised table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import column, is_numeric, or_empty
from ..functions.units import (
    CONVERSIONS,
    MEDIUM,
    NUMERIC_FIELDS,
    conversion_code,
    conversions_for,
    converted,
    first_number,
    number_of,
    parse_number,
)
from ..schema import CORRECTION_COLUMNS, ROW_KEY

# Trace columns of ``normalise_units``: rule that changed a cell, and its source text.
RULE, SOURCE = "_rule_", "_source_"


def numeric_columns(df: DataFrame) -> list[str]:
    """The numeric fields a table has, in table order. ``__duplicate_n`` columns are not among them."""
    return [c for c in df.columns if c in NUMERIC_FIELDS]


def normalise_units(df: DataFrame) -> DataFrame:
    """Turn the numeric fields into doubles; ``_rule_*`` and ``_source_*`` trace what was converted.

    Row-local projections, no shuffle. Each step is its own projection so that a number is
    searched once per cell, and the generated code stays in small methods. Rows, order and
    other columns are untouched; trace cells are null where nothing was converted.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = numeric_columns(df)
    traced = [f for f in numeric if conversions_for(f)]
    text = [f for f in numeric if not is_numeric(types[f])]
    found = df.withColumns({f"_found_{f}": first_number(column(f)) for f in text})
    parsed = found.withColumns(
        {f"_num_{f}": number_of(F.col(f"_found_{f}")) if f in text else parse_number(column(f), types[f]) for f in numeric}
    )
    coded = parsed.withColumns(
        {RULE + f: conversion_code(f, column(f).cast("string"), F.col(f"_num_{f}")) for f in traced}
    )

    def value(f: str) -> Column:
        return converted(f, F.col(f"_num_{f}"), F.col(RULE + f)) if f in traced else F.col(f"_num_{f}")

    return coded.select(
        *[value(c).alias(c) if c in numeric else column(c) for c in df.columns],
        *[RULE + f for f in traced],
        *[F.when(F.col(RULE + f).isNotNull(), column(f).cast("string")).alias(SOURCE + f) for f in traced],
    )


def traced_fields(normalised: DataFrame) -> list[str]:
    return [c[len(RULE) :] for c in normalised.columns if c.startswith(RULE)]


def cleaned_table(normalised: DataFrame) -> DataFrame:
    return normalised.drop(*[t + f for f in traced_fields(normalised) for t in (RULE, SOURCE)])


def _by_rule(attribute: str, code: Column) -> Column:
    out = None
    for rule in CONVERSIONS:
        text = F.lit(getattr(rule, attribute))
        out = F.when(code == rule.code, text) if out is None else out.when(code == rule.code, text)
    return out


def correction_log(normalised: DataFrame, keys: Sequence[str] = ROW_KEY) -> DataFrame:
    """One row per automatic change, with the source text next to the new value.

    Besides the contract columns it carries ``field_pos``, the position of the field in
    the table, so that the log can be put in detection order.
    """
    ids = [or_empty(column(c)) if c in normalised.columns else F.lit("") for c in ("paper_id", "sample_id")]
    numeric = numeric_columns(normalised)
    traced = traced_fields(normalised)

    def entry(f: str) -> Column:
        made = F.struct(
            F.lit(f).alias("field"),
            F.col(SOURCE + f).alias("original_value"),
            column(f).alias("cleaned_value"),
            F.col(RULE + f).alias("rule"),
            F.lit(numeric.index(f)).alias("field_pos"),
        )
        return F.when(F.col(RULE + f).isNotNull(), made)

    made = [entry(f) for f in traced] or [
        F.lit(None).cast("struct<field:string,original_value:string,cleaned_value:double,rule:string,field_pos:int>")
    ]
    listed = normalised.select(*[column(k) for k in keys], ids[0].alias("_paper"), ids[1].alias("_sample"), F.array(*made).alias("_made"))
    entries = listed.select(
        *[column(k) for k in keys], F.col("_paper").alias("paper_id"), F.col("_sample").alias("sample_id"), F.explode_outer("_made").alias("t")
    ).where("t IS NOT NULL")
    rule = F.col("t.rule")
    return entries.select(
        *[column(k) for k in keys],
        "paper_id",
        "sample_id",
        "t.field",
        "t.original_value",
        "t.cleaned_value",
        _by_rule("kind", rule).alias("correction_type"),
        _by_rule("confidence", rule).alias("confidence"),
        _by_rule("reason", rule).alias("reason"),
        "t.field_pos",
    )


def correction_columns(keys: Sequence[str] = ROW_KEY) -> list[str]:
    return [*keys, *CORRECTION_COLUMNS[1:]]


def corrections_preview(log: DataFrame, keys: Sequence[str] = ROW_KEY, n: int = 50) -> DataFrame:
    """The first corrections field by field, in table order (a top-n report, not a sample)."""
    return log.orderBy("field_pos", *[column(k) for k in keys]).limit(n)


def unit_summary(normalised: DataFrame) -> DataFrame:
    """One row: rows, numeric fields, corrections, medium-confidence corrections. One pass, no explode."""
    medium = [rule.code for rule in CONVERSIONS if rule.confidence == MEDIUM]
    rules = [F.col(RULE + f) for f in traced_fields(normalised)]
    made = sum((r.isNotNull().cast("int") for r in rules), F.lit(0))
    unsure = sum((F.coalesce(r.isin(*medium), F.lit(False)).cast("int") for r in rules), F.lit(0))
    return normalised.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(numeric_columns(normalised))).alias("n_numeric_fields"),
        F.coalesce(F.sum(made), F.lit(0)).alias("n_corrections"),
        F.coalesce(F.sum(unsure), F.lit(0)).alias("n_medium_confidence_corrections"),
    )


def correction_type_counts(log: DataFrame, keys: Sequence[str] = ROW_KEY) -> DataFrame:
    """Corrections per type, most frequent first, ties by first appearance."""
    ranked = counted_correction_types(log)
    return ranked.orderBy(F.desc("n"), "first").drop("first")


def counted_correction_types(log: DataFrame) -> DataFrame:
    """(correction_type, n, first field with it), in no order."""
    per_field = log.groupBy("correction_type", "field_pos").agg(F.count("*").alias("n"))
    return per_field.groupBy("correction_type").agg(F.sum("n").alias("n"), F.min("field_pos").alias("first"))
