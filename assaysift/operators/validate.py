"""Physics-aware checks: bounds and missing context, as flags. Row-local, no shuffle."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import column, fmt6g, is_floating, is_missing, is_numeric, number_text, strip, text_or_blank
from ..schema import FLAG_COLUMNS, FLAG_EXTRAS, P0, P1, P2, ROW_KEY, SEQ_ENGINEERING, SEQ_RECOMMENDED
from ..sources.vocab import Bounds, RuleSet, rule_table

# Fields needed to compare devices.
ENGINEERING_FIELDS = ("mass_loading_mg_cm2", "electrode_thickness_um", "compacted_density_g_cm3")

# (limit, code, risk, words, action), in checking order: at most one per cell.
BREACHES = (
    ("hard_min", "below_hard_min", P0, "below what is physically possible", "leave the value out until its source is found to say so"),
    ("hard_max", "above_hard_max", P0, "above what is physically possible", "suspect a lost unit or a misread digit before anything else"),
    ("soft_min", "below_soft_min", P1, "lower than samples usually are", "a rare sample or a slip: record which"),
    ("soft_max", "above_soft_max", P1, "higher than samples usually are", "a rare sample or a slip, such as cells moved by a row: record which"),
)

_PLAIN_FLOAT = r"^[-+]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?|(?i:inf|infinity))$"


def number_or_null(c: Column, dtype: T.DataType) -> Column:
    """Value of a ruled cell; null for missing cells, text that is no number, and NaN."""
    if is_floating(dtype):
        return F.when(~F.isnan(c), c.cast("double"))
    if is_numeric(dtype):
        return c.cast("double")
    text = strip(c)
    return F.when(text.rlike(_PLAIN_FLOAT), text.try_cast("double"))


def breach(value: Column, bounds: Bounds) -> Column:
    """Position in ``BREACHES`` of the first limit the value breaks, or null. A bound itself passes."""
    code = None
    for i, (limit, *_rest) in enumerate(BREACHES):
        bound = getattr(bounds, limit)
        if bound is not None:
            hit = value < float(bound) if limit.endswith("min") else value > float(bound)
            code = F.when(hit, F.lit(i)) if code is None else code.when(hit, F.lit(i))
    return F.lit(None).cast("int") if code is None else code


def missing_mask(df: DataFrame, fields: Sequence[str], keys: Sequence[str] = ROW_KEY) -> DataFrame:
    """Row key and one boolean per listed field that the table has."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[column(k) for k in keys], *[is_missing(column(f), types[f]).alias(f) for f in fields if f in types]
    )


def _texts(values: Sequence[str]) -> Column:
    """Literal lookup array, folded to a constant when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(list(values), ensure_ascii=False)), "array<string>")


def physics_flags(df: DataFrame, rules: RuleSet | None = None, keys: Sequence[str] = ROW_KEY) -> DataFrame:
    """All bound and missing-field flags of a cleaned table.

    Each row builds one small array of (check, limit, value) and explodes what it has to
    report; texts are added to the reported entries only. Checks for absent columns are
    left out when the plan is built.
    """
    rules = rules or RuleSet()
    types = {f.name: f.dataType for f in df.schema.fields}
    ruled = [(i, f, b) for i, (f, b) in enumerate(rules.bounds.items()) if f in types]
    recommended = [(SEQ_RECOMMENDED + i, f) for i, f in enumerate(rules.recommended) if f in types]
    engineering = [(SEQ_ENGINEERING + i, f) for i, f in enumerate(ENGINEERING_FIELDS) if f in types]

    ids = [text_or_blank(column(c), types[c]) if c in types else F.lit("") for c in ("paper_id", "sample_id")]
    base = df.select(
        *[column(k) for k in keys],
        ids[0].alias("_paper"),
        ids[1].alias("_sample"),
        *[number_or_null(column(f), types[f]).alias(f"_v{i}") for i, f, _ in ruled],
        *[is_missing(column(f), types[f]).alias(f"_m{seq}") for seq, f in [*recommended, *engineering]],
    ).withColumns({f"_b{i}": breach(F.col(f"_v{i}"), b) for i, _, b in ruled})

    def entry(seq: int, limit: Column, value: Column) -> Column:
        return F.struct(F.lit(seq).alias("seq"), limit.cast("int").alias("limit"), value.cast("double").alias("v"))

    none = F.lit(None)
    checks = [F.when(F.col(f"_b{i}").isNotNull(), entry(i, F.col(f"_b{i}"), F.col(f"_v{i}"))) for i, _, _ in ruled]
    checks += [F.when(F.col(f"_m{seq}"), entry(seq, none, none)) for seq, _ in [*recommended, *engineering]]
    if not checks:
        checks = [F.lit(None).cast("struct<seq:int,limit:int,v:double>")]
    # The array is made by a projection, in compiled code; inside the generator it would be interpreted.
    # An outer generator, since from a plain one Spark infers a filter that makes the array a second time.
    listed = base.select(*[column(k) for k in keys], "_paper", "_sample", F.array(*checks).alias("_checks"))
    found = listed.select(*[column(k) for k in keys], "_paper", "_sample", F.explode_outer("_checks").alias("c")).where("c IS NOT NULL")

    seq, limit, value = F.col("c.seq"), F.col("c.limit"), F.col("c.v")
    is_range = limit.isNotNull()
    is_recommended = seq < SEQ_ENGINEERING
    gap_fields = _texts(rules.recommended), _texts(ENGINEERING_FIELDS)
    bounds = list(rules.bounds.items())
    field = (
        F.when(is_range, F.get(_texts([f for f, _ in bounds]), seq))
        .when(is_recommended, F.get(gap_fields[0], seq - SEQ_RECOMMENDED))
        .otherwise(F.get(gap_fields[1], seq - SEQ_ENGINEERING))
    )
    bound_text = F.get(
        _texts([_number_text(getattr(b, limit_)) for _, b in bounds for limit_, *_ in BREACHES]), seq * len(BREACHES) + limit
    )
    per_limit = {part: F.get(_texts([b[at] for b in BREACHES]), limit) for at, part in enumerate(("", "code", "risk", "words", "action")) if at}
    unit = F.get(_texts([b.unit for _, b in bounds]), seq)
    range_reason = F.concat(field, F.lit(" = "), fmt6g(value), F.lit(" "), unit, F.lit(" is "), per_limit["words"], F.lit(" "), bound_text)
    gap_reason = F.when(is_recommended, F.concat(F.lit("no "), field, F.lit(": the row is hard to trace back"))).otherwise(
        F.concat(F.lit("no "), field, F.lit(": devices cannot be compared"))
    )
    gap_action = F.when(is_recommended, F.lit("name the place the row was taken from")).otherwise(
        F.lit("look for how the electrode was made")
    )
    gap_code = F.when(is_recommended, F.lit("missing_recommended")).otherwise(F.lit("missing_engineering"))
    return found.select(
        *[column(k) for k in keys],
        F.col("_paper").alias("paper_id"),
        F.col("_sample").alias("sample_id"),
        field.alias("field"),
        F.coalesce(number_text(value), F.lit("")).alias("value"),
        F.when(is_range, per_limit["risk"]).otherwise(F.lit(P2)).alias("risk_level"),
        F.when(is_range, range_reason).otherwise(gap_reason).alias("reason"),
        F.when(is_range, per_limit["action"]).otherwise(gap_action).alias("required_action"),
        F.when(is_range, per_limit["code"]).otherwise(gap_code).alias("rule_code"),
        value.alias("value_num"),
        seq.alias("flag_seq"),
    )


def _number_text(v: float | None) -> str:
    return "" if v is None else str(v)


def flag_columns(keys: Sequence[str] = ROW_KEY) -> list[str]:
    """Contract columns of a flag, then the own additions."""
    return [*keys, *FLAG_COLUMNS[1:], *FLAG_EXTRAS]


def range_breaches_by_rule_table(
    df: DataFrame, rules: RuleSet | None = None, keys: Sequence[str] = ROW_KEY
) -> DataFrame:
    """The bound checks with the rules as a table: values long, then a broadcast equi-join on the field.

    Same result as the literal form of ``physics_flags``; for rule sets that are edited as
    data. The rule table is bounded by the rule file.
    """
    rules = rules or RuleSet()
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [
        F.struct(F.lit(f).alias("field"), number_or_null(column(f), types[f]).alias("value_num"))
        for f in rules.bounds
        if f in types
    ]
    if not values:
        values = [F.lit(None).cast("struct<field:string,value_num:double>")]
    listed = df.select(*[column(k) for k in keys], F.array(*values).alias("_values"))
    long = listed.select(*[column(k) for k in keys], F.inline_outer("_values")).where(F.col("value_num").isNotNull())
    joined = long.join(F.broadcast(rule_table(df.sparkSession, rules)), "field")
    code = (
        F.when(F.col("value_num") < F.col("hard_min"), F.lit(0))
        .when(F.col("value_num") > F.col("hard_max"), F.lit(1))
        .when(F.col("value_num") < F.col("soft_min"), F.lit(2))
        .when(F.col("value_num") > F.col("soft_max"), F.lit(3))
    )
    return (
        joined.withColumn("_b", code)
        .where(F.col("_b").isNotNull())
        .select(
            *[column(k) for k in keys],
            "field",
            "value_num",
            F.get(_texts([b[2] for b in BREACHES]), F.col("_b")).alias("risk_level"),
            F.get(_texts([b[1] for b in BREACHES]), F.col("_b")).alias("rule_code"),
            F.col("ord").alias("flag_seq"),
        )
    )
