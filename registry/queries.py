"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysift.functions import headers as header_functions
from assaysift.functions.text import column, fmt6g
from assaysift.functions.units import NUMERIC_FIELDS, normalize_value, parse_number, unit_text
from assaysift.operators import audit, duplicates, headers, outliers, slips, unit_fit, units, validate
from assaysift.plans import report
from assaysift.schema import SEQ_DUPLICATE
from assaysift.sources import sinks
from assaysift.sources.scratch import materialise, materialise_result, run_folder, scratch_folder
from assaysift.sources.tables import read_table
from assaysift.sources.vocab import Bounds, RuleSet

from .inputs import BASE_COLUMNS, COPY_KEYS, KEYS, PADDED, RAW, header_catalogue, raw_cells, raw_extract, raw_extract_copies, table

Query = Callable[[SparkSession, str], DataFrame]
_PLANS: dict[tuple[str, ...], headers.HeaderPlan] = {}


def _harmonised(raw: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    names = tuple(c for c in raw.columns if c not in keys)
    if names not in _PLANS:
        _PLANS[names] = headers.plan_headers(raw.sparkSession, names)
    return headers.harmonise(raw, keys=keys, plan=_PLANS[names])


def harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _harmonised(raw_extract(spark, sf_dir), KEYS)


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.normalise_units(harmonised(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.cleaned_table(normalised(spark, sf_dir))


def cleaned_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.cleaned_table(units.normalise_units(_harmonised(raw_extract_copies(spark, sf_dir), COPY_KEYS)))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flags; the cleaned table is stored first because three branches read it, as in the pipeline."""
    return _flags_of(materialise(duplicates.placed(cleaned(spark, sf_dir)), "cleaned"))


def _flags_of(table_: DataFrame) -> DataFrame:
    return audit.all_flags(validate.physics_flags(table_, keys=KEYS), duplicates.duplicate_flags(table_, KEYS))


def stored_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Normalised table, flags and correction log for queries that need all three; cells are parsed once, as in the pipeline."""
    n = materialise(duplicates.placed(normalised(spark, sf_dir)), "normalised")
    return n, _flags_of(units.cleaned_table(n)), units.correction_log(n, KEYS)


# Own wording is left out of the comparison; codes, levels, keys and values are in.
FLAG_OUT = ("paper_id", "sample_id", "field", "risk_level", "rule_code", "value_num", "flag_seq")


def _flag_view(df: DataFrame, keys: tuple[str, ...] = KEYS, *extra: Column | str) -> DataFrame:
    return df.select(*keys, *FLAG_OUT, *extra)


def _parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harmonised(spark, sf_dir)
    return h.select(*KEYS, *[parse_number(F.col(f)).alias(f) for f in NUMERIC_FIELDS if f in h.columns])


def _parse_number_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", parse_number(F.col("text")).alias("first_number"))


def _unit_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harmonised(spark, sf_dir)
    return h.select(*KEYS, *[unit_text(F.col(f)).alias(f) for f in ("BET_m2_g", "d002_nm", "current_density_A_g", "ID_IG")])


def _unit_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(unit_text(F.col("text"))).alias("unit_text_md5"))


def _convert(*fields: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        h = harmonised(spark, sf_dir)
        out = h.select(*KEYS, *[F.col(f).alias(f"{f}_text") for f in fields], *[normalize_value(f, F.col(f)).alias(f) for f in fields])
        return out.select(
            *KEYS,
            *[f"{f}_text" for f in fields],
            *[F.col(f"{f}.value").alias(f"{f}_value") for f in fields],
            *[F.col(f"{f}.code").alias(f"{f}_rule") for f in fields],
        )

    return run


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.correction_log(normalised(spark, sf_dir), KEYS)


def _corrections_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).drop("reason")


def _corrections_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units.corrections_preview(_log(spark, sf_dir), KEYS).drop("reason")


MASKED = ("paper_id", "sample_id", "sample_name", "source_location", "mass_loading_mg_cm2", "ICE_pct")


def _missing_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.missing_mask(cleaned(spark, sf_dir), MASKED, KEYS)


def _physics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.physics_flags(cleaned(spark, sf_dir), keys=KEYS)


def _bounds(prefix: str) -> Query:
    codes = [b[1] for b in validate.BREACHES if b[0].startswith(prefix)]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _physics(spark, sf_dir).where(F.col("rule_code").isin(*codes)).select(*KEYS, "field", "value_num", "value", "rule_code")

    return run


def _detector(number: int) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table_ = (cleaned_copies if number == duplicates.NEAR else cleaned)(spark, sf_dir)
        keys = COPY_KEYS if number == duplicates.NEAR else KEYS
        columns = [column(c) for c in (*keys, *duplicates.compared_columns(table_.columns, (number,)))]
        keyed = duplicates.duplicate_keys(materialise(table_.select(*columns), "compared"), keys, (number,))
        hits = duplicates.rows_with_repeated_key(keyed, keys)
        return hits.select(*keys, "key", "key2")

    return run


def _norm_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.duplicate_keys(cleaned(spark, sf_dir), KEYS).select(*KEYS, "detector", "key", "key2")


def _duplicate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialise(duplicates.placed(cleaned_copies(spark, sf_dir)), "cleaned")
    return _flag_view(duplicates.duplicate_flags(stored, COPY_KEYS), COPY_KEYS, "value")


def _review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.ranked_review_queue(materialise_result(spark, lambda: _flag_view(flags(spark, sf_dir)), "flags"), KEYS)


def _paper_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_view(outliers.paper_outliers(materialise(cleaned(spark, sf_dir), "cleaned"), KEYS), KEYS, "value")


# Units that don't fit or are none, put in the place of some capacities and surface areas.
MISFITS = {
    "capacity_mAh_g": "case when p % 7 = 0 then concat(q, ' F/g') when p % 11 = 0 then concat(q, ' bits/g') when p % 13 = 0 then concat(q, ' C g^-1') "
    "else capacity_mAh_g end",
    "BET_m2_g": "case when s % 7 = 0 then concat(q, '±', n, ' m²·g⁻1') when s % 9 = 0 then concat(q, ' m2/cm3') else BET_m2_g end",
    "ID_IG": "case when n = 3 then concat(ID_IG, ' nm') else ID_IG end",
}


def _with_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "lineitem").selectExpr(*BASE_COLUMNS).selectExpr("*", PADDED)
    named = base.select(*KEYS, "q", *[F.expr(text).alias(c) for c, text in RAW.values()])
    return named.select(*KEYS, *[F.expr(MISFITS.get(c, c)).alias(c) for c, _ in RAW.values()])


def _unit_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_view(unit_fit.unit_flags(materialise(_with_misfits(spark, sf_dir), "misfits"), KEYS), KEYS, "value")


def _unit_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unit_fit.unit_table(unit_fit.cell_units(_with_misfits(spark, sf_dir), KEYS))
    return found.select("field_pos", "unit", "n", "dimension", F.round(F.log10("factor"), 9).alias("log_factor"), (F.col("dimension") == F.col("expected")).alias("fits"))


# Sample names with slips, one more spelling each seventh order.
SPELLED = (
    "case k % 7 when 0 then concat('Hard carbon ', p % 40) when 1 then concat('hard carbn ', p % 40) when 2 then concat('hardd  carbon ', p % 40) "
    "when 3 then concat('soft carbon ', p % 40) when 4 then concat('hord carbon ', p % 40) when 5 then 'n/a' else concat('HC', p % 4) end"
)


def _spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "lineitem").selectExpr(*BASE_COLUMNS)
    texts = {c: text for c, text in RAW.values()} | {"sample_name": SPELLED}
    return materialise(base.select(*KEYS, *[F.expr(texts[c]).alias(c) for c in ("paper_id", "sample_id", "sample_name")]), "spelled")


def _name_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slips.name_classes(_spelled(spark, sf_dir), KEYS)


def _name_slips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flag_view(slips.name_slips(_spelled(spark, sf_dir), KEYS), KEYS, "value")


def _header_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_catalogue(spark, sf_dir).withColumn("header_text", header_functions.header_text(F.col("raw_header")))


def _header_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelled = headers.with_spellings(header_catalogue(spark, sf_dir))
    return spelled.withColumn("candidates", F.array_join("spellings", "|")).drop("spellings")


def _header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headers.map_headers(header_catalogue(spark, sf_dir))


def _duplicate_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = headers.duplicate_targets(_header_map(spark, sf_dir))
    return out.withColumn("raw_headers", F.array_join("raw_headers", ", "))


def _schema_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = headers.schema_state(_header_map(spark, sf_dir))
    listed = F.transform(
        F.map_entries("duplicate_canonical_mappings"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))
    )
    return state.select(
        "table_id",
        "summary.*",
        F.array_join("unknown_columns", "|").alias("unknown_columns"),
        F.array_join(listed, "|").alias("duplicate_mappings"),
        F.array_join("missing_recommended_fields", "|").alias("missing_fields"),
        F.size("warnings").alias("n_warnings"),
        F.size("column_map").alias("n_column_map"),
    )


def _cells_to_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = headers.cells_to_wide(raw_cells(spark, sf_dir), row_key=KEYS)
    return wide.withColumn("n_other", F.size("other")).drop("other")


def _union_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = harmonised(spark, sf_dir)
    parts = [h.select(*KEYS, "paper_id", "BET_m2_g"), h.select(*KEYS, "paper_id", "capacity_mAh_g")]
    return headers.union_tables(parts)


def _fmt6g(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("s"),
        F.col("l_linenumber").alias("n"),
        fmt6g(price).alias("price"),
        fmt6g(price * (1 - discount) * (1 + tax)).alias("charge"),
        fmt6g(discount / 1000).alias("small"),
        fmt6g(price * 1e6).alias("large"),
        fmt6g(-price / 7).alias("negative"),
    )


def _run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, found, log = stored_run(spark, sf_dir)
    rows = n.agg(F.count("*").alias("n_rows"))
    plan = next(p for names, p in _PLANS.items() if names == tuple(RAW))
    return report.run_totals(found, log, rows, plan)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report.manifest(_run_totals(spark, sf_dir), "lineitem", ["cleaned_database", "flagged_records"])
    return out.withColumn("outputs", F.array_join("outputs", ",")).drop("version")


def _report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found, log = stored_run(spark, sf_dir)
    plan = next(p for names, p in _PLANS.items() if names == tuple(RAW))
    totals = table(spark, sf_dir, "lineitem").agg(
        F.count("*").alias("n_rows"), F.lit(len(plan.raw)).alias("n_raw_columns"), F.lit(len(plan.unknown)).alias("n_unknown_columns")
    )
    found = materialise(_flag_view(found), "flags")  # several sections read them, none their texts
    return report.report_rows(found, log, totals, KEYS)


def _fresh(spark: SparkSession, kind: str) -> str:
    return f"{scratch_folder(spark).rstrip('/')}/query-{uuid.uuid4().hex}.{kind}"


def _numbers(df: DataFrame, *rest: Column | str) -> DataFrame:
    return df.select(*[F.col(k).cast("bigint").alias(k) for k in KEYS], *rest)


def _csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one folder with their columns in different orders, and one column that only some have."""
    path, raw = _fresh(spark, "csv"), raw_extract(spark, sf_dir)
    orders = ([*KEYS, "paper", "BET"], ["BET", *KEYS[::-1], "paper"], ["paper", "extra", *KEYS, "BET"])
    for i, names in enumerate(orders):
        part = raw.where(F.col("p") % 3 == i).withColumn("extra", F.concat(F.lit("x"), F.col("p")))
        sinks.write_table(part.select(*names), f"{path}/part{i}", "csv")
    back = read_table(spark, f"{path}/*", fmt="csv", multi_line=False)
    return _numbers(back, F.col("paper").alias("paper_id"), F.col("BET").alias("BET_m2_g"), "extra")


def _txt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "txt")
    sinks.write_table(raw_extract(spark, sf_dir).select(*KEYS, "paper", "d002"), path, "csv")
    return _numbers(read_table(spark, path), F.col("paper").alias("paper_id"), F.col("d002").alias("d002_nm"))


def _flags_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags as the pipeline writes them, read back."""
    path = _fresh(spark, "parquet")
    names = [*KEYS, "paper_id", "sample_id", "field", "value", "risk_level"]
    own = F.when(F.col("flag_seq") < SEQ_DUPLICATE, F.col("value"))  # values of the duplicate flags: query duplicate_flags
    with run_folder(spark):
        sinks.write_table(flags(spark, sf_dir).withColumn("value", own).select(*names), path, "parquet")
    return spark.read.parquet(path)


def _correction_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "parquet")
    sinks.write_table(_log(spark, sf_dir).drop("reason", "field_pos"), path, "parquet")
    return spark.read.parquet(path)


def _custom_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds and recommended fields of one's own, in the place of the built-in ones."""
    rules = RuleSet({"BET_m2_g": Bounds(hard_max=900, unit="m2/g"), "ID_IG": Bounds(soft_min=1.2)}, ("sample_name",))
    found = validate.physics_flags(cleaned(spark, sf_dir), rules, KEYS)
    return found.select(*KEYS, "field", "risk_level", "rule_code", "value_num")


def _dup_integer_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers of an integer column are compared digit by digit."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p"), F.monotonically_increasing_id().alias("i"), (F.col("l_orderkey") * 1000003).alias("sample_id")
    )
    items = materialise(items, "items")
    keyed = duplicates.duplicate_keys(items, ("p", "i"), (duplicates.SAMPLE,))
    return duplicates.rows_with_repeated_key(keyed, ("p", "i")).groupBy("p").agg(F.count("*").alias("n"))


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the raw table as CSV, read it back: string columns, null tokens, contiguous row index."""
    path = _fresh(spark, "csv")
    raw = raw_extract(spark, sf_dir)
    sinks.write_table(raw, path, "csv")
    back = read_table(spark, path)
    return back.select(*[F.col(k).cast("bigint").alias(k) for k in KEYS], *[column(h).alias(c) for h, (c, _) in RAW.items()])


NOTE = (
    "case n % 4 when 0 then concat('see\\nTable ', p, '\\n\\n, \"', s, '\" below') when 1 then concat('a, b\\r\\nc ', k) "
    "when 2 then concat('\"', q, '\"') else 'plain' end"
)


def _csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with line breaks, separators and quotes: records are cut from splits of the files."""
    path = _fresh(spark, "csv")
    base = table(spark, sf_dir, "lineitem").selectExpr(*BASE_COLUMNS)
    sinks.write_table(base.select(*KEYS, F.expr(NOTE).alias("note"), F.col("q").alias("quantity")), path, "csv")
    return _numbers(read_table(spark, path), "note", F.col("quantity").cast("int").alias("quantity"))


def _csv_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark, "csv")
    sinks.write_table(raw_extract(spark, sf_dir), path, "csv")
    return _index_check(read_table(spark, path, multi_line=False))


def _parquet_row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index_check(read_table(spark, f"{sf_dir}/lineitem.parquet"))


def _index_check(df: DataFrame) -> DataFrame:
    i = F.col("row_index")
    return df.agg(
        F.count("*").alias("n"), F.min(i).alias("lowest"), F.max(i).alias("highest"), F.count_distinct(i).alias("distinct_rows")
    )


def queries() -> dict[str, Query]:
    return {
        # numbers and units
        "parse_number": _parse_number,
        "parse_number_documents": _parse_number_documents,
        "unit_text": _unit_text,
        "unit_text_documents": _unit_text_documents,
        "convert_kelvin": _convert("carbonization_temperature_C"),
        "convert_angstrom": _convert("d002_nm"),
        "convert_bet": _convert("BET_m2_g"),
        "convert_current": _convert("current_density_A_g"),
        "convert_capacity": _convert("capacity_mAh_g"),
        "convert_loading": _convert("mass_loading_mg_cm2"),
        "convert_percent": _convert("XPS_N_at_pct", "XPS_O_at_pct", "ICE_pct"),
        "normalize_all": lambda spark, sf: cleaned(spark, sf),
        "corrections_log": _corrections_log,
        "corrections_preview": _corrections_preview,
        "unit_summary": lambda spark, sf: units.unit_summary(normalised(spark, sf)),
        "correction_type_counts": lambda spark, sf: units.correction_type_counts(_log(spark, sf), KEYS),
        # checks
        "missing_mask": _missing_mask,
        "hard_bounds": _bounds("hard"),
        "soft_bounds": _bounds("soft"),
        "physics_flags": lambda spark, sf: _flag_view(_physics(spark, sf)),
        "physics_flags_rule_table": lambda spark, sf: validate.range_breaches_by_rule_table(cleaned(spark, sf), keys=KEYS),
        "paper_outliers": _paper_outliers,
        "unit_fit_flags": _unit_fit,
        "unit_dimensions": _unit_dimensions,
        # duplicates
        "norm_keys": _norm_keys,
        "dup_sample_id": _detector(duplicates.SAMPLE),
        "dup_paper_sample": _detector(duplicates.PAPER_NAME),
        "near_dup": _detector(duplicates.NEAR),
        "duplicate_flags": _duplicate_flags,
        "name_classes": _name_classes,
        "name_slips": _name_slips,
        # audit
        "all_flags": lambda spark, sf: _flag_view(flags(spark, sf)),
        "review_queue": _review_queue,
        "flag_counts": lambda spark, sf: audit.flag_counts(flags(spark, sf)),
        "decision": lambda spark, sf: audit.decision(flags(spark, sf)),
        "paper_audit": lambda spark, sf: audit.ordered_paper_audit(flags(spark, sf)),
        "field_counts_top20": lambda spark, sf: audit.field_counts(flags(spark, sf), KEYS),
        "top10_review": lambda spark, sf: _flag_view(audit.top_items(flags(spark, sf), KEYS)),
        # headers
        "header_normalize": _header_normalize,
        "header_candidates": _header_candidates,
        "header_map": _header_map,
        "unknown_headers": lambda spark, sf: headers.unknown_headers(_header_map(spark, sf)),
        "header_counts": lambda spark, sf: headers.header_counts(_header_map(spark, sf)),
        "duplicate_targets": _duplicate_targets,
        "missing_recommended": lambda spark, sf: headers.missing_recommended(_header_map(spark, sf)),
        "header_dedup_names": lambda spark, sf: headers.target_names(_header_map(spark, sf)),
        "schema_state": _schema_state,
        "cells_to_wide": _cells_to_wide,
        "union_tables": _union_tables,
        # texts, report, sources
        "fmt6g_text": _fmt6g,
        "run_manifest": _manifest,
        "report_rows": _report_rows,
        "csv_roundtrip": _csv_roundtrip,
        "csv_mixed_headers": _csv_mixed_headers,
        "csv_quoted_breaks": _csv_quoted_breaks,
        "txt_roundtrip": _txt_roundtrip,
        "flags_sink": _flags_sink,
        "correction_sink": _correction_sink,
        "custom_rules": _custom_rules,
        "dup_integer_id": _dup_integer_id,
        "csv_row_index": _csv_row_index,
        "parquet_row_index": _parquet_row_index,
    }
