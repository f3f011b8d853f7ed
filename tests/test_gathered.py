"""Lists gathered from neighbours, and steps that must not be done twice or in interpreted code."""

import pytest
from pyspark.sql import functions as F

from assaysift.functions.headers import header_candidates
from assaysift.operators import groups, headers
from assaysift.operators.groups import gathered


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().split("\n")


@pytest.mark.parametrize("batch", ["2", "10000"])
def test_gathered_equals_collect_list(spark, batch):
    rows = [(k, name, i, None if i % 3 else f"v{i}") for i in range(40) for k, name in ((i // 7, "a"), (None, None), (i % 2, None), (5, "b"))]
    df = spark.createDataFrame(rows, "k int, name string, position int, v string").repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = gathered(df, ("k", "name"), "h").withColumn("h", F.array_sort("h")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = df.groupBy("k", "name").agg(F.array_sort(F.collect_list(F.struct("position", "v"))).alias("h")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_header_rows_are_gathered_without_collect_list(spark):
    mapped = spark.createDataFrame([(1, 0, "BET", "BET_m2_g"), (1, 1, "SSA", "BET_m2_g")], "table_id int, position int, raw_header string, canonical string")
    cells = spark.createDataFrame([(1, 0, "BET", "3")], "table_id int, position int, raw_header string, raw_value string")
    found = (headers.schema_state(mapped), headers.target_names(mapped), headers.duplicate_targets(mapped), headers.cells_to_wide(cells, row_key=("table_id",)))
    for df in found:
        assert not any("collect_list" in line for line in _plan(df))
    assert found[2].collect() == [(1, "BET_m2_g", 2, ["BET", "SSA"])]
    assert found[3].first()["BET_m2_g"] == "3"


@pytest.mark.parametrize("size", [0, 1 << 20])
def test_spellings_by_dictionary_or_in_place(spark, size):
    df = spark.createDataFrame([("BET (m²/g)",), ("x",), (None,), ("BET (m²/g)",), ("",)], "raw_header string")
    got = headers.with_spellings(df, broadcast_bytes=size).select("raw_header", F.array_join("spellings", "|").alias("s")).collect()
    want = df.select("raw_header", F.array_join(F.array_sort(header_candidates(F.col("raw_header"))), "|").alias("s")).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_units_are_searched_once(spark):
    from assaysift.operators import unit_fit

    df = spark.createDataFrame([(1, "12 m2/g")], "row_index int, BET_m2_g string")
    cells = unit_fit.cell_units(df, ("row_index",))
    assert not any("regexp_replace" in line for line in _plan(cells) if "Filter" in line)
    assert [r["unit"] for r in cells.collect()] == ["m2/g"]


def test_checks_are_listed_by_a_projection(spark):
    from assaysift.operators import validate

    df = spark.createDataFrame([(1, "P", 99999.0)], "row_index int, paper_id string, BET_m2_g double")
    found = validate.physics_flags(df, keys=("row_index",))
    assert not any("CASE" in line for line in _plan(found) if "Generate " in line)
    assert found.count() > 0


def _wide_case(spark, rows):
    df = spark.createDataFrame(rows, "k int, name string, position int, v string")
    want = df.groupBy("k", "name").agg(F.array_sort(F.collect_list(F.struct("position", "v"))).alias("h")).collect()
    return df, sorted(map(str, want))


@pytest.mark.parametrize("batch", ["2", "10000"])
@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("spread", [1, 3])
def test_whole_groups_are_made_where_they_stand(spark, batch, limit, spread):
    rows = [(k, None if k % 4 else "a", i, f"v{i}" if i else None) for k in range(30) for i in range(3)]
    rows += [(k, None, 7, "more") for k in (1, 2)] + [(5, None, i, "again") for i in range(3)] + [(None, None, 0, "x"), (40, "b", 1, None)]
    df, want = _wide_case(spark, rows)
    df = df.repartition(3, "position") if spread > 1 else df.coalesce(1)

    def make(lists, *kept):
        return lists.select("k", "name", F.array_sort("h").alias("h"), *kept)

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = groups.made_of_gathered(df, df.select("k", "name"), ("k", "name"), "h", make, limit).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(map(str, got)) == want


def test_cells_of_whole_rows_are_not_shuffled(spark):
    cells = spark.range(0, 400, 1, 2).selectExpr("id div 4 as table_id", "cast(id % 4 as int) as position", "concat('h', id % 4) as raw_header", "cast(id as string) as raw_value")
    wide = headers.cells_to_wide(cells, row_key=("table_id",))
    assert wide.count() == 100
    path = next(p for p in wide.inputFiles() if "/made-" in p).rsplit("/", 1)[0]
    stored = spark.read.parquet(path)
    assert stored.where("_whole").count() == 100 and stored.where("NOT _whole").count() == 0
