"""What large runs leave on disk: no shuffled rows where places do, no files of finished steps."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assaysift.operators import duplicates
from assaysift.sources.scratch import materialise, materialise_result, scratch_folder
from registry import queries


def _rows(spark):
    rows = [(i, f"P{i % 3}", "S" if i < 2 else f"S{i % 50}", f"hc {i % 10}", float(i % 10), 0.3, 1.0, 80.0) for i in range(120)]
    rows += [(120, "n/a", None, "", 1.0, 0.3, 1.0, 80.0), (None, None, "S", None, None, None, None, None), (7, "P1", "S", None, None, None, None, None)]
    names = "row_index long, paper_id string, sample_id string, sample_name string, BET_m2_g double, d002_nm double, ID_IG double, ICE_pct double"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.mark.parametrize("bitmap_bytes", [0, 64 << 20])
@pytest.mark.parametrize("size", [0, 32 * 40])
def test_places_find_the_rows_that_keys_find(spark, bitmap_bytes, size):
    df = materialise(duplicates.placed(_rows(spark)), "rows")
    keyed = duplicates.duplicate_keys(df)
    got = duplicates.rows_with_repeated_key(keyed, broadcast_bytes=size, hot_share=0.01, bitmap_bytes=bitmap_bytes)
    plain = duplicates.duplicate_keys(df.drop(duplicates.AT))
    want = duplicates.rows_with_repeated_key(plain, broadcast_bytes=size, hot_share=0.01)
    assert sorted(map(str, got.drop(duplicates.AT).collect())) == sorted(map(str, want.collect())) and want.count() > 200


def test_rows_with_places_are_not_shuffled(spark):
    df = materialise(duplicates.placed(_rows(spark)), "rows")
    found = duplicates.duplicate_flags(df, broadcast_bytes=0)
    assert duplicates.AT not in found.columns
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    stored = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not _shuffle_files(spark) - before and stored.count() == 7


def test_tables_stored_on_the_way_are_deleted(spark):
    paths = []

    def make():
        first = materialise(spark.range(10), "first")
        paths.extend(first.inputFiles())
        return first.where("id < 4")

    assert materialise_result(spark, make, "last").count() == 4
    assert paths and not any(Path(p.removeprefix("file://")).exists() for p in paths)


def test_the_sink_outlives_the_cleaned_table(spark):
    before = set(Path(scratch_folder(spark)).iterdir())
    assert queries.queries()["flags_sink"](spark, "/root/testdata/sf0.001").count() > 0
    left = [p.name for p in set(Path(scratch_folder(spark)).iterdir()) - before]
    assert len(left) == 1 and left[0].startswith("query-")
