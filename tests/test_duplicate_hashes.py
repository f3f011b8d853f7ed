import pytest
from pyspark.sql import functions as F

from assaysift.operators import duplicates
from registry import queries


def _rows(spark):
    rows = [(i, f"P{i % 3}", "S" if i < 2 else f"S{i}", f"hc {i % 10}", float(i % 10), 0.3, 1.0, 80.0) for i in range(60)]
    rows += [(60, "n/a", None, "", 1.0, 0.3, 1.0, 80.0), (61, None, "", None, None, None, None, None)]
    names = "row_index long, paper_id string, sample_id string, sample_name string, BET_m2_g double, d002_nm double, ID_IG double, ICE_pct double"
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize("size", [0, 32, 32 * 40])  # all, most and no detectors are shuffled
@pytest.mark.parametrize("hot_share", [1e-4, 0.01])
def test_each_detector_takes_its_own_way(spark, size, hot_share):
    df = _rows(spark)
    keyed = [r.asDict() for r in duplicates.duplicate_keys(df).collect()]
    seen: dict = {}
    for r in keyed:
        seen.setdefault((r["detector"], r["key"], r["key2"]), []).append(r["row_index"])
    want = sorted((i, d) for (d, _, _), rows in seen.items() if len(rows) > 1 for i in rows)
    got = duplicates.duplicate_flags(df, broadcast_bytes=size, hot_share=hot_share).collect()
    assert {d for _, d in want} == {1, 2, 3}
    assert sorted((r["row_index"], r["flag_seq"] - duplicates.SEQ_DUPLICATE) for r in got) == want
    assert {(r["row_index"], r["value"]) for r in got if r["rule_code"] == "near_duplicate"} == {(r["row_index"], r["key"]) for r in keyed if (r["row_index"], 3) in want and r["detector"] == 3}


def test_key_texts_are_not_shuffled(spark):
    keyed = duplicates.duplicate_keys(_rows(spark))
    assert "key" not in duplicates.repeated_keys(keyed).columns
    for df in (duplicates.repeated_keys(keyed), duplicates.duplicate_flags(_rows(spark), broadcast_bytes=0).groupBy("paper_id").agg(F.count("*"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(" in plan and not any("hashpartitioning(" in line and "key" in line.split("hashpartitioning(")[1] for line in plan.splitlines())


def test_report_and_manifest_parse_the_cells_once(spark, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "normalised", lambda *a, old=queries.normalised: made.append(1) or old(*a))
    for name in ("report_rows", "run_manifest"):
        made.clear()
        assert queries.queries()[name](spark, "/root/testdata/sf0.001").count() >= 1 and made == [1]


def test_near_keys_are_joined_from_filled_parts_without_an_array(spark):
    rows = [(1, " P1", 1.0, 0.35, None, 90.5), (2, "p1", 1.0, None, float("nan"), 90.5), (3, None, 2.0, 0.25, 1e-5, -0.0), (4, "-", None, None, None, 1.0)]
    keyed = duplicates.duplicate_keys(spark.createDataFrame(rows, "i int, paper_id string, BET_m2_g double, d002_nm double, ID_IG double, ICE_pct double"), ("i",), (duplicates.NEAR,))
    assert {r.i: r.key for r in keyed.collect()} == {1: "paper_id=p1||BET_m2_g=1||d002_nm=0.35||ICE_pct=90.5", 3: "BET_m2_g=2||d002_nm=0.25||ID_IG=1e-05||ICE_pct=-0"}
    assert "array_join" not in keyed._jdf.queryExecution().optimizedPlan().toString()
