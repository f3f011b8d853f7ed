import random

import pytest
from pyspark.sql import functions as F

from assaysift.functions import dimensions
from assaysift.operators import groups, outliers, unit_fit
from assaysift.sources.vocab import Bounds, RuleSet


def median(values):
    values = sorted(values)
    return (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2


@pytest.mark.parametrize(("accuracy", "broadcast"), [(10_000, 200_000), (40, 0), (2, 200_000)])
def test_medians_are_exact(spark, accuracy, broadcast):
    rng = random.Random(accuracy)
    rows = [("hot", 1, rng.gauss(0, 1)) for _ in range(3_000)] + [("hot", 2, float(rng.randrange(4))) for _ in range(1_000)]
    rows += [(f"g{i % 40}", i % 3, round(rng.uniform(-5, 5), 1)) for i in range(400)] + [("one", 0, 3.5), ("two", 0, 1.0), ("two", 0, -2.0)]
    values = spark.createDataFrame(rows, "paper string, field int, x double").repartition(5)
    got = {(r.paper, r.field): (r.n, r.median) for r in outliers.exact_medians(values, ("paper", "field"), "x", accuracy, broadcast).collect()}
    expected = {}
    for p, f, x in rows:
        expected.setdefault((p, f), []).append(x)
    assert got == {k: (len(v), median(v)) for k, v in expected.items()}


def test_a_sketch_that_is_off_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(outliers.F, "percentile_approx", lambda c, q, a: F.array(F.max(c), F.max(c)))
    rows = [("a", float(i)) for i in range(101)] + [("b", 1.0)]
    got = outliers.exact_medians(spark.createDataFrame(rows, "g string, x double"), ("g",), "x")
    assert {r.g: r.median for r in got.collect()} == {"a": 50.0, "b": 1.0}


def table(spark, rows):
    return spark.createDataFrame(rows, "row_index bigint, n string, paper_id string, sample_id string, BET_m2_g double, ID_IG string")


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_outliers_equal_the_definition(spark, broadcast):
    rng = random.Random(3)
    rows = [(i, "x", f" P{i % 7} " if i % 2 else f"p{i % 7}", f"S{i}", rng.gauss(500, 20), str(round(rng.gauss(1, 0.1), 2))) for i in range(200)]
    rows += [(200, "x", "P1", None, 5_000.0, "n/a"), (201, "x", "P2", "-", float("nan"), "inf"), (202, "x", None, "S", 9_999.0, "9"), (203, "x", "-", "S", 9_999.0, "9")]
    rows += [(300 + i, "x", "same", "S", 1.0 if i else 50.0, "1") for i in range(20)] + [(400 + i, "x", "few", "S", 1.0 * i * i * i, "1") for i in range(4)]
    frame = table(spark, rows)
    got = outliers.paper_outliers(frame, keys=("row_index", "n"), broadcast_groups=broadcast)
    found = {(r.row_index, r.field) for r in got.collect()}
    by_group = {}
    for i, _, paper, _, bet, raman in rows:
        key = (paper or "").strip().lower()
        for field, text in (("BET_m2_g", bet), ("ID_IG", raman)):
            value = None if text in ("n/a", "inf") or text != text else float(text)
            if key not in ("", "-") and value is not None:
                by_group.setdefault((key, field), []).append((i, value))
    expected = set()
    for (_, field), own in by_group.items():
        middle = median(v for _, v in own)
        spread = median(abs(v - middle) for _, v in own)
        if len(own) >= 5 and spread > 0:
            expected |= {(i, field) for i, v in own if abs(v - middle) > 3.5 * 1.4826 * spread}
    assert found == expected
    assert (200, "BET_m2_g") in found
    row = got.where("row_index = 200").first()
    assert (row.paper_id, row.sample_id, row.risk_level, row.rule_code, row.value) == ("P1", "", "P1", "paper_outlier", "5000.0")


def test_outliers_of_odd_tables(spark):
    assert outliers.paper_outliers(table(spark, [])).collect() == []
    assert outliers.paper_outliers(spark.createDataFrame([(1, 2.0)], "row_index bigint, BET_m2_g double")).collect() == []
    assert outliers.paper_outliers(spark.createDataFrame([(1, "p")], "row_index bigint, paper_id string")).collect() == []


def test_hot_groups_are_split_from_the_rest(spark, monkeypatch):
    monkeypatch.setattr(groups, "HOT_SHARE", 0.2)
    rows = spark.createDataFrame([(None if i % 50 == 3 else "hot" if i % 2 else f"g{i}", i) for i in range(100)], "g string, i int")
    sizes = rows.groupBy("g").agg(F.count("*").alias("n"))
    joined = groups.with_group_values(rows, sizes, ("g",), broadcast_groups=0)
    assert sorted(r.i for r in joined.collect()) == [i for i in range(100) if i % 50 != 3]
    assert {r.n for r in joined.where("g = 'hot'").collect()} == {48}


@pytest.mark.parametrize(("cell", "unit", "dimension", "factor"), [
    ("320 F/g", "f/g", "-2 -2 4 2 0 0", 1e3), ("1200±50 m² g⁻1", "m2 g-1", "2 -1 0 0 0 0", 1e3), ("3.45 Å", "å", "1 0 0 0 0 0", 1e-10),
    ("1.2-1.5 mg·cm^-2", "mg cm^-2", "-2 1 0 0 0 0", 1e-2), ("~ 300 mAh g-1", "mah g-1", "0 -1 1 1 0 0", 3600.0), ("900 C", "°c", "0 0 0 0 1 0", 1.0),
    ("5 C/g", "c/g", "0 -1 1 1 0 0", 1e3), ("1e-3 W/kg", "w/kg", "2 0 -3 0 0 0", 1.0), ("12 µm", "µm", "1 0 0 0 0 0", 1e-6), ("0.8 at%", "at%", "0 0 0 0 0 0", 1e-2),
    ("25", "", None, None), ("-0.5", "", None, None), (None, "", None, None), ("", "", None, None), ("7 bananas", "bananas", None, None),
    ("7 m2/g (Table 3)", None, None, None), ("4 m//g", "m//g", None, None), ("4 m^", None, None, None), ("1,073 K", "k", "0 0 0 0 1 0", 1.0),
])
def test_unit_grammar(spark, cell, unit, dimension, factor):
    frame = spark.createDataFrame([(cell,)], "c string").select(dimensions.unit_of(F.col("c")).alias("unit"))
    got = frame.select("unit", dimensions.parsed_unit(F.col("unit")).alias("p")).first()
    if unit is not None:
        assert got.unit == unit
    if dimension is None:
        assert got.p is None or cell == "4 m^"
    else:
        assert got.p.dimension == dimension
        assert got.p.factor == pytest.approx(factor)


def test_unit_flags(spark):
    rows = [
        (0, "a", "-", "S0", "320 F/g", "1.1"), (1, "b", "P", "S1", "320 mAh/g", "0.9 nm"), (2, "c", "P", "S2", "0.3 Ah g-1", "1 %"), (3, "d", "P", None, "300", "x"),
        (4, "e", "P", "S4", "bananas", "1"), (5, "f", "P", "S5", "300 bananas", None),
    ]
    frame = spark.createDataFrame(rows, "row_index bigint, n string, paper_id string, sample_id string, capacity_mAh_g string, ID_IG string")
    for broadcast in (0, 100):
        got = unit_fit.unit_flags(frame, keys=("row_index", "n"), broadcast_groups=broadcast).collect()
        assert sorted((r.row_index, r.n, r.field, r.risk_level, r.rule_code, r.paper_id) for r in got) == [
            (0, "a", "capacity_mAh_g", "P1", "unit_mismatch", ""), (1, "b", "ID_IG", "P1", "unit_mismatch", "P"), (5, "f", "capacity_mAh_g", "P2", "unit_unread", "P"),
        ]
    own = RuleSet({"capacity_mAh_g": Bounds(unit="F/g")}, ())
    assert {(r.row_index, r.rule_code) for r in unit_fit.unit_flags(frame, rules=own).where("field = 'capacity_mAh_g'").collect()} == {
        (1, "unit_mismatch"), (2, "unit_mismatch"), (5, "unit_unread"),
    }
    assert unit_fit.unit_flags(frame.select("row_index")).collect() == []
    assert unit_fit.unit_flags(frame.limit(0)).collect() == []


def test_a_median_is_counted_by_steps_and_sketched_only_in_full_ones(spark, monkeypatch):
    sketches, sketch = [], F.percentile_approx
    monkeypatch.setattr(outliers.F, "percentile_approx", lambda *a: sketches.append(a) or sketch(*a))
    rng = random.Random(8)
    groups_ = {"even": [-1e300, -2.5, 0.0, -0.0, 5e-324, 7.0], "odd": [rng.uniform(-3, 3) for _ in range(501)], "close": [100 + rng.random() / 10 for _ in range(400)]}
    groups_["huge"] = [1.7e308, 1.0, -1.7e308]
    values = spark.createDataFrame([(g, x) for g, own in groups_.items() for x in own], "g string, x double").repartition(4)
    expected = {g: (len(own), median(own)) for g, own in groups_.items()}
    assert {r.g: (r.n, r.median) for r in outliers.exact_medians(values, ("g",), "x").collect()} == expected
    assert not sketches
    monkeypatch.setattr(outliers, "BRACKET_ROWS", 50)
    assert {r.g: (r.n, r.median) for r in outliers.exact_medians(values, ("g",), "x").collect()} == expected
    assert len(sketches) == 1
