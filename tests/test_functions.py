"""Expressions, one probe per documented quirk."""

import random

import pytest
from pyspark.sql import functions as F

from assaysift.functions import headers as hf
from assaysift.functions import text as tx
from assaysift.functions import units as un

# field, text, value, rule
CELLS = [
    ("d002_nm", "3.44 Å", 0.344, "angstrom"),
    ("d002_nm", "3.44 A", 0.344, "angstrom"),
    ("d002_nm", "3.44", 0.344, "bare_angstrom"),
    ("d002_nm", "3.44 nm", 3.44, None),
    ("d002_nm", "3.72 Å", 0.372, "bare_angstrom"),
    ("d002_nm", "3.72 Å", 0.372, "angstrom"),
    ("d002_nm", "d002 = 3.7", 2.0, None),
    ("current_density_A_g", "70 mA/g", 0.07, "ma_per_g"),
    ("current_density_A_g", "100 mA·g-1", 0.1, "ma_per_g"),
    ("current_density_A_g", "0.2 A/g", 0.2, None),
    ("capacity_mAh_g", "265 mAh/g", 265.0, None),
    ("capacity_mAh_g", "0.265 Ah/g", 265.0, "ah_per_g"),
    ("capacity_mAh_g", "0.31 Ah g⁻1", 310.0, "ah_per_g"),
    ("capacity_mAh_g", "0.31 µAh/g", 310.0, "ah_per_g"),
    ("capacity_mAh_g", "320 F/g", 320.0, None),
    ("BET_m2_g", "25 cm² g⁻¹", 0.0025, "cm2_per_g"),
    ("BET_m2_g", "25 CM^2/G", 0.0025, "cm2_per_g"),
    ("BET_m2_g", "m2/g 25", 2.0, None),
    ("BET_m2_g", "1200±50", 1200.0, None),
    ("BET_m2_g", "−5", 5.0, None),
    ("BET_m2_g", "-5", -5.0, None),
    ("BET_m2_g", "1,200", 1200.0, None),
    ("BET_m2_g", "1.5e3 m2/g", 1500.0, None),
    ("BET_m2_g", "１２", 12.0, None),
    ("BET_m2_g", "abc", None, None),
    ("BET_m2_g", "", None, None),
    ("BET_m2_g", None, None, None),
    ("carbonization_temperature_C", "1073 K", 1073 - 273.15, "kelvin"),
    ("carbonization_temperature_C", "1073 kelvin", 1073 - 273.15, "kelvin"),
    ("carbonization_temperature_C", "1073 K", 1073 - 273.15, "kelvin"),
    ("carbonization_temperature_C", "1,073 K", 1073.0, None),
    ("carbonization_temperature_C", "~1073 K", 1073.0, None),
    ("carbonization_temperature_C", "800 °C", 800.0, None),
    ("mass_loading_mg_cm2", "10 g/m2", 1.0, "g_per_m2"),
    ("mass_loading_mg_cm2", "10 g m⁻²", 1.0, "g_per_m2"),
    ("mass_loading_mg_cm2", "1 mg/m2", 0.1, "g_per_m2"),
    ("mass_loading_mg_cm2", "1.1 mg/cm2", 1.1, None),
    ("XPS_N_at_pct", "0.8 at%", 80.0, "percent_scale"),
    ("ICE_pct", "0.9%", 90.0, "percent_scale"),
    ("ICE_pct", "0.9", 0.9, None),
    ("ICE_pct", "105%", 105.0, None),
    ("ID_IG", "4.20", 4.2, None),
]


def test_conversions(spark):
    rows = spark.createDataFrame([(i, f, t) for i, (f, t, _, _) in enumerate(CELLS)], "i int, field string, text string")
    fields = sorted({c[0] for c in CELLS})
    out = rows.select("i", "field", *[un.normalize_value(f, F.col("text")).alias(f) for f in fields])
    for r in out.collect():
        field, text, value, rule = CELLS[r["i"]]
        got = r[field]
        assert got["code"] == rule, (field, text)
        assert got["value"] == (pytest.approx(value, abs=1e-9) if value is not None else None), (field, text)


def test_numbers_of_numeric_columns(spark):
    df = spark.createDataFrame([(1.5, 2), (float("nan"), None)], "d double, i int")
    out = df.select(un.parse_number(F.col("d"), df.schema["d"].dataType), un.parse_number(F.col("i"), df.schema["i"].dataType))
    assert [tuple(r) for r in out.collect()] == [(1.5, 2.0), (None, None)]


def test_unit_text(spark):
    df = spark.createDataFrame([("25 CM² G⁻¹",), ("100 mA·g−1",), ("5 μm",), (None,)], "t string")
    assert [r[0] for r in df.select(un.unit_text(F.col("t"))).collect()] == ["25 cm2 g-¹", "100 ma g-1", "5 µm", ""]


def test_six_digit_text_rounds_like_c(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 15) for _ in range(4000)]
    values += [float(f"{rng.randint(100000, 999999)}5e{rng.randint(-12, 11)}") for _ in range(4000)]
    values += [rng.randint(1, 999999) / 1000 for _ in range(2000)]
    values += [0.0, -0.0, 1e-5, 0.0001, 999999.5, 999999.4, 1e6, 123456.0, 0.1 + 0.2, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, f"{v:.6g}") for v in values], "x double, want string")
    assert df.where(~tx.fmt6g(F.col("x")).eqNullSafe(F.col("want"))).collect() == []


def test_null_policies(spark):
    cells = [None, "", " ", "nan", "None ", "NULL", "n/a", "NA", "-", " - ", "x", "  HC-\t 800 \x1c", "0"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    out = df.select("i", tx.is_missing(F.col("c")).alias("m"), tx.norm_key(F.col("c")).alias("k"), tx.or_empty(F.col("c")).alias("e"))
    got = {r["i"]: r for r in out.collect()}
    words = {"", "nan", "none", "null", "n/a", "na", "-"}
    for i, c in enumerate(cells):
        folded = " ".join((c or "").split()).lower()
        missing = c is None or c.strip().lower() in words
        assert got[i]["m"] == missing, c
        assert got[i]["k"] == ("" if missing else folded), c
        assert got[i]["e"] == (c or "")


def test_header_spellings(spark):
    probes = {
        "BET (m²/g)": ["bet m2/g", "bet"],
        "capacity from table 2": ["capacity from table 2", "capacity"],
        "C": ["c"],
        "I_D/I_G": ["i d/i g"],
        "total pore volume (cm³ g⁻¹)": ["total pore volume cm3 g-", "total pore volume"],
    }
    df = spark.createDataFrame([(p,) for p in probes], "h string")
    for r in df.select("h", hf.header_candidates(F.col("h")).alias("c")).collect():
        assert r["c"][: len(probes[r["h"]])] == probes[r["h"]], r


def test_number_text_and_safe_str(spark):
    import assaysift.functions.text as tx

    values = [12300000.0, 0.0001, 1e16, 1.5e-7, 0.1, -2.5e9, 123456789012345.6, float("inf"), float("nan"), None, 1e22, 0.00012345, -0.0, 3e-5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(tx.number_text(F.col("v"))).collect()] == [None if v is None else str(v) for v in values]
    df = spark.createDataFrame([(" a b ",), ("nan",), (None,), ("-",), ("0",)], "t string")
    assert [r[0] for r in df.select(tx.safe_str(F.col("t"))).collect()] == ["a b", "", "", "", "0"]
