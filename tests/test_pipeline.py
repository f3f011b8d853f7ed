"""Operators and the whole chain on small tables."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from assaysift.operators import audit, duplicates, headers, position, units, validate
from assaysift.plans.clean import clean, clean_table
from assaysift.schema import AUDIT_COLUMNS, FLAG_COLUMNS
from assaysift.sources.tables import read_parquet_table, read_table, read_text_table, unique_headers
from assaysift.sources.vocab import Bounds, RuleSet, load_rules, load_vocabulary
from assaysift.streaming.rowlocal import clean_stream

DEMO = """DOI,material,SSA,d-spacing,Raman ID/IG,initial CE %,reversible capacity,rate,Figure,batch
q/17,bamboo-A,640 m2/g,3.61 Å,1.31,81%,288 mAh/g,50 mA/g,Fig. 4,x
q/17,bamboo-B,98000 m2/g,0.402 nm,1.27,128%,301 mAh/g,0.05 A/g,Fig. 4,x
q/23,peat-2,3100000 cm2/g,0.377 nm,0.95,74%,0.245 Ah/g,0.1 A/g,,y
q/23,peat-2,310 m2/g,0.377 nm,0.950,74%,245 mAh/g,0.1 A/g,,y
"""


def _file(folder, text, name="raw.csv"):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_demo_table(spark, tmp_path):
    out = str(tmp_path / "out")
    result = clean_table(spark, _file(tmp_path, DEMO), out)
    assert {k: result[k] for k in ("n_rows", "n_flags", "n_corrections", "decision")} == {
        "n_rows": 4, "n_flags": 8, "n_corrections": 4, "decision": "NOT_READY",
    }
    flags = spark.read.csv(f"{out}/flagged_records", header=True)
    assert flags.columns == list(FLAG_COLUMNS)
    assert sorted((r["row_index"], r["field"], r["risk_level"]) for r in flags.collect()) == [
        ("1", "BET_m2_g", "P0"), ("1", "ICE_pct", "P0"),
        *[(i, f, level) for i in "23" for f, level in
          (("near_duplicate_values", "P2"), ("paper_id+sample_name", "P1"), ("source_location", "P2"))],
    ]
    assert {r["value"] for r in flags.where("field = 'BET_m2_g'").collect()} == {"98000.0"}
    near = {r["value"] for r in flags.where("field = 'near_duplicate_values'").collect()}
    assert near == {
        "paper_id=q/23||BET_m2_g=310||d002_nm=0.377||ID_IG=0.95||ICE_pct=74||capacity_mAh_g=245||current_density_A_g=0.1"
    }
    audit_rows = spark.read.csv(f"{out}/paper_level_audit", header=True)
    assert audit_rows.columns == list(AUDIT_COLUMNS)
    assert [tuple(r) for r in audit_rows.orderBy("paper_id").collect()] == [("q/17", "2", "0", "0", "2"), ("q/23", "0", "2", "4", "6")]
    log = spark.read.csv(f"{out}/correction_log", header=True).collect()
    assert {(r["row_index"], r["field"], r["original_value"], r["cleaned_value"]) for r in log} == {
        ("0", "d002_nm", "3.61 Å", "0.361"), ("0", "current_density_A_g", "50 mA/g", "0.05"),
        ("2", "BET_m2_g", "3100000 cm2/g", "310.0"), ("2", "capacity_mAh_g", "0.245 Ah/g", "245.0"),
    }
    manifest = spark.read.json(f"{out}/cleaning_manifest").first()
    assert manifest["n_raw_columns"] == 10 and manifest["n_unknown_columns"] == 1
    assert "NOT_READY" in "\n".join(r[0] for r in spark.read.text(f"{out}/data_quality_report").collect())
    states = [spark.read.json(f"{out}/state/{n}").first()["agent"] for n in ("01_schema_map", "05_review_queue_state")]
    assert states == ["schema", "review_queue"]
    assert spark.read.json(f"{out}/state/03_physics_flags/records").count() == 4


def test_run_folder_is_released(spark, tmp_path):
    from assaysift.sources.scratch import materialise, run_folder

    with run_folder(spark) as folder:
        df = materialise(spark.range(5), "x")
        assert df.count() == 5 and Path(folder).is_dir()
    assert not Path(folder).exists()
    assert materialise(spark.range(5), "x").count() == 5


def test_one_impossible_value(spark, tmp_path):
    text = "DOI,material,SSA,ICE (%),Figure\nz9,m-1,730 m2/g,79%,F1\nz9,m-2,88000 m2/g,77%,F2\n"
    result = clean_table(spark, _file(tmp_path, text), str(tmp_path / "o"), fmt="parquet")
    assert (result["n_rows"], result["n_flags"], result["n_corrections"], result["decision"]) == (2, 1, 0, "NOT_READY")


def test_clean_row_keeps_headers(spark, tmp_path):
    text = "DOI,Sample_ID,material,SSA,d-spacing nm,Figure\nz9,n-4,m-1,730 m2/g,0.381,F1\n"
    out = str(tmp_path / "o")
    assert clean_table(spark, _file(tmp_path, text), out)["decision"] == "PASS_WITH_NOTES"
    flags = spark.read.csv(f"{out}/flagged_records", header=True)
    assert flags.columns == list(FLAG_COLUMNS) and flags.count() == 0


def test_header_plan(spark):
    plan = headers.plan_headers(spark, ["BET", "Sample Name", "random_col", "BET (m²/g)", "capacity mAh/g", "S_BET"])
    assert plan.column_map["BET"] == "BET_m2_g" and plan.column_map["Sample Name"] == "sample_name"
    assert plan.column_map["capacity mAh/g"] == "capacity_mAh_g"
    assert plan.unknown == ("random_col",)
    assert plan.targets == (
        "BET_m2_g", "sample_name", "random_col", "BET_m2_g__duplicate_1", "capacity_mAh_g", "BET_m2_g__duplicate_2",
    )
    known = {
        "I_D/I_G": "ID_IG", "N at%": "XPS_N_at_pct", "temperature °C": "carbonization_temperature_C", "V_total": "pore_volume_cm3_g",
        "Voltage V": "voltage_window_V", "thickness (µm)": "electrode_thickness_um", "DOI": "paper_id",
    }
    strange = ["thickness µm", "BET m2/g from Table 1", "C", "a.1"]
    plan = headers.plan_headers(spark, [*known, *strange])
    assert plan.column_map == known and list(plan.unknown) == strange


def test_dictionary_and_rowwise_matching_agree(spark):
    rows = [(t, i, h) for t in range(20) for i, h in enumerate(["BET", "DOI", "x y", "S_BET", None])]
    df = spark.createDataFrame(rows, "table_id int, position int, raw_header string")
    a = headers.map_headers(df).collect()
    b = headers.map_headers(df, broadcast_bytes=0).collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and len(a) == len(rows)


def test_bounds_and_gaps(spark):
    df = spark.createDataFrame(
        [(0, "P", "-", "x", 100.0, None), (1, "P", "S", "x", 99.9, 0.05), (2, "P", "S2", "x", float("inf"), 20.0)],
        "row_index long, paper_id string, sample_id string, sample_name string, carbonization_temperature_C double, mass_loading_mg_cm2 double",
    )
    got = {(r["row_index"], r["field"], r["risk_level"], r["rule_code"]) for r in validate.physics_flags(df).collect()}
    assert got == {
        (0, "carbonization_temperature_C", "P1", "below_soft_min"), (0, "sample_id", "P2", "missing_recommended"),
        (0, "mass_loading_mg_cm2", "P2", "missing_engineering"), (1, "carbonization_temperature_C", "P0", "below_hard_min"),
        (1, "mass_loading_mg_cm2", "P1", "below_soft_min"), (2, "carbonization_temperature_C", "P0", "above_hard_max"),
    }
    table_form = {(r["row_index"], r["field"], r["rule_code"]) for r in validate.range_breaches_by_rule_table(df).collect()}
    assert table_form == {(i, f, c) for i, f, _, c in got if not c.startswith("missing")}


def test_rules_on_text_columns(spark):
    df = spark.createDataFrame([(0, "1.5"), (1, "5d"), (2, "abc"), (3, " 9 "), (4, "nan"), (5, "-")], "row_index long, voltage_window_V string")
    rules = RuleSet({"voltage_window_V": Bounds(hard_max=2)}, ())
    assert [r["row_index"] for r in validate.physics_flags(df, rules).collect()] == [3]


def _expected_groups(rows):
    sizes = Counter(k for _, k in rows if k)
    return {i for i, k in rows if k and sizes[k] > 1}


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_share": 0.01}])
def test_duplicates_with_a_hot_key(spark, options):
    rng = random.Random(3)
    rows = [(i, "Hot" if i % 3 == 0 else rng.choice([None, "-", f"k{rng.randint(0, 900)}"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_index long, sample_id string")
    got = duplicates.duplicate_flags(df, **options)
    want = _expected_groups([(i, None if k in (None, "-") else k.lower()) for i, k in rows])
    found = [r["row_index"] for r in got.collect()]
    assert len(found) == len(want) and set(found) == want


def test_near_duplicates_compare_converted_numbers(spark):
    df = spark.createDataFrame(
        [(0, "P", "25 m2/g", "0.38 nm", "4.2"), (1, "p ", "250000 cm2/g", "3.8 Å", "4.20"), (2, "P", "25", "0.38 nm", "4.3"), (3, None, "25", "0.38 nm", "4.2")],
        "row_index long, paper_id string, BET_m2_g string, d002_nm string, ID_IG string",
    )
    cleaned = units.cleaned_table(units.normalise_units(df))
    assert sorted(r["row_index"] for r in duplicates.duplicate_flags(cleaned).collect()) == [0, 1]


def test_pipeline_invariants(spark):
    rng = random.Random(5)
    rows = [
        (i, f"P{rng.randint(0, 5)}", f"S{rng.randint(0, 60)}", rng.choice(["25 m2/g", "99999", "x", None, "1e6 cm2/g"]), rng.choice(["3.7", "0.37 nm", "9 nm", None]))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "row_index long, paper string, `sample id` string, BET string, `d002 (nm)` string")
    result = clean(df)
    assert result.cleaned.count() == len(rows)
    flags = result.flags.collect()
    assert {f["row_index"] for f in flags} <= {r[0] for r in rows}
    ranged = Counter((f["row_index"], f["field"]) for f in flags if f["value_num"] is not None)
    assert max(ranged.values()) == 1
    assert sum(r["total_flags"] for r in result.paper_audit.collect()) == len(flags)
    order = {"P0": 0, "P1": 1, "P2": 2}
    key = lambda f: (order[f["risk_level"]], f["paper_id"], f["sample_id"], f["row_index"], f["flag_seq"])
    assert [key(f) for f in result.queue.collect()] == sorted(map(key, flags))
    ranked = audit.ranked_review_queue(result.flags).collect()
    assert [key(f) for f in sorted(ranked, key=lambda f: f["rank"])] == sorted(map(key, flags))
    assert sorted(f["rank"] for f in ranked) == list(range(1, len(flags) + 1))
    again = headers.harmonise(headers.harmonise(df))
    assert again.columns == headers.harmonise(df).columns


def test_numbering_over_many_tasks(spark):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("x"))
    got = position.number_rows(df, [F.col("x")], "row_index").collect()
    assert all(r["x"] == r["row_index"] for r in got) and len(got) == 1000


def test_csv_reader(spark, tmp_path):
    text = 'a,a,"b, c",,Z,z\n1,NA,"line\nbreak",n/a,"say ""hi""",-\n\n2,nan, x ,none,,NULL\n'
    df = read_table(spark, _file(tmp_path, "﻿" + text, "t.CSV"), fmt="csv")
    rows = df.orderBy("row_index").toDF("row_index", "c0", "c1", "c2", "c3", "c4", "c5").collect()
    assert df.columns == ["row_index", "a", "a.1", "b, c", "Unnamed: 3", "Z", "z"]
    assert [tuple(r) for r in rows] == [
        (0, "1", None, "line\nbreak", None, 'say "hi"', "-"), (1, "2", None, " x ", "none", None, None),
    ]
    assert unique_headers(["a", "a", "a.1", None]) == ["a", "a.1", "a.1.1", "Unnamed: 3"]
    with pytest.raises(ValueError):
        read_table(spark, "x.xlsx")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_table(spark, str(tmp_path / "none.csv"))


def test_files_meet_by_header_name(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    _file(folder, "paper,BET\nP1,25\n", "a.csv")
    _file(folder, "BET,paper,ICE\n7,P2,80%\n", "b.csv")
    _file(folder, '"pa\nper",BET\nP3,8\n', "c.csv")
    _file(folder, "BET,paper,ICE\n9,P4,70%\n", "d.csv")
    _file(folder, "", "e.csv")
    for multi_line, third in ((True, True), (False, False)):
        df = read_table(spark, str(folder) if third else f"{folder}/[abd].csv", fmt="csv", multi_line=multi_line)
        rows = {(r["paper"], r["BET"], r["ICE"]) for r in df.collect()}
        assert {("P1", "25", None), ("P2", "7", "80%"), ("P4", "9", "70%")} <= rows and df.columns[:4] == ["row_index", "paper", "BET", "ICE"]
        assert sorted(r["row_index"] for r in df.collect()) == list(range(4 if third else 3))


def test_rows_of_other_widths(spark, tmp_path):
    path = _file(tmp_path, 'paper,BET\nP1,25,lost\nP2\nP3,"4,5",,\nP4,6\n')
    with pytest.raises(Exception, match="more cells than headers"):
        read_table(spark, path).collect()
    for multi_line in (True, False):
        df = read_text_table(spark, path, surplus="keep", multi_line=multi_line).orderBy("row_index")
        assert [tuple(r) for r in df.collect()] == [
            (0, "P1", "25", "P1,25,lost"), (1, "P2", None, None), (2, "P3", "4,5", 'P3,"4,5",,'), (3, "P4", "6", None),
        ]


def test_row_index_without_broadcast(spark, tmp_path):
    spark.range(3000, numPartitions=5).write.parquet(str(tmp_path / "d.parquet"))
    df = read_parquet_table(spark, str(tmp_path / "d.parquet"), broadcast_blocks=0)
    assert df.count() == 3000 and df.where("row_index <> id").count() == 0
    spark.range(3000, numPartitions=5).write.option("header", True).csv(str(tmp_path / "d.csv"))
    df = read_text_table(spark, str(tmp_path / "d.csv"), multi_line=False, broadcast_blocks=0)
    assert df.count() == 3000 and df.where("row_index <> cast(id AS bigint)").count() == 0


def test_repeated_blank_and_colliding_headers(spark):
    header = ["x", "x", "x__duplicate_1", None, "", "BET", "BET", "S_BET"]
    rows = [(t, i, h, f"v{i}") for t in (1, 2) for i, h in enumerate(header)]
    cells = spark.createDataFrame(rows, "table_id int, position int, raw_header string, raw_value string")
    mapped = headers.map_headers(cells.drop("raw_value"))
    state = headers.schema_state(mapped).where("table_id = 1").first()
    assert state["column_map"] == {"BET": "BET_m2_g", "BET.1": "BET_m2_g", "S_BET": "BET_m2_g"}
    names = {r["position"]: r["target"] for r in headers.target_names(mapped).where("table_id = 2").collect()}
    assert [names[i] for i in range(8)] == [
        "x", "x__duplicate_1", "x__duplicate_1__duplicate_1", "Unnamed: 3", "Unnamed: 4",
        "BET_m2_g", "BET_m2_g__duplicate_1", "BET_m2_g__duplicate_2",
    ]
    assert headers.deduplicated(["x", "x", "x__duplicate_1"]) == ["x", "x__duplicate_1", "x__duplicate_1__duplicate_1"]
    wide = headers.cells_to_wide(cells, row_key=("table_id",)).where("table_id = 1").first()
    assert wide["BET_m2_g"] == "v5" and wide["paper_id"] is None
    assert [(o["position"], o["name"], o["value"]) for o in wide["other"]] == [
        (0, "x", "v0"), (1, "x__duplicate_1", "v1"), (2, "x__duplicate_1", "v2"), (3, "Unnamed: 3", "v3"), (4, "Unnamed: 4", "v4"),
        (6, "BET_m2_g__duplicate_1", "v6"), (7, "BET_m2_g__duplicate_2", "v7"),
    ]
    df = spark.createDataFrame([(0, "1", "2", "3")], "row_index long, c0 string, c1 string, c2 string").toDF("row_index", "x", "x", "x__duplicate_1")
    assert headers.harmonise(df).columns == ["row_index", "x", "x__duplicate_1", "x__duplicate_1__duplicate_1"]


def test_numeric_ids_are_compared_as_text(spark):
    df = spark.createDataFrame([(0, 1234567), (1, 1234568), (2, 1234567)], "row_index long, sample_id long")
    assert sorted(r["row_index"] for r in duplicates.duplicate_flags(df).collect()) == [0, 2]
    keyed = duplicates.duplicate_keys(df, numeric_ids=True)
    assert duplicates.rows_with_repeated_key(keyed).count() == 3
    assert duplicates.duplicate_keys(df, detectors=(duplicates.NEAR,)).count() == 0


def test_tied_fields_keep_their_order(spark):
    rows = [(i, "f", 5) for i in range(3)] + [(7, "late", 1), (2, "early", 9), (1, "dup", 3001)]
    flags = spark.createDataFrame(rows, "row_index long, field string, flag_seq int")
    assert [tuple(r) for r in audit.field_counts(flags).collect()] == [("f", 3), ("early", 1), ("late", 1), ("dup", 1)]


def test_row_index_over_many_files(spark, tmp_path):
    spark.range(5000, numPartitions=6).selectExpr("id", "id * 2 AS v").write.option("header", True).csv(str(tmp_path / "d.csv"))
    df = read_table(spark, str(tmp_path / "d.csv"), multi_line=False)
    assert sorted(r[0] for r in df.select("row_index").collect()) == list(range(5000))
    assert df.where("row_index <> cast(id AS bigint)").count() == 0
    spark.range(5000, numPartitions=6).write.parquet(str(tmp_path / "d.parquet"))
    df = read_table(spark, str(tmp_path / "d.parquet"))
    assert df.where("row_index <> id").count() == 0 and df.count() == 5000


def test_custom_configuration(spark, tmp_path):
    aliases = _file(tmp_path, "canonical_fields:\n  foo:\n    aliases: [bar, Baz (nm)]\n  empty:\n", "a.yaml")
    rules = _file(tmp_path, "rules:\n  BET_m2_g: {hard_max: 10, unit: m2/g}\n", "r.yaml")
    vocab = load_vocabulary(spark, aliases)
    assert headers.plan_headers(spark, ["Bar", "baz nm", "BET", "empty"], vocab).canonical == ("foo", "foo", None, "empty")
    loaded = load_rules(spark, rules)
    assert loaded.bounds == {"BET_m2_g": Bounds(hard_max=10, unit="m2/g")} and loaded.recommended == ("source_location",)
    assert load_rules(spark, _file(tmp_path, "", "e.yaml")).bounds == {}


def test_stream_gives_the_batch_result(spark, tmp_path):
    rows = [(0, "P", "3.72 Å", None), (1, "P", "9 nm", "Table 1")]
    df = spark.createDataFrame(rows, "row_index long, paper string, d002 string, source string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    for name, frame, want in zip(("s_clean", "s_log", "s_flags"), clean_stream(stream), (2, 1, 2)):
        q = frame.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
        assert spark.table(name).count() == want


def test_odd_headers_survive(spark, tmp_path):
    odd = ['we.ird', 'tick`s', 'par(en), {x}; y=z', "X", "x", "row_index"]
    head = ",".join(f'"{h}"' for h in ["BET", *odd])
    out = str(tmp_path / "o")
    assert clean_table(spark, _file(tmp_path, f"{head}\n25 m2/g,1,2,3,4,5,6\n"), out, fmt="csv")["n_rows"] == 1
    row = spark.read.option("header", True).csv(f"{out}/cleaned_database").first()
    assert list(row)[1:] == ["25.0", "1", "2", "3", "4", "5", "6"]


def test_table_without_rows(spark, tmp_path):
    out = str(tmp_path / "o")
    result = clean_table(spark, _file(tmp_path, "paper,sample id,BET,d002,ICE\n"), out)
    assert (result["n_rows"], result["n_flags"], result["decision"]) == (0, 0, "PASS_WITH_NOTES")
    assert spark.read.option("header", True).csv(f"{out}/correction_log").columns[0] == "row_index"
