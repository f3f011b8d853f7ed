"""Extraction-like tables derived from the given tables.

The given tables hold no materials data. These views turn ``lineitem`` and ``orders``
into dirty extraction tables by integer arithmetic and text building only, so one text per
column serves Spark and the SQL check alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysift.session import spread, tune

# The four numbers of a line item are not unique; with the price in cents they are.
KEYS = ("k", "p", "s", "n", "e")
COPY_KEYS = (*KEYS, "copy")

BASE = (
    "l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, cast(round(l_extendedprice * 100) AS bigint) AS e, "
    "cast(l_quantity AS int) AS q"
)
BASE_COLUMNS = BASE.split(", ")
PADDED = "lpad(cast(q AS string), 2, '0') AS q2"

# raw header -> (canonical field, text)
RAW: dict[str, tuple[str, str]] = {
    "paper": ("paper_id", "case when k % 53 = 0 then '-' else concat('P', k % 500) end"),
    "sample id": (
        "sample_id",
        "case when p % 97 = 0 then 'n/a' when p % 89 = 0 then null else concat('S', k, '-', n) end",
    ),
    "Sample Name": ("sample_name", "case when s % 5 = 0 then concat(' hc-', p % 40, ' ') else concat('HC-', p % 40) end"),
    "temperature": (
        "carbonization_temperature_C",
        "case p % 5 when 0 then concat(600 + q*20, ' °C') when 1 then concat(873 + q*10, ' K') "
        "when 2 then concat('1,0', q2, ' K') when 3 then concat(q*4, ' C') end",
    ),
    "BET": (
        "BET_m2_g",
        "case p % 4 when 0 then concat(q*100, ' m2/g') when 1 then concat(q*1000000, ' cm²/g') "
        "when 2 then concat(q*300, ' m2/g') end",
    ),
    "d002": (
        "d002_nm",
        "case s % 5 when 0 then concat('3.', q2, ' Å') when 1 then concat('0.3', q2, ' nm') "
        "when 2 then concat('3.', q2) when 3 then concat('3.', q2, ' A') end",
    ),
    "ID/IG": (
        "ID_IG",
        "case when s % 11 = 0 then concat('4.', q2) when s % 13 = 0 then concat('−0.', q2) "
        "when s % 17 = 0 then concat('-0.', q2) else concat('1.', q2) end",
    ),
    "N content": (
        "XPS_N_at_pct",
        "case n % 3 when 0 then '0.8 at%' when 1 then concat(q, ' at%') else concat(q, '.5%') end",
    ),
    "O content": ("XPS_O_at_pct", "case when n = 5 then '0.7 at%' else concat(q*3, ' at%') end"),
    "pore volume": (
        "pore_volume_cm3_g",
        "case when p % 13 = 0 then concat(q, ' cm3/g') else concat('0.', q2, ' cm3/g') end",
    ),
    "loading": (
        "mass_loading_mg_cm2",
        "case p % 6 when 1 then concat(q, ' g/m2') when 2 then concat('1.', q2, ' mg/cm2') "
        "when 3 then concat('0.0', q2, ' mg/cm2') when 4 then 'none' when 5 then concat(q*3, ' mg cm-2') end",
    ),
    "ICE": ("ICE_pct", "case n % 3 when 0 then concat(60 + q, '%') when 1 then '0.9%' else '-' end"),
    "capacity": (
        "capacity_mAh_g",
        "case p % 3 when 0 then concat(q*120, ' mAh/g') when 1 then concat('0.', q2, ' Ah/g') "
        "else concat('-', q, ' mAh/g') end",
    ),
    "capacitance": ("capacitance_F_g", "concat(q*70, ' F g⁻1')"),
    "current density": (
        "current_density_A_g",
        "case when s % 2 = 0 then concat(q*10, ' mA·g-1') else concat('0.', q2, ' A/g') end",
    ),
    "source": (
        "source_location",
        "case n % 4 when 0 then 'N/A' when 1 then 'Table 1' when 2 then ' ' else 'Fig. 2' end",
    ),
    "random_col": ("random_col", "'x'"),
}

# Header spellings per column of the header catalogue; a table picks one by its number.
SPELLINGS: dict[str, tuple[str, ...]] = {
    "paper": ("paper", "DOI", "Article_ID", "Reference"),
    "sample id": ("sample id", "Sample_ID", "a.1"),
    "Sample Name": ("Sample Name", "material", "C"),
    "temperature": ("temperature", "temperature °C", "Pyrolysis temp.", "carbonization_temperature"),
    "BET": ("BET", "S_BET", "SSA", "BET (m²/g)", "BET m2/g from Table 1", "BET_m2_g"),
    "d002": ("d002", "d_002 (nm)", "Interlayer spacing Å", "d-spacing nm"),
    "ID/IG": ("ID/IG", "I_D/I_G", "Raman ID/IG"),
    "N content": ("N content", "N at%", "XPS_N", "nitrogen content (at%)"),
    "O content": ("O content", "O at%", "N (at%)"),
    "pore volume": ("pore volume", "V_total", "total pore volume (cm³ g⁻¹)", "pore volume cm3/g"),
    "loading": ("loading", "mass loading mg/cm2", "thickness (µm)", "thickness µm"),
    "ICE": ("ICE", "initial CE %", "ICE (%)"),
    "capacity": ("capacity", "capacity mAh/g", "capacity from table 2", "reversible capacity"),
    "capacitance": ("capacitance", "capacity", "capacitance reported at 1 A/g"),
    "current density": ("current density", "rate", "Current density (A g⁻¹)"),
    "source": ("source", "Figure", "Voltage V", "source_location"),
    "random_col": ("random_col", "a.1", "note"),
}


def raw_header_case(header: str, number: str) -> str:
    """SQL text that picks one spelling of a header by a table number."""
    options = SPELLINGS[header]
    arms = " ".join(f"when {i} then '{text}'" for i, text in enumerate(options))
    return f"case {number} % {len(options)} {arms} end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(tune(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty table with raw headers, keyed by ``KEYS``."""
    base = table(spark, sf_dir, "lineitem").selectExpr(*BASE_COLUMNS).selectExpr("*", PADDED)
    return base.select(*KEYS, *[F.expr(text).alias(header) for header, (_, text) in RAW.items()])


def raw_extract_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_extract`` plus copies of some rows, part of them with BET restated in another unit."""
    raw = raw_extract(spark, sf_dir)
    restated = F.when(
        F.col("p") % 4 == 0,
        F.concat((F.regexp_extract("BET", "[0-9]+", 0).cast("int") * 10000).cast("string"), F.lit(" cm²/g")),
    ).otherwise(F.col("BET"))
    copies = raw.where("p % 50 = 0").withColumn("BET", restated)
    columns = [c for c in raw.columns if c not in KEYS]
    rows = raw.withColumn("copy", F.lit(0)).unionByName(copies.withColumn("copy", F.lit(1)))
    return rows.select(*COPY_KEYS, *[F.col(f"`{c}`") for c in columns])


def header_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per order, each with its own header row: (table_id, position, raw_header)."""
    entries = [
        F.struct(F.lit(i).alias("position"), F.expr(raw_header_case(h, "o_orderkey")).alias("raw_header"))
        for i, h in enumerate(RAW)
    ]
    orders = table(spark, sf_dir, "orders")
    # an array made by a projection is made by compiled code, one inside a generator is not
    return orders.select(F.col("o_orderkey").alias("table_id"), F.array(*entries).alias("_row")).select("table_id", F.inline_outer("_row"))


def raw_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_extract`` cell by cell, with the header spelling of its table (the order)."""
    base = table(spark, sf_dir, "lineitem").selectExpr(*BASE_COLUMNS).selectExpr("*", PADDED)
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.expr(raw_header_case(h, "k")).alias("raw_header"),
            F.expr(text).alias("raw_value"),
        )
        for i, (h, (_, text)) in enumerate(RAW.items())
    ]
    return base.select(*KEYS, F.array(*entries).alias("_row")).select(*KEYS, F.inline_outer("_row"))
