"""Run queries and their SQL side by side: ``python tests/check_oracles.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, plain objects, rows sorted."""
    out = df[sorted(df.columns)].copy()
    for c in out.columns:
        if pd.api.types.is_bool_dtype(out[c]):
            out[c] = out[c].astype("object").map(lambda v: None if pd.isna(v) else str(bool(v)))
        elif pd.api.types.is_numeric_dtype(out[c]):
            out[c] = out[c].astype("float64").map(lambda v: None if pd.isna(v) else repr(float(v)))
        else:
            out[c] = out[c].map(lambda v: None if v is None or v is pd.NA or v != v else str(v))
    out = out.fillna("\0null").astype(str)
    return out.sort_values(list(out.columns), ignore_index=True)


def same(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    """Empty text when both hold the same rows, otherwise what differs."""
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    a, b = canonical(spark_df), canonical(sql_df)
    if a.equals(b):
        return ""
    rows = (a != b).any(axis=1)
    columns = [c for c in a.columns if (a[c] != b[c]).any()]
    return f"{rows.sum()} rows differ in {columns}:\n{a[rows][columns].head(3)}\n{b[rows][columns].head(3)}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for name in names:
        start = time.time()
        got = queries()[name](spark, sf_dir).toPandas()
        took = time.time() - start
        if name not in sql:
            print(f"{name:28s} {took:6.2f}s rows {len(got)} (no SQL)", flush=True)
            continue
        start = time.time()
        try:
            verdict = same(got, con.execute(sql[name]).df())
        except Exception as e:  # noqa: BLE001
            verdict = f"SQL failed: {str(e)[:600]}"
        bad += bool(verdict)
        print(f"{name:28s} {took:6.2f}s sql {time.time() - start:6.2f}s rows {len(got)} {'ok' if not verdict else verdict}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
