"""Writers. A sink is a folder of part files, written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import column
from .scratch import CODEC

_NESTED = (T.ArrayType, T.MapType, T.StructType)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Parquet by default; CSV keeps its header when there are no rows and leaves nulls empty."""
    if fmt == "parquet":
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
    elif fmt == "csv":
        (
            df.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "")
            .option("nullValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
        )
    else:
        raise ValueError(f"cannot write {fmt!r}: use parquet or csv")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; text is kept as UTF-8."""
    df.write.mode("overwrite").json(path)


def write_text(spark: SparkSession, lines: list[str], path: str) -> None:
    """A short text file, written through Spark so that any file system works."""
    entries = F.array(*[F.lit(line) for line in lines])
    spark.range(1, numPartitions=1).select(F.explode(entries).alias("value")).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def csv_ready(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, everything else as it is."""
    return df.select(
        *[
            F.to_json(column(f.name)).alias(f.name) if isinstance(f.dataType, _NESTED) else column(f.name)
            for f in df.schema.fields
        ]
    )
