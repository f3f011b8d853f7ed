"""Readers: text tables with string columns only, missing tokens turned into null, and a row index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import column
from . import records
from .scratch import materialise

# Cell texts that a text table uses for "no value" (exact case, no trimming).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL",
    "NaN", "None", "n/a", "nan", "null",
)

_TEXT_FORMATS = ("csv", "txt")
# Offsets of file blocks are broadcast up to this many rows; beyond it they are joined by shuffle,
# split by block, so that no file is gathered in one task.
BROADCAST_BLOCKS = 200_000


def _format_of(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name.rsplit(".", 1)[-1].lower() if "." in name else ""


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, sep: str = ",", multi_line: bool = True
) -> DataFrame:
    """Read ``.csv``, ``.txt`` (comma-separated as well) or ``.parquet`` with a ``row_index`` from 0.

    ``path`` may be a file or a folder of such files. ``multi_line`` lets quoted cells hold
    line breaks, at the price of a scan that looks for them; files are split either way.
    """
    fmt = (fmt or _format_of(path)).lower()
    if fmt in _TEXT_FORMATS:
        return read_text_table(spark, path, sep, multi_line)
    if fmt == "parquet":
        return read_parquet_table(spark, path)
    raise ValueError(f"cannot read {path!r}: use csv, txt or parquet (convert workbooks first)")


def unique_headers(names: Sequence[str | None]) -> list[str]:
    """``a, a`` to ``a, a.1``; a header without text gets a name by its position."""
    taken: set[str] = set()
    out = []
    for i, name in enumerate(names):
        base = name if name else f"Unnamed: {i}"
        candidate, n = base, 0
        while candidate in taken:
            n += 1
            candidate = f"{base}.{n}"
        taken.add(candidate)
        out.append(candidate)
    return out


def null_tokens(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Turn missing-value tokens into null in the listed columns."""
    tokens = [F.lit(t) for t in NULL_TOKENS]
    clean = {c for c in columns}
    return df.select(
        *[
            F.when(~column(c).isin(*tokens), column(c)).alias(c) if c in clean else column(c)
            for c in df.columns
        ]
    )


SURPLUS = "surplus_cells"


def read_text_table(
    spark: SparkSession, path: str, sep: str = ",", multi_line: bool = True, surplus: str = "error", broadcast_blocks: int = BROADCAST_BLOCKS
) -> DataFrame:
    """Comma-separated files with a header row each; the columns of several files meet by name.

    Files are grouped by their header row, of which only the beginnings of the files are read, and
    each distinct header row is one read; columns that a file lacks are null. With ``multi_line``
    a scan of the lines with quotes tells whether a cell holds a line break; only then are records
    cut beforehand (see ``records``), else every line is one. A row with more cells than its header stops the read, or with
    ``surplus="keep"`` leaves its whole record in ``surplus_cells``; missing cells are null.
    """
    if surplus not in ("error", "keep"):
        raise ValueError("surplus must be 'error' or 'keep'")
    groups = _header_groups(spark, path, sep)
    if not groups:
        raise ValueError(f"{path!r} has no header row")
    names = list(dict.fromkeys(name for headers, _ in groups for name in headers))
    # The reader sees positional names, so headers that differ by case only do no harm.
    place = {name: f"c{i}" for i, name in enumerate(names)}
    options = {"sep": sep, "quote": '"', "escape": '"', "encoding": "UTF-8", "columnNameOfCorruptRecord": "_record"}
    places = [[place[h] for h in headers] for headers, _ in groups]
    lines = pairs = None
    if multi_line:
        entries = sorted((file, group) for group, (_, files) in enumerate(groups) for file in files)
        numbered = [(file, no, group) for no, (file, group) in enumerate(entries)]
        lines = records.text_lines(spark, path, spark.createDataFrame(numbered, "file string, no int, header int"))
        pairs = records.split_pairs(lines, sep)
    shown = [F.col(p).alias(n if n != "row_index" else "row_index__duplicate_1") for n, p in place.items()]
    kept = [F.col("_surplus").alias(SURPLUS)] if surplus == "keep" else []
    if pairs and any(breaks for *_, breaks in pairs):
        rows = _record_rows(records.cut_records(lines, sep, pairs), places, options, sep, surplus, broadcast_blocks)
        return null_tokens(rows, list(place.values())).select("row_index", *shown, *kept)
    # No cell holds a line break: every line is a record, and Spark's own reader can split the files.
    parts = [_text_rows(spark.read.options(**options), records.readable(spark, files), at, sep, surplus) for (_, files), at in zip(groups, places)]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    # Written once: the task-local number must not be evaluated twice.
    stored = materialise(null_tokens(rows, list(place.values())), "text")
    return _with_row_index(stored, broadcast_blocks).select("row_index", *shown, *kept)


def _header_groups(spark: SparkSession, path: str, sep: str) -> list[tuple[list[str], list[str]]]:
    """(unique headers, files) of each distinct header row, in the order of their first files."""
    files = sorted(spark.read.text(path).inputFiles())
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, cells in zip(files, records.first_records(spark, files, sep), strict=True):
        if cells is not None:
            groups.setdefault(tuple(_headers_of(cells)), []).append(file)
    return [(list(headers), of) for headers, of in groups.items()]


def _headers_of(cells: Sequence[str | None]) -> list[str]:
    return unique_headers([(c or "").lstrip("\ufeff") for c in cells])


def _text_schema(places: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(p, T.StringType()) for p in (*places, "_record")])


def _surplus(width: int, sep: str, surplus: str) -> Column:
    """The record of a row with more than ``width`` cells: separators outside quotes tell."""
    bare = F.regexp_replace("_record", r'"(?:[^"]|"")*"', "")
    separators = (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep)
    over = F.coalesce(separators >= width, F.lit(False))
    if surplus == "error":
        return F.when(over, F.raise_error(F.concat(F.lit("more cells than headers: "), F.col("_record"))).cast("string"))
    return F.when(over, F.col("_record"))


def _text_rows(reader: DataFrameReader, files: list[str], places: list[str], sep: str, surplus: str) -> DataFrame:
    """Rows of files with one header row, as text; ``_surplus`` is the record of a row with too many cells."""
    raw = reader.options(header=True, enforceSchema=True, multiLine=False).schema(_text_schema(places)).csv(files)
    return raw.select(
        *places,
        _surplus(len(places), sep, surplus).alias("_surplus"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_local"),
    )


def _record_rows(cut: DataFrame, places: list[list[str]], options: dict, sep: str, surplus: str, broadcast_blocks: int) -> DataFrame:
    """Rows of records that were cut beforehand, parsed by Spark's parser, with their row index."""
    splits = cut.groupBy("no", "start").agg(F.count("*").alias("rows"))
    in_file = Window.partitionBy("no").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    running = Window.orderBy("no", "start").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda window: F.coalesce(F.sum("rows").over(window), F.lit(0))
    # A file's first record is its header; the files up to here have as many.
    splits = splits.select("no", "start", before(in_file).alias("in_file"), before(running).alias("overall"), F.dense_rank().over(Window.orderBy("no")).alias("headers"))
    splits = materialise(splits, "blocks")
    splits = F.broadcast(splits) if splits.count() <= broadcast_blocks else splits
    numbered = cut.join(splits, ["no", "start"]).where(F.col("in_file") + F.col("n") > 0)
    numbered = numbered.select("header", (F.col("overall") + F.col("n") - F.col("headers")).alias("row_index"), "record")
    options = options | {"multiLine": "true", "mode": "PERMISSIVE"}
    parts = []
    for header, at in enumerate(places):
        schema = ", ".join(f"{f.name} string" for f in _text_schema(at))
        parsed = numbered.where(F.col("header") == header).select("row_index", F.from_csv("record", schema, options).alias("cells")).select("row_index", "cells.*")
        parsed = parsed.withColumn("_surplus", _surplus(len(at), sep, "keep"))
        if surplus == "error":  # a filter, which no later choice of columns takes away
            stop = F.raise_error(F.concat(F.lit("more cells than headers: "), F.col("_surplus"))).cast("boolean")
            parsed = parsed.where(F.when(F.col("_surplus").isNotNull(), stop).otherwise(True))
        parts.append(parsed.select("row_index", *at, "_surplus"))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _with_row_index(stored: DataFrame, broadcast_blocks: int) -> DataFrame:
    """``row_index`` in file order from task-local numbers: one small row per file block."""
    blocks = stored.groupBy("_file", "_start").agg(F.min("_local").alias("_min"), F.count("*").alias("_n"))
    running = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_file", "_start", "_min", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    offsets = materialise(offsets, "blocks")
    if offsets.count() <= broadcast_blocks:
        offsets = F.broadcast(offsets)
    joined = stored.join(offsets, ["_file", "_start"])
    return joined.withColumn("row_index", F.col("_local") - F.col("_min") + F.col("_offset"))


def read_parquet_table(spark: SparkSession, path: str, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """Parquet with the position of each row; files follow each other by name. Columns keep their types.

    Row counts per file come from the file footers, so nothing is scanned twice.
    """
    raw = spark.read.parquet(path)
    columns = raw.columns
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    placed = raw.select("*", *at, F.col("_metadata.row_index").alias("_local"))
    sizes = raw.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count("*").alias("_n"))
    running = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(sizes.select("_file", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset")), "files")
    if offsets.count() <= broadcast_blocks:
        joined = placed.join(F.broadcast(offsets), "_file")
    else:  # a row of offsets for each block of a file, so that the rows of a file spread over its blocks
        blocks = raw.select(*at).distinct().join(offsets, "_file")
        joined = placed.join(blocks, ["_file", "_start"])
    index = F.col("_offset") + F.col("_local")
    return joined.select(
        index.alias("row_index"),
        *[column(c).alias(c if c != "row_index" else "row_index__duplicate_1") for c in columns],
    )
