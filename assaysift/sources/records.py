"""Records of separated text whose quoted cells may hold line breaks, cut from splits by many tasks.

A split can begin inside a quoted cell, so where its records begin depends on all that comes before.
But a line does only one thing to that question: from either state, outside or inside a quoted cell,
it ends in one of the two. So

1. every split composes its lines into one such pair; only lines with a quote leave the JVM for that,
2. the pairs of a file's splits are composed in order, which gives the state at the start of each split,
3. every split cuts its lines into records; the pieces of a record that runs over its end, one a split
   at most, are joined by a small grouping.

What reaches the driver is some bytes a split, less than Spark's own list of the splits there. Quotes
are read as Spark's reader does: a cell is quoted if it starts with a quote, two quotes inside stand
for one, and a quoted cell with text after its closing quote ends at the next separator or line end.
"""

from __future__ import annotations

import csv
import io
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import materialise

WHOLE, HEAD, MIDDLE, TAIL = range(4)  #: a record, or the last, an inner, the first piece of one that runs over splits
_IN_FLIGHT = 4 << 20  # characters of records that a task holds before it passes them on


class Quotes:
    """What a line does to the state: whether its end is inside a quoted cell."""

    def __init__(self, sep: str):
        mark = re.escape(sep)
        rest = f"[^{mark}]*+" if len(sep) == 1 else f"(?:(?!{mark}).)*+"
        closed = rf'[^"]*+(?:""[^"]*+)*+"{rest}'
        cell = f'(?:"{closed}|(?!"){rest})'
        self._from_outside = re.compile(f"{cell}(?:{mark}{cell})*+", re.S)
        self._from_inside = re.compile(f"{closed}(?:{mark}{cell})*+", re.S)

    def ends_inside(self, line: str, inside: bool) -> bool:
        if '"' not in line:
            return inside
        return (self._from_inside if inside else self._from_outside).fullmatch(line) is None


def text_lines(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """(no, header, start, value): lines with the number and header group of their file and the start of their split.

    ``files`` names them as ``inputFiles`` does.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    return lines.join(F.broadcast(files), "file").select("no", "header", "start", "value")


def readable(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """Names as ``inputFiles`` gives them, as paths that a reader takes: decoded, and without patterns."""
    jvm = spark.sparkContext._jvm
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString()) for f in files]


def split_pairs(lines: DataFrame, sep: str) -> list[tuple[int, int, bool, bool, bool]]:
    """(file number, start, state from outside, state from inside, whether a cell may hold a line break) of splits with quotes, in order.

    Where no line ends inside when it begins outside, none does, and every line is a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, rows = Quotes(sep), {}
        for batch in batches:
            for no, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair = rows.setdefault((no, start), [False, True, False])
                outside, inside = quotes.ends_inside(line, False), quotes.ends_inside(line, True)
                pair[0], pair[1], pair[2] = (inside if pair[0] else outside), (inside if pair[1] else outside), pair[2] or outside or "\r" in line[:-1]
        kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        found = [(*at, *pair) for at, pair in rows.items()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names=["no", "start", "outside", "inside", "breaks"])

    kind = "no int, start bigint, outside boolean, inside boolean, breaks boolean"
    quoted = lines.where(F.contains("value", F.lit('"'))).select("no", "start", "value")
    return sorted(map(tuple, quoted.mapInArrow(run, kind).collect()))  # a row a split


def open_ends(pairs: Sequence[tuple[int, int, bool, bool, bool]]) -> dict[int, tuple[list[int], list[bool]]]:
    """By file number: the splits with quotes, and the state after each, composed from the file's beginning."""
    states: dict[int, tuple[list[int], list[bool]]] = {}
    for no, start, outside, inside, _ in pairs:
        starts, ends = states.setdefault(no, ([], []))
        ends.append(inside if ends and ends[-1] else outside)
        starts.append(start)
    return states


def begins_inside(states: dict[int, tuple[list[int], list[bool]]], no: int, start: int) -> bool:
    """The state at the start of a split: that after the last split with quotes before it."""
    starts, ends = states.get(no, ((), ()))
    before = bisect_left(starts, start)
    return bool(before and ends[before - 1])


def _pieces(lines: DataFrame, sep: str, pairs: Sequence[tuple[int, int, bool, bool, bool]]) -> DataFrame:
    """(no, header, start, n, kind, record) of every record or piece; ``n`` counts the records that begin in a split."""
    shared = lines.sparkSession.sparkContext.broadcast(open_ends(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes, states = Quotes(sep), shared.value
        out: list[tuple] = []
        held: list[str] = []
        split, inside, n, kind, size = None, False, 0, WHOLE, 0

        def passed_on() -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["no", "header", "start", "n", "kind", "record"])
            out.clear()
            return batch

        for batch in batches:
            for no, header, start, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if split != (no, header, start):
                    if held:  # the last split ended within a record
                        out.append((*split, n if kind == WHOLE else -1, TAIL if kind == WHOLE else MIDDLE, "\n".join(held)))
                        held = []
                    split, n, inside = (no, header, start), 0, begins_inside(states, no, start)
                    kind = HEAD if inside else WHOLE
                if not held and not inside and not line.strip("\r"):
                    continue
                held.append(line)
                inside = quotes.ends_inside(line, inside)
                if not inside:
                    record = "\n".join(held)
                    out.append((*split, n if kind == WHOLE else -1, kind, record.removesuffix("\r")))
                    n, size, held, kind = n + (kind == WHOLE), size + len(record), [], WHOLE
                    if size > _IN_FLIGHT:
                        yield passed_on()
                        size = 0
        if held:
            out.append((*split, n if kind == WHOLE else -1, TAIL if kind == WHOLE else MIDDLE, "\n".join(held)))
        if out:
            yield passed_on()

    return lines.mapInArrow(run, "no int, header int, start bigint, n bigint, kind int, record string")


def cut_records(lines: DataFrame, sep: str, pairs: Sequence[tuple[int, int, bool, bool, bool]]) -> DataFrame:
    """(no, header, start, n, record): every record under the split in which it begins, the ``n``-th there. Stored once.

    Blank lines outside quoted cells are no records; a cell that is never closed goes on to the end of its file.
    """
    stored = materialise(_pieces(lines, sep, pairs), "records")
    whole = stored.where(F.col("kind") == WHOLE).drop("kind")
    # Pieces follow each other by split, the last of one record before the first of the next; a file has two a split at most.
    order = Window.partitionBy("no").orderBy("start", "kind")
    pieces = stored.where(F.col("kind") != WHOLE).withColumn("of", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    first = lambda c: F.min_by(c, F.struct("start", "kind")).alias(c)
    texts = F.array_sort(F.collect_list(F.struct("start", "kind", "record")))
    joined = pieces.groupBy("no", "of").agg(first("header"), first("n"), F.min("start").alias("start"), texts.alias("texts"))
    return whole.unionByName(joined.select("no", "header", "start", "n", F.array_join("texts.record", "\n").alias("record")))


def first_records(spark: SparkSession, files: Sequence[str], sep: str) -> list[list[str] | None]:
    """The cells of each file's first record, or None where it has none; reads the beginnings of the files only.

    The lines come through Hadoop's file systems and codecs on the driver, which lists the files as well.
    """
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(configuration)
    quotes, out = Quotes(sep), []
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = path.getFileSystem(configuration).open(path)
        codec = codecs.getCodec(path)
        reader = jvm.org.apache.hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream, bytearray(b"\n"))
        line, held, inside = jvm.org.apache.hadoop.io.Text(), [], False
        while reader.readLine(line) > 0:
            text = line.toString()
            if held or text.strip("\r"):
                held.append(text)
                inside = quotes.ends_inside(text, inside)
                if not inside:
                    break
        reader.close()
        cells = next(csv.reader(io.StringIO("\n".join(held).removesuffix("\r"), newline=""), delimiter=sep), []) if held else None
        out.append(cells)
    return out
