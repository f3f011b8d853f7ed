"""Packing of tokenized documents into sequences by best-two-fit.

Each task encodes its texts and cuts those longer than a sequence; only lengths and checksums travel
on. The pieces are dealt at random into groups of about ``GROUP_ROWS``, so that no group grows with the
data, and each group is packed by itself: fill a bin with the longest piece that fits, again and again;
then, if a gap is left, replace the bin's smallest piece with two unpacked ones that fit the expanded
gap more tightly. A group leaves at most a few bins part empty, whatever the number of groups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, free_name, parts_for, slices, stored, table
from .tokens import TOKENIZER, encode

CAPACITY = 2048
GROUP_ROWS = 65_536
_END = (0).to_bytes(4, "little")


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; lengths are from 1 to ``capacity``.

    Lengths still unpacked are the bits of one number (and, mirrored, of another), so the longest that
    fits and the pairs of a given sum are found without scanning pieces.
    """
    order = np.argsort(lengths, kind="stable")
    stacks: dict[int, list[int]] = {}
    for at, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        stacks.setdefault(size, []).append(at)
    there = mirrored = 0
    for size in stacks:
        there |= 1 << size
        mirrored |= 1 << (capacity - size)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def take(size: int) -> int:
        nonlocal there, mirrored
        at = stacks[size].pop()
        if not stacks[size]:
            there &= ~(1 << size)
            mirrored &= ~(1 << (capacity - size))
        return at

    def put_back(size: int, at: int) -> None:
        nonlocal there, mirrored
        stacks[size].append(at)
        there |= 1 << size
        mirrored |= 1 << (capacity - size)

    def tightest_pair(most: int, above: int) -> tuple[int, int] | None:
        for total in range(most, above, -1):
            pairs = there & (mirrored >> (capacity - total))
            if total % 2 == 0 and pairs >> (total // 2) & 1 and len(stacks[total // 2]) < 2:
                pairs &= ~(1 << (total // 2))
            if pairs:
                longer = pairs.bit_length() - 1
                return longer, total - longer
        return None

    number = 0
    while there:
        filled, gap = [], capacity
        while fitting := there & ((2 << gap) - 1):
            size = fitting.bit_length() - 1
            filled.append((size, take(size)))
            gap -= size
        if gap and there:
            smallest, at = filled[-1]
            if pair := tightest_pair(gap + smallest, smallest):
                filled[-1:] = [(size, take(size)) for size in pair]
                put_back(smallest, at)
        start = 0
        for size, at in filled:
            bins[at], offsets[at] = number, start
            start += size
        number += 1
    return bins, offsets


def pieces(documents: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Key, piece, start, length and ids_crc32 of every piece: a document's ids, then id 0, cut at ``capacity``."""

    def run(batches: Batches):
        for batch in slices(batches):
            owner, piece, start, length, crc = [], [], [], [], []
            for row, data in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                ids = (encode(data, tokenizer) if data else b"") + _END
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    owner.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(cut: DataFrame, *, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``cut`` with sequence_id and offset; its ``length`` must be from 1 to ``capacity``, other columns pass through.

    The pieces are stored first, which fixes the row numbers that deal them out and gives their count.
    """
    number, dealt = free_name(cut.columns, "_row"), free_name(cut.columns, "_group")
    numbered = stored(cut.withColumn(number, F.monotonically_increasing_id()), "pieces")
    groups = parts_for(numbered.count(), group_rows)
    grouped = numbered.withColumn(dealt, F.pmod(F.xxhash64(F.col(number)), F.lit(groups)))

    def run(group: pa.Table) -> pa.Table:
        bins, offsets = best_two_fit(group["length"].to_numpy().astype(np.int64), capacity)
        sequences = (group[dealt][0].as_py() << 32) + bins
        return group.drop_columns([number, dealt]).append_column("sequence_id", pa.array(sequences)).append_column("offset", pa.array(offsets))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return grouped.groupBy(dealt).applyInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """One row per piece, with its place. A null or empty text is the one id 0; every row is packed, repeated ones too."""
    return pack(pieces(documents, key=key, text=text, tokenizer=tokenizer, capacity=capacity), capacity=capacity, group_rows=group_rows)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
