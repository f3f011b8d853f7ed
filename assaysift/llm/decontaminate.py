"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is found in a document when at least ``CONTAINMENT`` of its distinct word shingles are there.
The items are partitioned by size (powers of two), and a partition of items up to u shingles keeps the
smallest floor((1 - CONTAINMENT) * u) + 1 hashes of each item as its MinHash signature, one value a
band. An item that a document contains may lack at most floor((1 - CONTAINMENT) * n) shingles there, so
at least one value of its signature is among the document's: no document is missed, however much longer
it is than the item. Documents too small for a partition skip it. Candidates are verified by exact
containment of the shingles' words. Documents are scanned once for each block of the benchmark, whose
size is bounded; only pairs found leave a task.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Batches, BoundedCache, ngram_hashes, parts_for, slices, table, worker_cache

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_CHARS = 4_000_000  #: a block of the benchmark holds about this much text and is broadcast

_WORDS = re.compile(r"\w+")
_TOP_BITS = 20


def _word_hashes() -> BoundedCache:
    return worker_cache("decontaminate", lambda: BoundedCache(xxhash.xxh3_64_intdigest))


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORDS.findall(text.lower())


def _hashes(words: list[str], n: int) -> np.ndarray:
    return ngram_hashes(np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words)), n)


class ContainmentIndex:
    """Signatures of one block of items, by shingle length and size partition."""

    def __init__(self, items: list[tuple[object, str | None]], shingle: int, containment: float):
        self.containment = containment
        self.items: list[tuple[object, int, frozenset[tuple[str, ...]]]] = []
        signatures: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for key, text in items:
            words = words_of(text) if text else []
            if not words:
                continue
            n = min(shingle, len(words))
            grams = dict(zip(_hashes(words, n).tolist(), zip(*(words[i:] for i in range(n)), strict=False), strict=True))
            size = len(set(grams.values()))
            upper = 1 << (size - 1).bit_length()
            for value in sorted(grams)[: math.floor((1 - containment) * upper + 1e-9) + 1]:
                signatures[n, upper].append((value, len(self.items)))
            self.items.append((key, n, frozenset(grams.values())))
        self.partitions = []
        for (n, upper), entries in sorted(signatures.items()):
            entries.sort()
            values = np.array([v for v, _ in entries], np.uint64)
            top = np.zeros(1 << _TOP_BITS, bool)
            top[(values >> np.uint64(64 - _TOP_BITS)).astype(np.int64)] = True
            self.partitions.append((n, max(1, math.ceil(containment * (upper // 2 + 1) - 1e-9)), values, [i for _, i in entries], top))
        self.lengths = sorted({p[0] for p in self.partitions})

    def search(self, text: str | None) -> list[tuple[object, int, int]]:
        """(item, its shingles, those found) for every item the text contains."""
        words = words_of(text) if text else []
        found, grams = [], {}
        hashes = {n: _hashes(words, n) for n in self.lengths if n <= len(words)}
        candidates: set[int] = set()
        for n, least, values, owners, top in self.partitions:
            own = hashes.get(n)
            if own is None or len(own) < least:
                continue
            near = own[top[(own >> np.uint64(64 - _TOP_BITS)).astype(np.int64)]]
            left, right = np.searchsorted(values, near, "left"), np.searchsorted(values, near, "right")
            for a, b in zip(left.tolist(), right.tolist(), strict=True):
                candidates.update(owners[a:b])
        for i in sorted(candidates):
            key, n, shingles = self.items[i]
            if n not in grams:
                grams[n] = set(zip(*(words[j:] for j in range(n)), strict=False))
            shared = len(shingles & grams[n])
            if shared >= self.containment * len(shingles) - 1e-9:
                found.append((key, len(shingles), shared))
        return found


def _blocks(benchmark: DataFrame, key: str, text: str, shingle: int, containment: float, block_chars: int) -> list[ContainmentIndex]:
    """The benchmark in blocks of about ``block_chars`` characters each."""
    items = benchmark.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = parts_for(total, block_chars)
    part = F.pmod(F.xxhash64("key", "text"), F.lit(n))
    rows = (items.where(part == i).select("key", "text").distinct().collect() for i in range(n))
    return [ContainmentIndex([(r["key"], r["text"]) for r in sorted(block, key=str)], shingle, containment) for block in rows]


def contained_items(
    documents: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    shingle: int = SHINGLE, containment: float = CONTAINMENT, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document row and item found in it: key, item key, n_shingles, n_shared, containment.

    An item of fewer words than a shingle is one shingle of all its words. Null, empty and wordless texts
    of either side match nothing; items of one key and text count once, items of a null key are searched
    too. Repeated documents each get their rows. Other columns are left out.
    """
    kinds = T.StructType([
        T.StructField(key, documents.schema[key].dataType), T.StructField(item_key, benchmark.schema[item_key].dataType),
        T.StructField("n_shingles", T.LongType()), T.StructField("n_shared", T.LongType()), T.StructField("containment", T.DoubleType()),
    ])
    item_type = kinds[item_key].dataType

    def scan(index: ContainmentIndex) -> DataFrame:
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(batches: Batches):
            from pyspark.sql.pandas.types import to_arrow_type

            kind = to_arrow_type(item_type)
            for batch in slices(batches):
                rows = [(i, *hit) for i, t in enumerate(batch.column(1).to_pylist()) for hit in shared.value.search(t)]
                owner, item, size, held = zip(*rows, strict=True) if rows else ((), (), (), ())
                size, held = pa.array(size, pa.int64()), pa.array(held, pa.int64())
                ratio = pa.compute.divide(held.cast(pa.float64()), size.cast(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(item, kind), size, held, ratio], names=kinds.names
                )

        return documents.select(key, text).mapInArrow(run, kinds)

    blocks = _blocks(benchmark, item_key, item_text, shingle, containment, block_chars)
    return reduce(DataFrame.unionByName, [scan(index) for index in blocks])


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, *, shingle: int = SHINGLE, containment: float = CONTAINMENT, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Pipeline stage: the rows of ``documents`` that contain no benchmark item, all columns kept, no shuffle."""
    for index in _blocks(benchmark, "item_id", "text", shingle, containment, block_chars):
        shared = documents.sparkSession.sparkContext.broadcast(index)

        def run(batches: Batches, shared=shared):
            for batch in slices(batches):
                texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
                yield batch.filter(pa.array([not shared.value.search(t) for t in texts], pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SHINGLES = """
    SELECT {key}, unnest(CASE WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS g
    FROM (SELECT {key}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM {table}) WHERE len(w) > 0
"""
ORACLE_SQL = f"""
WITH items AS (SELECT DISTINCT item_id, g FROM ({_SHINGLES.format(key="item_id", table="benchmark")})),
sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY 1),
docs AS (SELECT DISTINCT doc_id, g FROM ({_SHINGLES.format(key="doc_id", table="documents")}) WHERE g IN (SELECT g FROM items)),
shared AS (SELECT doc_id, item_id, count(*) AS k FROM docs JOIN items USING (g) GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_shingles, k AS n_shared, k / n AS containment
FROM shared JOIN sizes USING (item_id) WHERE k >= 0.8 * n - 1e-9
"""
