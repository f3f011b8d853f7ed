"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaysift.sources.scratch import materialise

Batches = Iterator[pa.RecordBatch]

_LETTERS = re.compile(r"[^\W\d_]+")


def slices(batches: Batches, rows: int = 500) -> Batches:
    """The batches in short pieces, so that few texts at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(batches: Batches, column: int = 0, size: int = 2_000_000, rows: int = 2_000) -> Batches:
    """The batches in pieces of at most ``rows`` rows and about ``size`` bytes of text in ``column``; a longer text is a piece of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for at, n in enumerate(lengths.tolist()):
            if at > start and (held + n > size or at - start >= rows):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def letter_runs(text: str) -> list[str]:
    """Lower-cased maximal runs of letters."""
    return _LETTERS.findall(text.lower())


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble (splitmix finaliser), so that equal inputs only give equal outputs."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of every run of ``n`` words, from the 64-bit hashes of the words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + m])
    return h


_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return array("I", ids).tobytes() if _NATIVE else np.array(ids, "<u4").tobytes()


class BoundedCache(dict):
    """A dict that computes what it lacks and holds at most ``limit`` entries or, of byte values, about ``size`` bytes.

    Entries are kept in two generations: when the young one is half of that, it becomes the old one, and what
    was old and not asked for again goes. So frequent keys stay, however many rare ones pass through.
    Byte values over a hundredth of ``size`` are not kept.
    """

    def __init__(self, make: Callable, limit: int = 300_000, size: int = 64_000_000):
        super().__init__()
        self.make, self.limit, self.size, self.held, self.old = make, limit, size, 0, {}

    def __missing__(self, key):
        value = self.old.get(key, self)
        if value is self:
            value = self.make(key)
        more = len(value) + 150 if isinstance(value, bytes) else 0
        if more * 100 > self.size:
            return value
        if len(self) * 2 >= self.limit or (self.held + more) * 2 > self.size:
            self.old = self.copy()
            self.clear()
            self.held = 0
        self.held += more
        self[key] = value
        return value


_live: dict = {}


def worker_cache(name, make: Callable):
    """What ``make`` gives, kept while this Python worker serves one operator.

    Workers are reused from stage to stage; asking for another operator's cache drops the last one.
    """
    if name not in _live:
        if _live:
            _live.clear()
            give_back()
        _live[name] = make()
    return _live[name]


def give_back() -> None:
    """Return freed memory to the system: Python's and Arrow's pools and the C heap keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


_shared: list[Broadcast] = []


def shared(spark: SparkSession, value) -> Broadcast:
    """A broadcast that ``drop_shared`` may take from the executors once its stage is written."""
    _shared.append(spark.sparkContext.broadcast(value))
    return _shared[-1]


def drop_shared() -> None:
    """Take the models of earlier stages from the executors; a task that needs one fetches it again."""
    while _shared:
        _shared.pop().unpersist()


def free_name(taken: list[str], name: str) -> str:
    """``name``, or the first longer one that no column has, upper and lower case alike."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def bucket(key: Column | str, residue: int, modulus: int) -> Column:
    """Whether crc32 of the key as text leaves ``residue``; null for a null key."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string")) % modulus == residue


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    return materialise(df, f"llm-{label}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(rows: int, per_part: int) -> int:
    """As many parts as keep each near ``per_part`` rows; at least one."""
    return max(1, -(-rows // per_part))
