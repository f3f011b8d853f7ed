"""Language-model scores by stupid backoff against the corpus itself, computed relationally.

Each task packs its documents into blocks of bounded size, which are stored once, compressed. A block
lists its distinct n-grams of each order as sorted hashes with their counts, cut into buckets by hash
range. A bucket of an order meets the slices of all blocks: together they are its part of the n-gram
count table, which it sums and joins back to the n-grams each block has exploded. A frequent n-gram comes
once a block, however often it occurs. Each block then scores its documents and sums per document. A
document's own n-grams are taken off the counts, so a text is scored by what the rest of the corpus
holds; copies elsewhere do count. Hashes have ``HASH_BYTES`` bytes: of 10^13 distinct n-grams one in
7,000 shares its count with another, of 10^10 one in 7,000,000.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, BoundedCache, byte_slices, give_back, ngram_hashes, parts_for, stored, table, worker_cache

ORDER = 3
BACKOFF = 0.4
BLOCK_CHARS = 10_000_000  #: a block of texts, its words and their n-grams are in one task at a time
BUCKET_CHARS = 8_000_000  #: about so many characters of the corpus per bucket of the count table
HASH_BYTES = 7


def _word_hashes() -> BoundedCache:
    return worker_cache("lm_score", lambda: BoundedCache(xxhash.xxh3_64_intdigest))


def _bounds(buckets: int) -> np.ndarray:
    """First hash of every bucket but the first."""
    return np.array([-(-(i << 8 * HASH_BYTES) // buckets) for i in range(1, buckets)], np.uint64)


def _planes(values: np.ndarray, width: int = 8) -> bytes:
    """Whole numbers byte by byte, all lowest bytes first, so that the codec finds like bytes side by side."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress(planes)


def _from_planes(data: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, :width] = planes.T
    return values.view("<u8").ravel()


def _blob(pieces: list[pa.RecordBatch]) -> bytes:
    """Keys and texts of a block, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pieces[0].schema) as writer:
        for piece in pieces:
            writer.write_batch(piece)
    return zstandard.ZstdCompressor(level=5).compress(sink.getvalue())


def _opened(blob: bytes) -> tuple[pa.ChunkedArray, list[str | None]]:
    rows = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()
    return rows.column(0), rows.column(1).to_pylist()


def _dealt(batches: Batches, block_chars: int) -> Batches:
    """The task's rows in blocks of about ``block_chars`` bytes of text; a longer text is a block of its own."""
    first = TaskContext.get().partitionId() << 32
    pieces, held, blocks = [], 0, 0

    def block():
        texts = (t for piece in pieces for t in piece.column(1).to_pylist())
        words = sum(len((t or "").lower().split()) for t in texts)
        columns = [pa.array([first + blocks]), pa.array([held]), pa.array([words]), pa.array([_blob(pieces)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["block", "chars", "n_words", "texts"])

    for piece in byte_slices(batches, column=1, size=max(1, block_chars // 8)):
        size = piece.column(1).nbytes
        if pieces and held + size > block_chars:
            yield block()
            pieces, held, blocks = [], 0, blocks + 1
        pieces.append(piece)
        held += size
    if pieces:
        yield block()


def _grams(texts: list[str | None], order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per order, the hashes at every position of all texts in a row; and the texts' numbers of words."""
    cache = _word_hashes()
    words = [np.fromiter(map(cache.__getitem__, split), np.uint64, len(split)) for split in ((t or "").lower().split() for t in texts)]
    sizes = np.array([len(w) for w in words], np.int64)
    short = np.uint64(64 - 8 * HASH_BYTES)
    return [np.concatenate([ngram_hashes(w, k) for w in words] or [np.empty(0, np.uint64)]) >> short for k in range(1, order + 1)], sizes


def _slices(block: int, blob: bytes, order: int, buckets: int) -> pa.RecordBatch:
    rows = []
    grams, _ = _grams(_opened(blob)[1], order)
    for k in range(1, order + 1):
        distinct, counts = np.unique(grams[k - 1], return_counts=True)
        grams[k - 1] = None
        cuts = [0, *np.searchsorted(distinct, _bounds(buckets)).tolist(), len(distinct)]
        for bucket, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if b > a:
                steps = np.diff(distinct[a:b], prepend=np.uint64(0))  # sorted, so steps are shorter than the hashes
                rows.append((bucket, k, block, _planes(steps, HASH_BYTES), _planes(counts[a:b])))
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bucket", "k", "block", "hashes", "counts"])


def _totals(slices: pd.DataFrame) -> pd.DataFrame:
    """The bucket's part of an order's count table, joined to every slice: totals in the slice's order."""
    hashes = [np.cumsum(_from_planes(h, HASH_BYTES), dtype=np.uint64) for h in slices["hashes"]]
    sizes = [len(h) for h in hashes]
    hashes = np.concatenate(hashes)
    counts = np.concatenate([_from_planes(c) for c in slices["counts"]]).astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    sums = np.add.reduceat(counts[order], starts)
    total = counts  # overwritten: the counts are summed
    total[order] = np.repeat(sums, np.diff(np.append(starts, len(hashes))))
    ends = np.cumsum(sizes)
    totals = [_planes(total[b - n : b]) for n, b in zip(sizes, ends.tolist(), strict=True)]
    return pd.DataFrame({"block": slices["block"], "k": slices["k"], "bucket": slices["bucket"], "totals": totals})


def _others(hashes: np.ndarray, text: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Per position, the occurrences of its n-gram outside its text, from the totals of the sorted distinct n-grams."""
    distinct, inverse = np.unique(hashes, return_inverse=True)
    if len(distinct) != len(totals):
        raise ValueError("a block's totals are not those of its n-grams")
    pair = text * np.int64(max(1, len(distinct))) + inverse
    rest = totals[inverse]
    del hashes, distinct, inverse
    _, pair_at, own = np.unique(pair, return_inverse=True, return_counts=True)
    return rest - own[pair_at]


def _score(block: pd.DataFrame, answers: pd.DataFrame, order: int, backoff: float, mass: int) -> pd.DataFrame:
    out = [_scored(blob, answers, order, backoff, mass) for blob in block["texts"]]  # one, as blocks have numbers of their own
    give_back()
    return pd.concat(out, ignore_index=True)


def _scored(blob: bytes, answers: pd.DataFrame, order: int, backoff: float, mass: int) -> pd.DataFrame:
    keys, texts = _opened(blob)
    grams, sizes = _grams(texts, order)
    del texts
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(text)) - (np.cumsum(sizes) - sizes)[text]
    value, shorter = np.empty(0), np.empty(0, np.int64)
    for k in range(1, order + 1):
        mine = answers[answers["k"] == k].sort_values("bucket")
        totals = np.concatenate([_from_planes(t) for t in mine["totals"]] or [np.empty(0, "<u8")]).astype(np.int64)
        has = place >= k - 1
        others = _others(grams[k - 1], text[has], totals)
        grams[k - 1] = None
        if k == 1:  # an unseen word gets half an occurrence
            value = np.minimum(np.log(np.maximum(others, 0.5)) - np.log(np.maximum(mass - sizes[text], 1)), 0.0)
        else:
            context = shorter[_histories(place, k)]
            seen = others > 0
            level = value[has] + np.log(backoff)
            level[seen] = np.log(others[seen]) - np.log(context[seen])
            value[has] = level
        shorter = others
    sums = np.bincount(text, value, len(sizes)) if len(text) else np.zeros(len(sizes))
    return pd.DataFrame({"key": keys.to_pandas(), "n_words": sizes, "log_score": sums, "per_word": np.where(sizes > 0, sums / np.maximum(sizes, 1), np.nan)})


def _histories(place: np.ndarray, k: int) -> np.ndarray:
    """Where, among the runs of k - 1 words, those stand that begin a run of k words: all but the last of each text."""
    ends = place[place >= k - 2]  # a run by its last word's place
    return np.append(ends[1:] == ends[:-1] + 1, False) if len(ends) else np.empty(0, bool)


def lm_scores(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF,
    block_chars: int = BLOCK_CHARS, bucket_chars: int = BUCKET_CHARS,
) -> DataFrame:
    """Key, n_words, log_score (sum of natural logs) and per_word of every row, over whole texts.

    Words are lower-cased and split at white space. S(w | h) is count(hw) / count(h) where hw occurs
    outside the document, else ``backoff`` * S(w | shorter h); a single word has count / words, and half
    an occurrence if it has none; the first words of a text have the shorter histories they have. Null,
    empty and blank texts have 0 words, log_score 0 and a null per_word. Repeated rows are documents of
    their own; null keys and further columns make no difference.
    """
    rows = documents.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))  # pandas has no null in whole numbers
    dealt = rows.mapInArrow(lambda b: _dealt(b, block_chars), "block bigint, chars bigint, n_words bigint, texts binary")
    dealt = stored(dealt, "lm-blocks")  # totals are matched by position, so both readers must see the same blocks
    chars, mass = dealt.agg(F.coalesce(F.sum("chars"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    buckets = parts_for(chars, bucket_chars)

    def sliced(batches: Batches):
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield _slices(block, blob.as_py(), order, buckets)

    slices = dealt.select("block", "texts").mapInArrow(sliced, "bucket bigint, k bigint, block bigint, hashes binary, counts binary")
    answers = slices.groupBy("bucket", "k").applyInPandas(_totals, "block bigint, k bigint, bucket bigint, totals binary")
    kind = documents.schema[key].dataType.simpleString()
    scored = dealt.select("block", "texts").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        lambda b, a: _score(b, a, order, backoff, mass), "key string, n_words bigint, log_score double, per_word double"
    )
    return scored.select(F.col("key").cast(kind).alias(key), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("per_word")).alias("per_word"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
