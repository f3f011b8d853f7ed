"""Quality by gradient-boosted trees over statistics of a document.

Each text becomes a short row of numbers: shares of kinds of bytes, shapes of words and lines, how
often words, word pairs and lines come again, how well the text compresses. The trees are grown on histograms:
every statistic is cut at quantiles into at most ``BINS`` bins, a split is chosen from sums of gradients
by bin, and all nodes of a level are split at once. A model is four flat arrays, trees by nodes in heap
order, and a batch of documents goes down all trees together, a level at a time.

Statistics are computed by Spark over whole texts, for the labelled sample as for scoring; only the
sample's numbers, bounded by ``ROWS_PER_CLASS``, come to the driver, where the trees are grown.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, bucket, byte_slices, stored, table

ROWS_PER_CLASS = 10_000  #: bound of the labelled sample: rows of each class that are read
TREES, DEPTH, BINS = 80, 4, 64
RATE, RIDGE, LEAST_WEIGHT, LEAST_GAIN = 0.15, 1.0, 2.0, 1e-3

_KINDS = ("space", "line", "upper", "lower", "digit", "stop", "mark", "symbol", "high", "control")
_CLASS = np.zeros((256, len(_KINDS)))
for _byte in range(256):
    _letter = chr(_byte)
    _kind = (
        "high" if _byte > 127 else "line" if _letter in "\n\r" else "space" if _letter in " \t" else "upper" if _letter.isupper()
        else "lower" if _letter.islower() else "digit" if _letter.isdigit() else "stop" if _letter in ".,;:?!" else "mark" if _letter in "'\"()-"
        else "symbol" if _letter.isprintable() else "control"
    )
    _CLASS[_byte, _KINDS.index(_kind)] = 1

_MARKED = re.compile(rb"[^\s\w.,;:?!'\"()\x80-\xff-]")
FEATURES = (
    *(f"{k}_share" for k in _KINDS), "log_bytes", "log_words", "log_lines", "entropy", "packed", "word_length", "word_spread", "longest_word",
    "distinct_words", "common_word", "single_bytes", "upper_words", "first_upper_words", "digit_words", "symbol_words", "stopped_words", "distinct_pairs",
    "distinct_runs", "distinct_lines", "line_length", "line_spread", "common_line", "symbol_kinds", "exclaimed_words",
)


def statistics(data: bytes | None) -> list[float]:
    """The numbers of one text; those that have no meaning for a text without bytes, words or lines are -1."""
    data = data or b""
    n = len(data)
    if not n:
        return [-1.0] * len(_KINDS) + [0.0, 0.0, 0.0] + [-1.0] * (len(FEATURES) - len(_KINDS) - 3)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    p = counts[counts > 0] / n
    out = [*((counts @ _CLASS) / n).tolist()]
    words, lines = data.split(), [x for x in data.splitlines() if x.strip()]
    w, k = len(words), len(lines)
    out += [math.log1p(n), math.log1p(w), math.log1p(k), float(-(p * np.log2(p)).sum()), len(zlib.compress(data, 1)) / (n + 20)]
    if not w:
        return out + [-1.0] * (len(FEATURES) - len(out))
    sizes = np.fromiter(map(len, words), np.int64, w)
    seen = Counter(words)
    distinct = list(seen.items())
    share = lambda test: sum(m for x, m in distinct if test(x)) / w
    kinds = {x: _MARKED.search(x) is not None for x in seen}
    out += [
        float(sizes.mean()), float(sizes.std()), float(sizes.max()), len(seen) / w, max(seen.values()) / w, float((sizes == 1).mean()),
        share(bytes.isupper), share(lambda x: x[:1].isupper()), share(lambda x: x.isdigit()), share(kinds.__getitem__),
        share(lambda x: x[-1:] in b".,;:?!"), len(set(zip(words, words[1:]))) / max(1, w - 1), len(set(zip(words, words[1:], words[2:]))) / max(1, w - 2),
    ]
    of_line = Counter(lines)
    length = np.fromiter(map(len, lines), np.int64, k)
    out += [len(of_line) / k, float(length.mean()), float(length.std() / length.mean()), max(of_line.values()) / k]
    return [*out, float((counts[33:127] > 0).sum()), share(lambda x: x.endswith(b"!!"))]


def statistics_of(texts: list[bytes | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass(frozen=True)
class Trees:
    """Trees by nodes in heap order: inner nodes' statistic and cut (at most the cut goes left), and leaf values."""

    feature: np.ndarray  #: [trees, 2 ** depth - 1]
    cut: np.ndarray  #: [trees, 2 ** depth - 1]; infinite where a node isn't split
    leaf: np.ndarray  #: [trees, 2 ** depth]
    base: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of every row; all trees at once, a level at a time."""
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(rows), self.base)
        start, feature, cut = np.arange(trees) * inner, self.feature.ravel(), self.cut.ravel()
        out = np.empty(len(rows))
        for at in range(0, len(rows), 1_024):
            own = rows[at : at + 1_024]
            flat, first = own.ravel(), (np.arange(len(own)) * own.shape[1])[:, None]
            node = np.zeros((len(own), trees), np.int64)
            while node[0, 0] < inner:
                here = start + node
                node = 2 * node + 1 + (flat[first + feature[here]] > cut[here])
            out[at : at + 1_024] = self.base + self.leaf.ravel()[np.arange(trees) * (inner + 1) + node - inner].sum(1)
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(rows), -50, 50)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Values between which the bins lie: halfway between neighbours, at quantiles where there are too many."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def grow(rows: np.ndarray, y: np.ndarray, weight: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boosted trees of weighted logistic loss; ties go to the first statistic and the lowest cut."""
    n, features = rows.shape
    share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)) if n else 0.5
    base, inner = math.log(share / (1 - share)), 2**depth - 1
    flat = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if not n or y.min() == y.max():
        return flat
    cuts = [_cuts(rows[:, f], bins) for f in range(features)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)])  # value <= cut: at most its number
    raw = np.full(n, base)
    grown: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, cut, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            total_g, total_h = np.bincount(at - first, g, width), np.bincount(at - first, h, width)
            best = np.full(width, LEAST_GAIN)
            bin_of = np.full(width, bins, np.int64)
            for f in range(features):
                size = len(cuts[f]) + 1
                if size == 1:
                    continue
                place = (at - first) * size + binned[f]
                left_g, left_h = (np.bincount(place, x, width * size).reshape(width, size).cumsum(1)[:, :-1] for x in (g, h))
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - (total_g**2 / (total_h + RIDGE))[:, None]
                gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(width), top] > best + 1e-9
                best = np.where(better, gain[np.arange(width), top], best)
                bin_of = np.where(better, top, bin_of)
                node = first + np.flatnonzero(better)
                feature[node], cut[node] = f, cuts[f][top[better]]
            right = binned[feature[at], np.arange(n)] > bin_of[at - first]
            at = 2 * at + 1 + right
        own = at - inner
        leaf = rate * np.bincount(own, g, inner + 1) / (np.bincount(own, h, inner + 1) + RIDGE)
        raw += leaf[own]
        grown.append((feature, cut, leaf))
    return Trees(*(np.stack(x) for x in zip(*grown, strict=True)), base)


def _sample(labelled: DataFrame, rows_per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """Up to about ``rows_per_class`` keys of each class, picked by a hash of the key; the rows that one of a class stands for."""
    sizes = {r["y_"]: r["count"] for r in labelled.groupBy("y_").count().collect()}  # two rows
    part = {c: min(1.0, rows_per_class / max(1, sizes.get(c, 0))) for c in (0, 1)}
    draw = F.pmod(F.xxhash64(F.lit("quality"), F.col("k_").cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(draw < F.when(F.col("y_") == 1, part[1]).otherwise(part[0])), {c: 1 / x for c, x in part.items()}


def fit(
    documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", rows_per_class: int = ROWS_PER_CLASS,
    trees: int = TREES,
) -> Trees:
    """Trees grown on the documents that ``labels`` covers.

    At most about ``rows_per_class`` rows of each class are read as a sample (documented bound), each
    with the weight of the rows it stands for. Equal texts with equal labels teach once, so that a group
    of copies weighs no more than one text. Rows with a null key, text or label teach nothing; a document
    labelled both ways counts both ways. Without rows of both classes every text scores the share of
    good ones, one half where there are none.
    """
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("k_"), F.col(label).cast("int").alias("y_")).distinct()
    picked, stands = _sample(marked, rows_per_class)
    rows = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("k_"), F.col(text).alias("t_"))
    rows = rows.join(F.broadcast(picked), "k_").select("y_", "t_").dropDuplicates(["y_", "t_"])

    def run(batches: Batches):
        for batch in byte_slices(batches, 1):
            found = statistics_of(batch.column(1).cast(pa.binary()).to_pylist())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))], names=["y", "x"])

    points = stored(rows.mapInArrow(run, "y int, x array<double>"), "quality-sample").orderBy("y", "x").toArrow()
    y = points.column("y").to_numpy().astype(float)
    x = points.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) if len(y) else np.zeros((0, len(FEATURES)))
    return grow(x, y, np.where(y == 1, stands[1], stands[0]) / max(1.0, min(stands.values())), trees=trees)


def score(documents: DataFrame, model: Trees, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and score (0 to 1, higher: better) of every row, whole texts, one scan without a shuffle.

    Null and empty texts have the statistics of a text without bytes. Null or repeated keys make no
    difference; other columns are left out, so their names cannot clash.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # trees by nodes, whatever the data

    def run(batches: Batches):
        for batch in byte_slices(batches, 1):
            found = shared.value.score(statistics_of(batch.column(1).cast(pa.binary()).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=[key, "score"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, score double")


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = F.coalesce(bucket("doc_id", 1, 3), F.lit(False))
    scored = score(documents, fit(documents.where(~held_out), labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
