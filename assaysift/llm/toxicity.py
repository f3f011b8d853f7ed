"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated models, one of toxic and one of ordinary labelled documents, are counted with Spark
over samples of the labelled rows, at three depths: pairs of words, words, and the letters of words. A
pair counts the distinct texts that hold it, so exact copies and repeats inside a text add nothing; a
word counts its distinct histories, and a run of letters the distinct words it is in, shorter runs their
distinct beginnings, as Kneser and Ney do for lower orders. Counts of 1, 2 and 3 or more lose an absolute
discount each, estimated from the counts of counts by order and class, and no count is lost whole; a
constant in the denominator keeps contexts that were seen a few times from saying much.

What the discounts free goes to the counts of both classes together, so that an expression too rare to
tell the classes apart gets nearly the same probability from both. But the shared counts are weighed by
the class's odds for the depth below: a word known to one class keeps its weight in whatever pair it
comes, and a new word that is spelled like a class's words gets that class's odds. The weights are scaled
so that the probabilities after each history still add up to one.

The two log-likelihoods are compared word by word, and a word counts as far as its ratio toxic : ordinary
is beyond a margin: that a text is ordinary otherwise doesn't speak against the abuse in it, and the noise of
rare words would add up over a long text. A document's score is a logistic function of the sum /
words ** power; slope, intercept, power and margin are fitted on labelled rows that took no
part in the counts.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, replace
from itertools import chain, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, BoundedCache, bucket, byte_slices, give_back, letter_runs, ngram_hashes, parts_for, shared, slices, stored, table, worker_cache

ROWS_PER_CLASS = 10_000  #: bound of the labelled sample: rows of each class that are read
FOLDS, CALIBRATION_FOLD = 4, 0  #: of the learning rows, this fold fits the logistic function

MARGINS = (0.7, 1.0, 1.5, 2.0, 2.5, 3.0)  #: a word's log ratio up to one of these counts as none

_POWERS = (0.5, 0.75, 1.0)
_LETTERS, _LETTER_BITS = 5, 12  #: letters in a run, and the bits of one, so that a run is one number
# What is added to the number of letters or words seen after a context, so that a few say little.
_LETTER_CAUTION, _PAIR_CAUTION = 20.0, 10.0
_PAIR_SHARES, _PAIRS_AT_ONCE = 64, 500_000  #: shares that the pairs are cut into by history, and about how many pairs the driver works on at a time
_WORDS_KEPT = 150_000  #: words of which a worker remembers what the model says


def _word_hashes() -> BoundedCache:
    return worker_cache("toxicity", lambda: BoundedCache(xxhash.xxh3_64_intdigest, _WORDS_KEPT))


def _hashed(text: str | None) -> np.ndarray:
    runs = letter_runs(text) if text else []
    return np.fromiter(map(_word_hashes().__getitem__, runs), np.uint64, len(runs))


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For every letter of the words, and the end of each, the run of letters up to it as one number; and its word.

    Letters beyond the alphabets of two bytes share numbers.
    """
    text = "\1".join(words) + "\1" if words else ""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    codes = np.where(codes < 4_000, codes, 2_000 + codes % 2_000)
    ends = codes == 1
    word = np.cumsum(ends) - ends
    place = np.arange(len(codes)) - np.concatenate([[0], np.flatnonzero(ends) + 1])[word]
    run = codes.copy()
    for back in range(1, _LETTERS):
        before = np.concatenate([np.zeros(back, np.int64), codes])[: len(codes)]
        run |= np.where(place >= back, before, 0) << (_LETTER_BITS * back)
    return run, word


@dataclass(frozen=True)
class Spelling:
    """Odds of a class against both classes, for runs of letters of each length; a few numbers a run."""

    runs: list[np.ndarray]  #: by length from 1: sorted runs
    mass: list[np.ndarray]  #: [2, runs]: discounted probability of the last letter after the others
    both: list[np.ndarray]  #: [runs]: the same of both classes together
    contexts: list[np.ndarray]  #: sorted runs without their last letter
    left: list[np.ndarray]  #: [2, contexts]: mass that a context leaves to the shared counts, scaled
    left_both: list[np.ndarray]  #: [contexts]

    def odds(self, run: np.ndarray, lengths: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """[2, letters] odds of class against both, and [letters] shared probability."""
        shared, odds = np.full(len(run), 1.0 / 4_096), np.ones((2, len(run)))
        for k in range(len(self.runs) if lengths is None else lengths):
            if not len(self.runs[k]):  # learned from no word
                break
            code = run & ((1 << (_LETTER_BITS * (k + 1))) - 1)
            at, hit = _places(self.runs[k], code)
            where, known = _places(self.contexts[k], code >> _LETTER_BITS)
            left_both = np.where(known, self.left_both[k][where], 1.0)
            shared = np.where(hit, self.both[k][at], 0.0) + left_both * shared
            left = np.where(known, self.left[k][:, where], 1.0)
            odds = np.where(hit, self.mass[k][:, at], 0.0) / shared + left * odds
        return odds, shared

    def of_words(self, words: list[str]) -> np.ndarray:
        """[2, words]: odds of each class, against both, of spelling a word so."""
        run, word = letter_codes(words)
        return np.exp(np.stack([np.bincount(word, x, len(words)) for x in np.log(self.odds(run)[0])]) if len(run) else np.zeros((2, len(words))))


def _spelling(run: np.ndarray, counts: list[np.ndarray]) -> Spelling:
    """From the number of words of each class that have a run of full length."""
    out = Spelling([], [], [], [], [], [])
    for k in range(1, _LETTERS + 1):
        code = run & ((1 << (_LETTER_BITS * k)) - 1)
        runs, at = np.unique(code, return_inverse=True)
        n = [np.bincount(at, c if k == _LETTERS else c > 0, len(runs)).astype(np.int64) for c in counts]
        contexts, of = np.unique(runs >> _LETTER_BITS, return_inverse=True)

        def interpolated(c: np.ndarray, of: np.ndarray = of, size: int = len(contexts)) -> tuple[np.ndarray, np.ndarray]:
            mass = _discounted(c) / (np.bincount(of, c, size) + _LETTER_CAUTION)[of]
            return mass, np.clip(1.0 - np.bincount(of, mass, size), 1e-9, 1.0)

        both, left_both = interpolated(n[0] + n[1])
        lower = out.odds(runs, k - 1)[0]
        mass, left = np.empty((2, len(runs))), np.empty((2, len(contexts)))
        for c in (0, 1):
            mass[c], left[c] = interpolated(n[c])
            # After a context the shared letters, weighed by the class's odds, still add up to one.
            left[c] /= np.bincount(of, both * lower[c], len(contexts)) + left_both
        for held, x in zip((out.runs, out.mass, out.both, out.contexts, out.left, out.left_both), (runs, mass, both, contexts, left, left_both), strict=True):
            held.append(x)
    return out


def _places(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted hash is in the sorted ``known`` ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


@dataclass(frozen=True)
class ToxicityModel:
    """Probabilities ready to be compared, about 50 bytes a word and 16 a pair; all words and pairs of the sample."""

    words: np.ndarray  #: sorted hashes; word i has place i + 1, place 0 is any other word
    unigram: np.ndarray  #: [2, words + 1]: probability by class, toxic first; at place 0 before its spelling
    context: np.ndarray  #: [2, words + 1]: mass a context leaves to the words
    pairs: np.ndarray  #: sorted hashes of history and word
    pair_mass: np.ndarray  #: [2, pairs]: discounted probability
    spelling: Spelling
    slope: float = 1.0
    intercept: float = 0.0
    power: float = 1.0
    margin: float = MARGINS[0]

    def differences(self, texts: list[str | None], seen: KnownWords | None = None) -> list[np.ndarray]:
        """Log ratio toxic : ordinary of every word of each text."""
        seen, runs = seen or KnownWords(), [letter_runs(t) if t else [] for t in texts]
        seen.learn(self, runs)
        return [self._difference(seen, np.fromiter(map(seen.number.__getitem__, r), np.int64, len(r))) for r in runs]

    def _difference(self, seen: KnownWords, at: np.ndarray) -> np.ndarray:
        p = seen.unigram[:, at]
        if len(at) > 1:
            tail = p[:, 1:] * self.context[:, seen.place[at[:-1]]]
            where, hit = _places(self.pairs, ngram_hashes(seen.hash[at], 2))
            tail[:, hit] += self.pair_mass[:, where[hit]]
            p = np.concatenate([p[:, :1], tail], axis=1)
        logs = np.log(p)
        return logs[0] - logs[1]

    def ratio(self, text: str | None) -> tuple[float, int]:
        """Summed log ratio toxic : ordinary beyond the margin, and the number of words."""
        return self.scores([text])[0][1:]

    def scores(self, texts: list[str | None], seen: KnownWords | None = None) -> list[tuple[float, float, int]]:
        """Score, summed log ratio toxic : ordinary beyond the margin, and number of words of each text."""
        found = [(_beyond(d, self.margin), len(d)) for d in self.differences(texts, seen)]
        return [(self.score(r, n), r, n) for r, n in found]

    def score(self, ratio: float, n: int) -> float:
        z = self.slope * (ratio / n**self.power if n else 0.0) + self.intercept
        return 1.0 / (1.0 + math.exp(-min(max(z, -50.0), 50.0)))


class KnownWords:
    """What the model says of the words a worker met; starts afresh when they are many."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.hash, self.place, self.unigram = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty((2, 0))

    def learn(self, model: ToxicityModel, runs: list[list[str]]) -> None:
        if len(self.number) > _WORDS_KEPT:
            self.clear()
        new = [w for w in dict.fromkeys(chain.from_iterable(runs)) if w not in self.number]
        if not new:
            return
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
        at, known = _places(model.words, hashes)
        place = np.where(known, at + 1, 0)
        unigram = model.unigram[:, place]
        strange = np.flatnonzero(~known)
        unigram[:, strange] *= model.spelling.of_words([new[i] for i in strange.tolist()])
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new))))
        self.hash, self.place = np.concatenate([self.hash, hashes]), np.concatenate([self.place, place])
        self.unigram = np.concatenate([self.unigram, unigram], axis=1)


def _known_words(model_id: str) -> KnownWords:
    return worker_cache(("toxicity", model_id), KnownWords)


def _beyond(difference: np.ndarray, margin: float) -> float:
    return float(np.maximum(difference - margin, 0.0).sum())


def _sample(labelled: DataFrame, key: str, label: str, rows_per_class: int) -> tuple[DataFrame, float]:
    """Up to about ``rows_per_class`` rows of each class, picked by a hash of the key; the weight an ordinary row stands for."""
    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}  # two rows
    toxic, ordinary = (min(1.0, rows_per_class / max(1, sizes.get(c, 0))) for c in (1, 0))
    share = F.when(F.col(label) == 1, toxic).otherwise(ordinary)
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), F.col(key).cast("string")), F.lit(1 << 30)) / float(1 << 30)
    return labelled.where(draw < share), toxic / ordinary if len(sizes) == 2 else 1.0


def _count(batches: Batches):
    """Per slice: the pairs (history, word) of its texts, and in how many texts of each class; 0 stands before a text."""
    for batch in slices(batches, 200):
        found: tuple[list, list] = ([], [])
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = _hashed(text)
            if len(words):
                found[1 - toxic].append(np.unique(np.stack([np.append(np.uint64(0), words[:-1]), words], axis=1), axis=0))
        for c, pairs in enumerate(found):
            if pairs:
                distinct, n = np.unique(np.concatenate(pairs), axis=0, return_counts=True)
                history, word = (pa.array(np.ascontiguousarray(distinct[:, i]).view(np.int64)) for i in (0, 1))
                n, none = pa.array(n.astype(np.int64)), pa.array(np.zeros(len(n), np.int64))
                yield pa.RecordBatch.from_arrays([history, word, *((none, n) if c else (n, none))], names=["history", "word", "toxic", "ordinary"])


def _words(batches: Batches):
    """The distinct words of each slice, by class."""
    for batch in slices(batches, 200):
        found: tuple[dict, dict] = ({}, {})
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found[toxic].update(dict.fromkeys(letter_runs(text)))
        for toxic, words in enumerate(found):
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array([bool(toxic)] * len(words), pa.bool_())], names=["text", "toxic"])


def _letter_runs_of(batches: Batches):
    """Runs of letters of distinct words, with the number of words of each class."""
    for batch in slices(batches, 20_000):
        run, word = letter_codes(batch.column(0).to_pylist())
        toxic, ordinary = batch.column(1).to_numpy(zero_copy_only=False), ~batch.column(2).to_numpy(zero_copy_only=False)
        runs, at = np.unique(run, return_inverse=True)
        counts = [pa.array(np.bincount(at, of[word], len(runs)).astype(np.int64)) for of in (toxic, ordinary)]
        yield pa.RecordBatch.from_arrays([pa.array(runs), *counts], names=["run", "toxic", "ordinary"])


def fit(
    documents: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
) -> ToxicityModel:
    """Count and calibrate on the documents that ``labels`` covers.

    At most about ``rows_per_class`` rows of each class are read as a sample (documented bound). Rows
    with a null key, text or label teach nothing; a document labelled twice both ways counts in both
    classes. Without rows of both classes the model scores every text alike, at the share of toxic rows.
    """
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("k_"), F.col(label).cast("int").alias("y_")).distinct()
    picked, weight = _sample(marked, "k_", "y_", rows_per_class)
    rows = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("k_"), F.col(text).alias("t_"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("k_").cast("string")), F.lit(FOLDS)) == CALIBRATION_FOLD
    rows = stored(rows.join(F.broadcast(picked), "k_").select("t_", "y_", fold.alias("calibrate")), "toxicity-sample")

    counted = rows.where(~F.col("calibrate")).select("t_", "y_").distinct()
    sums = [F.sum(c).cast("int").alias(c) for c in ("toxic", "ordinary")]
    pairs = counted.mapInArrow(_count, "history bigint, word bigint, toxic bigint, ordinary bigint").groupBy("history", "word").agg(*sums)
    known = counted.mapInArrow(_words, "text string, toxic boolean").groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("toxic").alias("only"))
    model = _model(pairs, stored(known, "toxicity-words"))
    return _calibrated(model, _points(rows.where("calibrate").select("y_", "t_"), model), weight)


def _discounted(n: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
    """Counts less the modified Kneser-Ney discounts of 1, 2 and 3 or more; a count above 0 keeps something.

    ``seen``: how many counts are 1, 2, 3 and 4, where ``n`` is only a part of them.
    """
    if seen is None:
        seen = np.bincount(np.minimum(n, 5), minlength=6)[1:5]
    n1, n2, n3, n4 = np.maximum(seen, 1).astype(float)
    y = n1 / (n1 + 2 * n2)
    off = np.clip([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])
    return (n - off[np.minimum(n, 3)]).astype(np.float32)


def _model(pairs: DataFrame, known: DataFrame) -> ToxicityModel:
    """Runs of letters and words of the bounded sample come to the driver as numbers; pairs by the part, those of a history together."""
    sums = [F.sum(c).cast("int").alias(c) for c in ("toxic", "ordinary")]
    letters = known.select("text", "toxic", "only").mapInArrow(_letter_runs_of, "run bigint, toxic bigint, ordinary bigint").groupBy("run").agg(*sums).toArrow()
    spelling = _spelling(*(x if i == 0 else list(x) for i, x in enumerate((letters.column("run").to_numpy(), (letters.column(c).to_numpy() for c in ("toxic", "ordinary"))))))
    del letters
    give_back()
    # Sorted, so that reading one part skips the others.
    share = F.pmod(F.xxhash64("history"), F.lit(_PAIR_SHARES)).cast("int")
    pairs = stored(pairs.withColumn("share", share).sortWithinPartitions("share"), "toxicity-pairs")
    words, unigram, weight = _words_of(pairs, known, spelling)

    inside, of = pairs.where("history != 0"), (F.col("toxic"), F.col("ordinary"), F.col("toxic") + F.col("ordinary"))
    total, *seen = inside.agg(F.count("*"), *[F.count_if(c == n) for c in of for n in (1, 2, 3, 4)]).first()
    seen = np.array(seen).reshape(3, 4)
    parts = min(_PAIR_SHARES, parts_for(total, _PAIRS_AT_ONCE))
    v = len(words) + 1
    codes, pair_mass, context, done = np.empty(total, np.uint64), np.empty((2, total), np.float32), np.ones((2, v)), 0
    for part in range(parts):
        first, end = (_PAIR_SHARES * i // parts for i in (part, part + 1))
        held = inside.where((F.col("share") >= first) & (F.col("share") < end)).select("history", "word", "toxic", "ordinary").toArrow()
        if not held.num_rows:
            continue
        at = slice(done, done + held.num_rows)
        codes[at], pair_mass[:, at], here, left = _pair_part(held, words, weight, seen)
        context[:, here] = left
        done = at.stop
        del held
        give_back()
    order = np.argsort(codes)
    codes = codes[order]
    for c in (0, 1):
        pair_mass[c] = pair_mass[c][order]
    return ToxicityModel(words, unigram, context, codes, pair_mass, spelling)


def _words_of(pairs: DataFrame, known: DataFrame, spelling: Spelling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of words; by class their probability, and that against both classes together."""
    found = pairs.groupBy("word").agg(F.count("*").alias("n"), *[F.count_if(F.col(c) > 0).alias(c) for c in ("toxic", "ordinary")]).toArrow()
    words = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words = words[order]
    histories, *of_class = (np.append(0, found.column(c).to_numpy()[order]) for c in ("n", "toxic", "ordinary"))
    del found
    v = len(words) + 1
    shared = np.maximum(histories, 1) / (histories.sum() + 1)  # any other word: one history
    odds = np.ones((2, v), np.float32)
    spelled = _spelled(known, spelling)
    odds[:, _places(words, spelled[0])[0] + 1] = spelled[1]
    unigram, weight = np.empty((2, v)), np.empty((2, v))
    for c, distinct in enumerate(of_class):
        direct = _discounted(distinct).astype(float) / max(1, distinct.sum())
        unigram[c] = direct + (1.0 - direct.sum()) * shared * odds[c] / (shared * odds[c]).sum()
        weight[c] = unigram[c] / shared
    return words, unigram, weight


def _pair_part(held: pa.Table, words: np.ndarray, weight: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all pairs of some histories: sorted hashes, [2, pairs] masses, places of the histories, [2, histories] mass they leave to the words."""
    history, word = (held.column(c).to_numpy().view(np.uint64) for c in ("history", "word"))
    codes = ngram_hashes(np.stack([history, word], axis=1).ravel(), 2)[::2]
    order = np.argsort(codes)
    codes, counts = codes[order], [held.column(c).to_numpy()[order] for c in ("toxic", "ordinary")]
    here, before = np.unique(history[order], return_inverse=True)  # every history is some pair's word
    here, now = _places(words, here)[0] + 1, _places(words, word[order])[0] + 1

    def interpolated(n: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mass = _discounted(n, seen) / (np.bincount(before, n, len(here)) + _PAIR_CAUTION)[before].astype(np.float32)
        return mass, np.clip(1.0 - np.bincount(before, mass, len(here)), 1e-9, 1.0)

    both, left_both = interpolated(counts[0] + counts[1], seen[2])
    context, pair_mass = np.empty((2, len(here))), np.empty((2, len(codes)), np.float32)
    for c, n in enumerate(counts):
        mass, left = interpolated(n, seen[c])
        weighed = both * weight[c][now].astype(np.float32)
        left /= np.bincount(before, weighed, len(here)) + left_both  # so that all words after a history add up to one
        pair_mass[c] = mass + left[before].astype(np.float32) * weighed
        context[c] = left * left_both
    return codes, pair_mass, here, context


def _spelled(known: DataFrame, spelling: Spelling) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the sample's words and their [2, words] odds by spelling."""
    sent = known.sparkSession.sparkContext.broadcast(spelling)

    def run(batches: Batches):
        for batch in slices(batches, 20_000):
            words = batch.column(0).to_pylist()
            odds = sent.value.of_words(words)
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), *(pa.array(o) for o in odds)], names=["word", "toxic", "ordinary"])

    found = known.select("text").mapInArrow(run, "word bigint, toxic double, ordinary double").toArrow()
    sent.destroy()
    return found.column("word").to_numpy().view(np.uint64), np.stack([found.column(c).to_numpy() for c in ("toxic", "ordinary")])


def _points(rows: DataFrame, model: ToxicityModel) -> pd.DataFrame:
    """Class, number of words and the ratio by every margin of rows (y_, t_), within the bound of the sample."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    names, model_id = [f"ratio_{i}" for i in range(len(MARGINS))], uuid.uuid4().hex

    def run(batches: Batches):
        for batch in slices(batches):
            found = sent.value.differences(batch.column(1).to_pylist(), _known_words(model_id))
            ratios = [pa.array([_beyond(d, m) for d in found], pa.float64()) for m in MARGINS]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(d) for d in found], pa.int64()), *ratios], names=["y_", "n_words", *names])

    points = rows.mapInArrow(run, ", ".join(["y_ int", "n_words bigint", *(f"{n} double" for n in names)])).toPandas()
    sent.destroy()
    return points


def _calibrated(model: ToxicityModel, points: pd.DataFrame, weight: float) -> ToxicityModel:
    """Slope, intercept, power and margin of least weighted log loss, by Newton steps with a slight ridge."""
    y, n = points["y_"].to_numpy(float), np.maximum(1, points["n_words"].to_numpy(float))
    w = np.where(y == 1, 1.0, max(1.0, weight))
    if 0 < y.sum() < len(y):  # toxic rows are few; a missed one weighs more than a civil one flagged, by the root of the odds
        w[y == 1] *= max(1.0, math.sqrt(w[y == 0].sum() / y.sum()))
    if len(y) == 0 or y.min() == y.max():
        share = min(max(1.0 / (1.0 + max(weight, 1.0)), 1e-3), 0.499)
        return replace(model, slope=0.0 if len(y) == 0 else 1.0, intercept=math.log(share / (1 - share)))
    best = None
    for (i, margin), power in product(enumerate(MARGINS), _POWERS):
        x = points[f"ratio_{i}"].to_numpy(float) / n**power
        scale = x.std() or 1.0
        z, beta = np.stack([x / scale, np.ones(len(x))]), np.zeros(2)
        loss = lambda b: float((w * np.logaddexp(0, np.where(y == 1, -1, 1) * (b @ z))).sum() + 1e-3 * b[0] ** 2)  # noqa: E731, B023
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(beta @ z, -30, 30)))
            gradient = z @ (w * (p - y)) + np.array([2e-3 * beta[0], 0])
            hessian = (z * (w * p * (1 - p))) @ z.T + np.diag([2e-3, 1e-9])
            step = np.linalg.solve(hessian, gradient)
            size = 1.0
            while size > 1e-4 and loss(beta - size * step) > loss(beta):
                size /= 2
            beta = beta - size * step
            if np.abs(size * step).max() < 1e-6:
                break
        if best is None or loss(beta) < best[0]:
            best = (loss(beta), float(beta[0] / scale), float(beta[1]), power, margin)
    return replace(model, slope=best[1], intercept=best[2], power=best[3], margin=best[4])


def _ratios(df: DataFrame, text: str, carry: list[str], model: ToxicityModel) -> DataFrame:
    held_model, model_id = shared(df.sparkSession, model), uuid.uuid4().hex  # bounded by rows_per_class

    def run(batches: Batches):
        held, seen = held_model.value, _known_words(model_id)
        for batch in byte_slices(batches, rows=500):
            found = held.scores(batch.column(0).to_pylist(), seen)
            score, ratio, n = ([row[i] for row in found] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(score, pa.float64()), pa.array(ratio, pa.float64()), pa.array(n, pa.int64())],
                names=[*batch.schema.names[1:], "score", "ratio", "n_words"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*carry).schema)
    return df.select(text, *carry).mapInArrow(run, f"{kinds}, score double, ratio double, n_words bigint")


def score(documents: DataFrame, model: ToxicityModel, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, score (0 to 1), ratio and n_words of every row, whole texts, no shuffle.

    A null or wordless text has ratio 0 and scores the fitted base rate. Rows with a null or repeated
    key are scored like any other. Other columns are left out, so their names cannot clash.
    """
    return _ratios(documents.select(F.col(key), F.col(text)), text, [key], model)


def _held_out(key: str = "doc_id"):
    return F.coalesce(bucket(key, 0, 5), F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learn = lambda df: df.where(~_held_out())
    scored = score(documents, fit(learn(documents), learn(labels)))
    return scored.select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "ratio", "n_words"
    )


def keep_civil(documents: DataFrame, model: ToxicityModel, *, threshold: float = 0.5) -> DataFrame:
    """Pipeline stage: the rows of ``documents`` that score below ``threshold``, all columns kept."""
    held_model, model_id, at = shared(documents.sparkSession, model), uuid.uuid4().hex, documents.columns.index("text")

    def run(batches: Batches):
        held, seen = held_model.value, _known_words(model_id)
        for batch in byte_slices(batches, at, rows=500):
            texts = batch.column(at).to_pylist()
            yield batch.filter(pa.array([score < threshold for score, _, _ in held.scores(texts, seen)], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
