"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over the distinct words of labelled texts. A text is
parsed against each automaton: every phrase is the longest match from where the last one ended. Phrases
times log2 of the automaton's text, per letter, estimate the cross entropy; the language needing the
fewest normalised phrases wins. A phrase never leaves its word (with the spaces round it), so a word's
phrases are worked out once per worker and remembered in a bounded cache. Texts are not shuffled.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, BoundedCache, bucket, letter_runs, shared, slices, table, worker_cache

DOCS_PER_LANGUAGE = 60  #: bound of the labelled sample: about so many whole texts of each language
UNKNOWN = "und"
_POINTS = 0x110000
_FIELD = 40  #: bits per language in a summed count


def suffix_automaton(text: str) -> dict[int, int]:
    """Transitions (state + code point -> state) of the automaton of all substrings; states are multiples of 0x110000, 0 is the start."""
    following: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p != -1:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(following)
                following.append(following[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return {state * _POINTS + ord(c): to * _POINTS for state, edges in enumerate(following) for c, to in edges.items()}


def phrases(text: str | list[int], automaton: dict[int, int]) -> int:
    """Longest-match phrases that ``text``, or its code points, falls into; an unknown letter is a phrase of its own."""
    step, state, count = automaton.get, 0, 0
    for c in map(ord, text) if isinstance(text, str) else text:
        to = step(state + c)
        if to is None:
            count += state > 0
            to = step(c)
            if to is None:
                count += 1
                to = 0
        state = to
    return count + (state > 0)


@dataclass(frozen=True)
class LanguageModel:
    """One automaton per learned language, in order of name; bounded by languages * sampled texts."""

    languages: tuple[str, ...]
    automata: tuple[dict[int, int], ...]
    bits: tuple[float, ...]  #: log2 of each automaton's text

    def word(self, word: str) -> int:
        """Phrases of one word by language, side by side in one number so that words add up in one pass."""
        padded, packed = list(map(ord, f" {word} ")), 0
        for i, automaton in enumerate(self.automata):
            packed |= phrases(padded, automaton) << (_FIELD * i)
        return packed

    def predict(self, text: str | None, cache: BoundedCache) -> tuple[str, float]:
        """Language and the share of belief it gets; ties go to the first name."""
        words = letter_runs(text) if text else []
        if not words or not self.languages:
            return UNKNOWN, 0.0
        total, low = sum(map(cache.__getitem__, words)), (1 << _FIELD) - 1
        cost = [(total >> (_FIELD * i) & low) * b for i, b in enumerate(self.bits)]
        best = min(range(len(cost)), key=lambda i: (cost[i], i))
        belief = sum(math.exp(min(0.0, (cost[best] - c) * math.log(2) / 2)) for c in cost)
        return self.languages[best], 1.0 / belief


def _build(group: pd.DataFrame) -> pd.DataFrame:
    words = sorted({w for text in group["t"] for w in letter_runs(text)})
    reference = " ".join(["", *words, ""])
    packed = pickle.dumps(suffix_automaton(reference))
    return pd.DataFrame({"l": [group["l"].iloc[0]], "automaton": [packed], "bits": [math.log2(max(2, len(reference)))]})


def fit(documents: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Learn every non-null language of ``documents`` from about ``docs_per_language`` whole texts each.

    The texts are picked by a hash of the key. Rows with a null text or language teach nothing; a
    language without any letter is not learned.
    """
    rows = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")
    )
    sizes = rows.groupBy("l").count().withColumn("share", docs_per_language / F.col("count")).drop("count")
    draw = F.pmod(F.xxhash64(F.lit("language"), "k"), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.join(F.broadcast(sizes), "l").where(draw < F.col("share"))  # one row per language
    built = picked.select("l", "t").groupBy("l").applyInPandas(_build, "l string, automaton binary, bits double").collect()
    found = sorted((r["l"], pickle.loads(r["automaton"]), r["bits"]) for r in built)
    found = [f for f in found if len(f[1]) > 1]
    return LanguageModel(tuple(f[0] for f in found), tuple(f[1] for f in found), tuple(f[2] for f in found))


def _cache(sent) -> BoundedCache:
    """Phrases by word, for one broadcast model."""
    return worker_cache(("language", id(sent.value)), lambda: BoundedCache(sent.value.word))


def identify(documents: DataFrame, model: LanguageModel, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, lang_pred and score (0 to 1) of every row, over whole texts.

    A text that is null or has no letter is ``und`` with score 0. Null and repeated keys are predicted
    like any other; other columns are left out.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Batches):
        cache = _cache(sent)
        for batch in slices(batches):
            found = [sent.value.predict(t, cache) for t in batch.column(1).to_pylist()]
            langs, scores = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[key, "lang_pred", "score"]
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def keep_languages(documents: DataFrame, model: LanguageModel, *, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Pipeline stage: the rows whose text is in one of ``languages`` (all learned ones), all columns kept; ``und`` goes.

    Where no language was learned and none is asked for, nothing can be told: every text with a letter stays.
    """
    held = shared(documents.sparkSession, model)
    wanted = frozenset(model.languages if languages is None else languages)
    untold = not model.languages and languages is None

    def run(batches: Batches):
        cache = _cache(held)
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            keep = [bool(t and letter_runs(t)) if untold else held.value.predict(t, cache)[0] in wanted for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def _held_out():
    return F.coalesce(bucket("doc_id", 2, 4), F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.where(~_held_out()))
    return identify(documents, model).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")
