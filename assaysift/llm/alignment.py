"""Alignment of two tokenizers: which ids of one stand for the same bytes as which ids of the other.

Every text is tokenised whole by both. The bytes of the tokens are checked against the text, so places
in the two sequences can be compared as byte offsets. Where both have a token that starts with a space
at the same offset, the tokens before it end together: these verified places cut a document into short
windows, a word or so each. Inside a window the offsets at which both tokens end cut groups, and every
id of a group's one side is linked with every id of its other side. A window's alignment depends on
nothing but its ids, so it is computed once per worker and remembered under them.

How many documents hold a linked pair is counted over the corpus by Spark. A document then needs the
count of each of its pairs: the most frequent pairs, at most ``HOT_PAIRS`` of them by the way the limit
is set, are broadcast, and the rest, each held by few documents, are joined by shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, BoundedCache, byte_slices, packed, stored, table, worker_cache

BYTE_TOKENIZER, PIECE_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT_PAIRS = 500_000  #: a pair of more than 1 / HOT_PAIRS of all links is broadcast, so no more than these are
MEMO_WINDOWS, MEMO_TOKENS, MEMO_WORDS = 200_000, 4_000_000, 150_000  #: what a worker remembers before it starts afresh

_ID_BITS = 20  #: ids of both vocabularies are below 2 ** 20
# The byte-level pre-tokenizer's pattern, for letters, digits and white space that every regex library takes alike.
_WORDS = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")
_UNPLAIN = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ]")
_BETWEEN = b"\xff\xff\xff\xff"  # no id; parts the two sides of a window


def _path(name: str) -> str:
    return name if "/" in name else public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteSide:
    """A byte-level tokenizer of the tokenizers library; special strings in texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        byte = _byte_alphabet()
        settings = json.loads(open(path, encoding="utf-8").read())
        plain = {entry["content"] for entry in settings.get("added_tokens", [])}
        steps = settings.get("pre_tokenizer") or {}
        self.by_word = (steps.get("type"), steps.get("use_regex"), steps.get("add_prefix_space"), settings.get("normalizer")) == ("ByteLevel", True, False, None)
        vocabulary = self.library.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for entry, number in vocabulary.items():
            self.bytes[number] = entry.encode() if entry in plain else bytes(byte[letter] for letter in entry)

        self.letters = {b: letter for letter, b in byte.items()}
        self.blank = self.letters[32]
        self.tokenize = self.library.model.tokenize  # the model is a new object at each access
        self.words = BoundedCache(self._word, MEMO_WORDS)

    def _word(self, word: str) -> bytes:
        """Ids of one word as the pre-tokenizer cuts them, checked against its bytes."""
        data, rest = word.encode(), word[1:]
        plain = word[0] == " " and rest.isascii() and rest.isalpha()  # stands for itself but for the space
        ids = [t.id for t in self.tokenize(self.blank + rest if plain else data.decode("latin-1").translate(self.letters))]
        if b"".join(map(self.bytes.__getitem__, ids)) != data:
            raise ValueError(f"the vocabulary does not spell {word!r}")
        return packed(ids)

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of a space and the text; None where they don't give its bytes back.

        Words of texts in plain letters are tokenised once; other texts go to the library whole.
        """
        spaced = " " + text
        if self.by_word and _UNPLAIN.search(text) is None:
            return np.frombuffer(b"".join(map(self.words.__getitem__, _WORDS.findall(spaced))), "<u4")
        ids = self.library.encode_batch_fast([spaced], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4") if b"".join(map(self.bytes.__getitem__, ids)) == spaced.encode() else None


class PieceSide:
    """A sentencepiece model, which itself puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for number in range(self.library.vocab_size()):
            piece = self.library.id_to_piece(number)
            byte = self.library.is_byte(number)
            self.bytes.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of the text with its space; None where they don't give its bytes back."""
        ids = self.library.encode(text)
        return np.array(ids, "<u4") if b"".join(map(self.bytes.__getitem__, ids)) == b" " + text.encode() else None


class WindowMemo:
    """Alignments of windows by their ids: groups, links, text and linked pairs with their numbers."""

    def __init__(self, a_lengths: np.ndarray, b_lengths: np.ndarray):
        self.a_lengths, self.b_lengths = a_lengths, b_lengths
        self.a_last = len(a_lengths) * 2
        self.spelled = [f"{i}{mark}" for n, marks in ((len(a_lengths), ",|"), (len(b_lengths), ",;")) for i in range(n) for mark in marks]
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.texts: list[str] = []
        #: groups and links of each window; its pairs are ``pairs[begin : begin + size]``
        self.groups, self.links, self.begin, self.size, self.pairs, self.numbers = (array("q") for _ in range(6))
        self.tokens = 0

    def full(self) -> bool:
        return len(self.known) >= MEMO_WINDOWS or self.tokens >= MEMO_TOKENS

    def add(self, a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> None:
        """Align windows that follow each other, both sides of each over the same bytes, and number them on."""
        windows = len(a_sizes)
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        shared = np.intersect1d(a_ends, b_ends, assume_unique=True)  # each ends a group
        of_a, of_b = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        n_a, n_b = np.bincount(of_a, minlength=len(shared)), np.bincount(of_b, minlength=len(shared))
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        window = np.repeat(np.arange(windows), a_sizes)
        of_group = window[to_a - 1]
        self.groups.frombytes(np.bincount(of_group, minlength=windows).astype(np.int64).tobytes())
        links = np.zeros(windows, np.int64)
        np.add.at(links, of_group, n_a * n_b)
        self.links.frombytes(links.tobytes())

        # Texts: the ids in the order they are written, each with the mark that follows it.
        code = np.empty(len(a) + len(b), np.int64)
        at_a, at_b = np.arange(len(a)), np.arange(len(b))
        code[at_a + (to_b - n_b)[of_a]] = 2 * a.astype(np.int64) + (at_a == to_a[of_a] - 1)
        code[at_b + to_a[of_b]] = self.a_last + 2 * b.astype(np.int64) + (at_b == to_b[of_b] - 1)
        parts = list(map(self.spelled.__getitem__, code.tolist()))
        cuts = np.cumsum(np.append(0, a_sizes + b_sizes)).tolist()
        self.texts += ["".join(parts[i:j])[:-1] for i, j in zip(cuts, cuts[1:])]

        # Pairs: every id of a side with every one of the other; large groups by their distinct ids.
        large = n_a * n_b > 4_096
        many = np.where(large, 0, n_b)[of_a]
        other = _spread((to_b - n_b)[of_a], many)
        pairs = [np.repeat(window << 2 * _ID_BITS | a.astype(np.int64) << _ID_BITS, many) | b[other].astype(np.int64)]
        numbers = [np.ones(len(pairs[0]), np.int64)]
        for g in np.flatnonzero(large).tolist():
            (x, n), (y, m) = (np.unique(side[to[g] - k[g] : to[g]].astype(np.int64), return_counts=True) for side, to, k in ((a, to_a, n_a), (b, to_b, n_b)))
            pairs.append((of_group[g] << 2 * _ID_BITS | x[:, None] << _ID_BITS | y).ravel())
            numbers.append((n[:, None] * m).ravel())
        distinct, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        number = np.zeros(len(distinct), np.int64)
        np.add.at(number, inverse, np.concatenate(numbers))
        size = np.bincount(distinct >> 2 * _ID_BITS, minlength=windows).astype(np.int64)
        self.begin.frombytes((len(self.pairs) + np.cumsum(size) - size).tobytes())
        self.size.frombytes(size.tobytes())
        self.pairs.frombytes((distinct & ((1 << 2 * _ID_BITS) - 1)).tobytes())
        self.numbers.frombytes(number.tobytes())
        self.tokens += len(code) + len(distinct)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges of ``sizes`` from ``starts``, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Aligner:
    """Both tokenizers and the remembered windows of one worker."""

    def __init__(self, byte_tokenizer: str, piece_tokenizer: str):
        self.a, self.b = ByteSide(_path(byte_tokenizer)), PieceSide(_path(piece_tokenizer))
        if max(len(self.a.bytes), len(self.b.bytes)) >> _ID_BITS:
            raise ValueError(f"vocabularies of more than 2 ** {_ID_BITS} ids")
        self.lengths = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        self.spaced = [np.array([x[:1] == b" " for x in side.bytes], bool) for side in (self.a, self.b)]
        self.memo = WindowMemo(*self.lengths)

    def _tokens(self, texts: list[str | None]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """Places of the texts that both tokenizers give back byte for byte, and their ids."""
        kept, a_ids, b_ids = [], [], []
        for i, text in enumerate(texts):
            if text and (b := self.b.encode(text)) is not None and (a := self.a.encode(text)) is not None:
                kept.append(i)
                a_ids.append(a)
                b_ids.append(b)
        return kept, a_ids, b_ids

    def align(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """Columns for the texts; pairs are as ``offsets`` into ``link_a``, ``link_b`` and ``link_n``, sorted within a text.

        The texts follow each other in one stream of bytes. Each starts with a space in both sequences,
        so no window goes on from one into the next.
        """
        kept, a_ids, b_ids = self._tokens(texts)
        out: dict[str, list | np.ndarray] = {n: np.zeros(len(texts), np.int64) for n in ("n_a", "n_b", "n_groups", "n_links")}
        out["groups_sha256"] = [""] * len(texts)
        out["offsets"], empty = np.zeros(len(texts) + 1, np.int32), np.empty(0, np.int32)
        if not kept:
            return out | {"link_a": empty, "link_b": empty, "link_n": empty.astype(np.int64)}
        place = np.array(kept)
        out["n_a"][place], out["n_b"][place] = [len(x) for x in a_ids], [len(x) for x in b_ids]
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        del a_ids, b_ids
        a_starts, b_starts = (np.cumsum(n := lengths[x]) - n for lengths, x in zip(self.lengths, (a, b), strict=True))
        anchors = np.intersect1d(a_starts[self.spaced[0][a]], b_starts[self.spaced[1][b]], assume_unique=True)
        a_cuts, b_cuts = (np.append(np.searchsorted(starts, anchors), len(x)) for starts, x in ((a_starts, a), (b_starts, b)))
        first = np.searchsorted(a_cuts, np.cumsum(np.append(0, out["n_a"][place])))  # of each text's windows

        if self.memo.full():
            self.memo.clear()
        memo, known = self.memo, self.memo.known
        left, right = a.tobytes(), b.tobytes()
        a_at, b_at = (4 * a_cuts).tolist(), (4 * b_cuts).tolist()
        keys = [left[i:j] + _BETWEEN + right[k:m] for i, j, k, m in zip(a_at, a_at[1:], b_at, b_at[1:])]
        windows, fresh = [*map(known.get, keys)], []
        for n in [n for n, number in enumerate(windows) if number is None]:
            number = known.get(keys[n])  # met earlier in these texts
            if number is None:
                number = known[keys[n]] = len(known)
                fresh.append(n)
            windows[n] = number
        del keys
        if fresh:
            sizes = [np.diff(cuts)[fresh] for cuts in (a_cuts, b_cuts)]
            x, y = (ids[_spread(cuts[fresh], size)] for ids, cuts, size in ((a, a_cuts, sizes[0]), (b, b_cuts, sizes[1])))
            memo.add(x, sizes[0], y, sizes[1])

        texts_of, at = memo.texts, first.tolist()
        for n, i in enumerate(kept):
            out["groups_sha256"][i] = hashlib.sha256(";".join([texts_of[w] for w in windows[at[n] : at[n + 1]]]).encode()).hexdigest()
        windows = np.array(windows)
        groups, links, begin, size, flat, many = (np.frombuffer(x, np.int64) for x in (memo.groups, memo.links, memo.begin, memo.size, memo.pairs, memo.numbers))
        for name, of in (("n_groups", groups), ("n_links", links)):
            out[name][place] = np.add.reduceat(of[windows], first[:-1])
        n = size[windows]
        take = _spread(begin[windows], n)
        owner = np.repeat(np.repeat(place, np.diff(first)), n)
        held, inverse = np.unique(owner << 2 * _ID_BITS | flat[take], return_inverse=True)
        out["offsets"] = np.append(0, np.cumsum(np.bincount(held >> 2 * _ID_BITS, minlength=len(texts)))).astype(np.int32)
        mask = (1 << _ID_BITS) - 1
        return out | {
            "link_a": (held >> _ID_BITS & mask).astype(np.int32),
            "link_b": (held & mask).astype(np.int32),
            "link_n": np.bincount(inverse, many[take]).astype(np.int64),
        }


def _aligner(byte_tokenizer: str, piece_tokenizer: str) -> Aligner:
    return worker_cache(("alignment", byte_tokenizer, piece_tokenizer), lambda: Aligner(byte_tokenizer, piece_tokenizer))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_PAIRS = ("link_a", "link_b", "link_n")


def align(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", byte_tokenizer: str = BYTE_TOKENIZER, piece_tokenizer: str = PIECE_TOKENIZER
) -> DataFrame:
    """Key, n_a, n_b, n_groups, n_links, groups_sha256 and the distinct linked pairs (link_a, link_b, link_n) of every row; no shuffle."""

    def run(batches: Batches):
        aligner = _aligner(byte_tokenizer, piece_tokenizer)
        for batch in byte_slices(batches, 1, 1_000_000):
            found = aligner.align(batch.column(1).to_pylist())
            offsets = pa.array(found["offsets"])
            pairs = [pa.ListArray.from_arrays(offsets, pa.array(found[n])) for n in _PAIRS]
            counts = [pa.array(found[n], pa.int64()) for n in _COUNTS]
            sha = pa.array(found["groups_sha256"], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, sha, *pairs], names=[key, *_COUNTS, "groups_sha256", *_PAIRS])

    kind = documents.schema[key].dataType.simpleString()
    numbers = ", ".join([*(f"{n} bigint" for n in _COUNTS), "groups_sha256 string", "link_a array<int>, link_b array<int>, link_n array<bigint>"])
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, {numbers}")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): in how many rows each linked pair is, and whether that is the highest number of its first id."""
    counts = stored(links.groupBy("pair").agg(F.count("*").alias("n")), "alignment-counts")
    first = F.shiftright("pair", _ID_BITS)
    highest = counts.groupBy(first.alias("a")).agg(F.max("n").alias("highest"))  # a row per id, below 2 ** 20
    return counts.withColumn("a", first).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def link_counts(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", byte_tokenizer: str = BYTE_TOKENIZER,
    piece_tokenizer: str = PIECE_TOKENIZER, hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """Key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    A null or empty text, and one that either tokenizer doesn't give back byte for byte, has zeros and
    an empty digest, and no part in the counts. Rows count one by one, whether their keys are null or
    repeated. Texts of any length are aligned whole. Other columns are left out, so their names cannot
    clash; an empty table gives an empty one.
    """
    aligned = align(documents, key=key, text=text, byte_tokenizer=byte_tokenizer, piece_tokenizer=piece_tokenizer)
    aligned = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "alignment")
    entry = F.explode(F.arrays_zip(*_PAIRS)).alias("e")
    links = aligned.select("row", entry).select(
        "row", F.shiftleft(F.col("e.link_a").cast("bigint"), _ID_BITS).bitwiseOR(F.col("e.link_b").cast("bigint")).alias("pair"), F.col("e.link_n").alias("many")
    )
    counts = stored(pair_counts(links), "alignment-pairs")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = total // hot_pairs
    hot, cold = F.broadcast(counts.where(F.col("n") > limit)), counts.where(F.col("n") <= limit)
    sums = [F.sum(F.when(F.col("best"), F.col("many")).otherwise(0)).alias("n_best"), F.sum(F.col("many") * F.col("n")).alias("count_sum")]
    parts = links.join(hot, "pair").groupBy("row").agg(*sums)
    if limit:
        rest = links.join(hot.select("pair"), "pair", "left_anti").join(cold, "pair").groupBy("row").agg(*sums)
        parts = parts.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return aligned.join(parts, "row", "left").select(
        key, *_COUNTS, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(table(spark, sf_dir, "documents"))
