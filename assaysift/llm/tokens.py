"""Exact token counts at every prefix of a text, by prefix dynamic programming.

The tokenizers meant here drop white space and cut the rest into pre-tokens, so a prefix has as many
tokens as the pre-tokens that end in it, plus those of the one it cuts. A table holds the first term at
the end of every pre-token. The second comes from dynamic programming over the one that is cut: of a
sequence of tokens the encoder makes exactly those in which every neighbouring pair, encoded by itself,
comes out as that pair; so every prefix has one last token that follows the last token of a shorter
prefix, and its count is that prefix's plus one. Totals, truncation and budget questions thus read the
table and look at one pre-token, and never encode the text again. Spark deals out the rows; nothing is
shuffled.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import accumulate, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import Batches, BoundedCache, byte_slices, packed, slices, table, worker_cache

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048

# The pre-tokenizer whose chunks may be encoded one by one (fixed value of the tokenizer's file).
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters that lower-casing and composition map one to one, then marks: two pre-tokens. An apostrophe
# could start a suffix and a less-than sign a special token; those go the long way.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
_RUNS = regex.compile(_PATTERN)
_WORD_END = "</w>"
_CHUNKS_KEPT, _CHUNK_BYTES = 800_000, 160_000_000  #: bounds of the ids a worker remembers; rare words make up most of the work
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class ChunkEncoder:
    """Ids of a chunk free of ASCII white space, equal to the library's for every chunk."""

    def __init__(self, path: str):
        settings = json.loads(open(path, encoding="utf-8").read())
        steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        if steps[0].get("pattern", {}).get("Regex") != _PATTERN or not steps[0].get("invert"):
            raise ValueError(f"{path} does not drop white space between tokens")
        self.library = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.tokenize = self.library.model.tokenize  # the model is a new object at each access
        self.runs = BoundedCache(self._run)

    def _run(self, text: str) -> bytes:
        """One pre-token: lower-cased letters, or marks."""
        own = text.isascii() and text.isprintable() and " " not in text  # stands for itself
        spelled = text if own else text.encode().decode("latin-1").translate(self.letters)
        return packed([t.id for t in self.tokenize(spelled)])

    def ids(self, chunk: bytes) -> bytes:
        """Little-endian unsigned 32-bit numbers."""
        text = chunk.decode()
        plain = _PLAIN.fullmatch(text)
        if plain is None:
            return packed(self.library.encode(text, add_special_tokens=False).ids)
        word, marks = plain.groups()
        return self.runs[word.lower()] + self.runs[marks] if marks else self.runs[word.lower()]


class PrefixCounter:
    """Numbers of tokens at the ends of a chunk's pre-tokens, and of every prefix of one that is cut.

    A chunk with a special token's string, or whose characters compose, counts as one pre-token and is
    encoded prefix by prefix when cut, and so is one whose count is not the library's; all others take time
    in proportion to their length.
    """

    def __init__(self, path: str, encoder: ChunkEncoder):
        model = json.loads(open(path, encoding="utf-8").read())["model"]
        if model.get("end_of_word_suffix") != _WORD_END or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path} does not mark the ends of words by {_WORD_END}")
        self.encoder = encoder
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.vocabulary = model["vocab"]
        self.longest = max(len(t.removesuffix(_WORD_END)) for t in self.vocabulary)
        self.kept = BoundedCache(lambda token: self._merged(token) == [token])
        self.follows = BoundedCache(lambda pair: self._merged(*pair) == list(pair))
        self.runs = BoundedCache(self._run)
        self.chunks = BoundedCache(self._chunk)
        self.cuts = BoundedCache(self._cut)

    def _merged(self, *tokens: str) -> list[str]:
        """The tokens' letters, merged pair by pair, lowest rank first."""
        parts = []
        for token in tokens:
            letters = list(token.removesuffix(_WORD_END))
            parts += [*letters[:-1], letters[-1] + _WORD_END] if token.endswith(_WORD_END) else letters
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), i) for i, pair in enumerate(pairwise(parts)))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _last(self, spelled: str, end: int, lasts: list[str], mark: str) -> tuple[str, int]:
        """The last token of the first ``end`` letters, ending the word if ``mark``, and where it starts."""
        for start in range(max(0, end - self.longest), end):
            token = spelled[start:end] + mark
            if token in self.vocabulary and self.kept[token] and (not start or self.follows[lasts[start], token]):
                return token, start
        raise ValueError(f"no token ends at letter {end} of {spelled!r}")

    def _run(self, run: str) -> bytes:
        """Counts for a pre-token and its prefixes."""
        ends = set(accumulate(len(c.encode()) for c in run))
        spelled = run.encode().decode("latin-1").translate(self.encoder.letters)
        lasts, inner, counts = [""], [0], []
        for end in range(1, len(spelled) + 1):
            if end in ends:
                counts.append(inner[self._last(spelled, end, lasts, _WORD_END)[1]] + 1)
            token, start = self._last(spelled, end, lasts, "")
            lasts.append(token)
            inner.append(inner[start] + 1)
        if len(run) > 1 and run[0] == "'" and run[1].isalpha():  # a suffix, when cut, is a mark and letters
            rest = np.frombuffer(self.runs[run[1:]], "<u4").tolist()
            counts[1:-1] = [counts[0] + n for n in rest[:-1]]
        return np.array(counts, "<u4").tobytes()

    def _by_runs(self, text: str) -> np.ndarray | None:
        if "<|" in text or not unicodedata.is_normalized("NFC", text):
            return None
        lowered = [c.lower() for c in text]
        counts, done, at = np.zeros(sum(map(len, lowered)), np.int64), 0, 0
        for match in _RUNS.finditer("".join(lowered)):
            counts[at : match.start()] = done
            at = match.end()
            counts[match.start() : at] = np.frombuffer(self.runs[match.group()], "<u4")
            counts[match.start() : at] += done
            done = int(counts[at - 1])
        counts[at:] = done
        return counts[np.cumsum([len(c) for c in lowered]) - 1]

    def _cut(self, piece: bytes) -> bytes:
        """Counts at the end of every character of a piece that begins where a pre-token does."""
        text = piece.decode()
        counts = self._by_runs(text)
        if counts is None or counts[-1] * 4 != len(self.encoder.ids(piece)):
            encode = self.encoder.library.encode
            counts = np.array([len(encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)])
        return counts.astype("<u4").tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        """Pairs of byte offset and count, at the ends of pre-tokens and of the chunk."""
        text, runs = chunk.decode(), self.encoder.runs
        if plain := _PLAIN.fullmatch(text):
            word, marks = plain.groups()
            n, end = len(runs[word.lower()]) // 4, len(word.encode())
            return np.array([end, n, len(chunk), n + len(runs[marks]) // 4] if marks else [end, n], "<u4").tobytes()
        pairs, total = [], len(self.encoder.ids(chunk)) // 4
        if "<|" not in text and unicodedata.is_normalized("NFC", text):
            lowered = [c.lower() for c in text]
            at = dict(zip(accumulate(map(len, lowered)), accumulate(len(c.encode()) for c in text), strict=True))
            done = 0
            for match in _RUNS.finditer("".join(lowered)):
                done += len(runs[match.group()]) // 4
                if match.end() in at:  # not inside a character that has become two
                    pairs += [at[match.end()], done]
            if done != total:
                pairs = []
        if pairs[-2:-1] != [len(chunk)]:
            pairs += [len(chunk), total]
        return np.array(pairs, "<u4").tobytes()


def _worker(path: str) -> tuple[ChunkEncoder, PrefixCounter, BoundedCache]:
    """One per Python worker: the encoder, prefix counts and ids by chunk; the caches are bounded."""

    def make():
        encoder = ChunkEncoder(path)
        return encoder, PrefixCounter(path, encoder), BoundedCache(encoder.ids, _CHUNKS_KEPT, _CHUNK_BYTES)

    return worker_cache(("tokens", path), make)


def _path(tokenizer: str) -> str:
    return tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)


def encode(text: bytes, tokenizer: str = TOKENIZER) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit numbers."""
    return b"".join(map(_worker(_path(tokenizer))[2].__getitem__, text.split()))


def chunk_starts(text: bytes) -> np.ndarray:
    """Byte offsets at which chunks start."""
    space = _SPACE[np.frombuffer(text, np.uint8)]
    return np.flatnonzero(~space & np.append(True, space[:-1])) if len(text) else np.empty(0, np.int64)


def prefix_table(text: bytes, tokenizer: str = TOKENIZER) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which pre-tokens end, and the number of tokens up to each."""
    pairs = [*map(_worker(_path(tokenizer))[1].chunks.__getitem__, text.split())]
    sizes = np.fromiter(map(len, pairs), np.int64, len(pairs)) // 8
    flat = np.frombuffer(b"".join(pairs), "<u4").astype(np.int64).reshape(-1, 2)
    whole = flat[np.cumsum(sizes) - 1, 1]
    return flat[:, 0] + np.repeat(chunk_starts(text), sizes), flat[:, 1] + np.repeat(np.cumsum(whole) - whole, sizes)


def _cut_piece(text: bytes, ends: np.ndarray, done: int, tokenizer: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Of the pre-token behind the first ``done``: where it starts, and the ends of its characters with the tokens up to each."""
    start, end = int(ends[done - 1]) if done else 0, int(ends[done])
    piece = text[start:end].lstrip(b" \t\n\r\x0b\x0c")
    counts = np.frombuffer(_worker(_path(tokenizer))[1].cuts[piece], "<u4").astype(np.int64)
    letters = np.frombuffer(piece, np.uint8)
    return end - len(piece), end - len(piece) + np.flatnonzero(np.append((letters[1:] & 0xC0) != 0x80, True)) + 1, counts


def tokens_up_to(text: bytes, ends: np.ndarray, totals: np.ndarray, position: int, tokenizer: str = TOKENIZER) -> int:
    """Tokens of the first ``position`` bytes, which must end at a character."""
    done = int(np.searchsorted(ends, position, side="right"))
    before = int(totals[done - 1]) if done else 0
    if done == len(ends) or position == (ends[done - 1] if done else 0):
        return before
    _, stops, counts = _cut_piece(text, ends, done, tokenizer)
    inside = int(np.searchsorted(stops, position, side="right"))
    return before + (int(counts[inside - 1]) if inside else 0)


def longest_within(text: bytes, ends: np.ndarray, totals: np.ndarray, budget: int, tokenizer: str = TOKENIZER) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens; in a pre-token a longer prefix may have fewer tokens than a shorter one."""
    done = int(np.searchsorted(totals, budget, side="right"))
    if done == len(ends):
        return len(text)
    start, stops, counts = _cut_piece(text, ends, done, tokenizer)
    fits = np.flatnonzero(counts <= budget - (int(totals[done - 1]) if done else 0))
    return int(stops[fits[-1]]) if len(fits) else start


def count_tokens(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, keep_prefixes: bool = True, budget: int = LIMIT
) -> DataFrame:
    """Key, n_bytes, n_tokens, kept_bytes and, with ``keep_prefixes``, the prefix table of every row.

    All are read from the table, ``kept_bytes`` as the longest prefix of at most ``budget`` tokens. The
    table is two binary columns, ``ends`` and ``totals``, of little-endian unsigned 32-bit numbers, an
    entry a pre-token; without ``keep_prefixes`` it is left in the task. A null text counts as empty: 0
    bytes, 0 tokens, an empty table. Null or repeated keys make no difference; other columns are left out.
    """

    def run(batches: Batches):
        for batch in byte_slices(batches, column=1, size=1_000_000, rows=500):
            rows: dict[str, list] = {"n_bytes": [], "n_tokens": [], "kept_bytes": [], "ends": [], "totals": []}
            for data in batch.column(1).cast(pa.binary()).to_pylist():
                data = data or b""
                ends, totals = prefix_table(data, tokenizer)
                rows["n_bytes"].append(len(data))
                rows["n_tokens"].append(tokens_up_to(data, ends, totals, len(data)))
                rows["kept_bytes"].append(longest_within(data, ends, totals, budget))
                if keep_prefixes:
                    rows["ends"].append(ends.astype("<u4").tobytes())
                    rows["totals"].append(totals.astype("<u4").tobytes())
            kinds = dict.fromkeys(("n_bytes", "n_tokens", "kept_bytes"), pa.int64()) | ({"ends": pa.binary(), "totals": pa.binary()} if keep_prefixes else {})
            columns = [pa.array(rows[name], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *kinds])

    kind = documents.schema[key].dataType.simpleString()
    prefixes = ", ends binary, totals binary" if keep_prefixes else ""
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, kept_bytes bigint{prefixes}")


def truncated(counted: DataFrame, budget: int = LIMIT, *, key: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """Key and ``kept_bytes``, the longest prefix within ``budget``, from rows with text, ends and totals."""

    def run(batches: Batches):
        for batch in slices(batches):
            kept = []
            for data, ends, totals in zip(*(batch.column(i).cast(pa.binary()).to_pylist() for i in (1, 2, 3)), strict=True):
                kept.append(longest_within(data or b"", np.frombuffer(ends, "<u4"), np.frombuffer(totals, "<u4"), budget, tokenizer))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.int64())], names=[key, "kept_bytes"])

    kind = counted.schema[key].dataType.simpleString()
    return counted.select(key, text, "ends", "totals").mapInArrow(run, f"`{key}` {kind}, kept_bytes bigint")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(table(spark, sf_dir, "documents"), keep_prefixes=False, budget=LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("kept_bytes") < F.col("n_bytes")).alias("over_limit"))
