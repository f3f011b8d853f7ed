import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest

from assaysift.llm import alignment


def brute(texts):
    """Groups by sets of ends, without windows; counts over all rows."""
    a_side, b_side = (side(alignment._path(p)) for side, p in ((alignment.ByteSide, alignment.BYTE_TOKENIZER), (alignment.PieceSide, alignment.PIECE_TOKENIZER)))
    rows, held = [], Counter()
    for text in texts:
        groups, a, b = [], [], []
        if text:
            a = a_side.library.encode(" " + text, add_special_tokens=False).ids
            b = b_side.library.encode(text)
            if not b"".join(a_side.bytes[i] for i in a) == b" " + text.encode() == b"".join(b_side.bytes[i] for i in b):
                a, b = [], []
        ends = []
        for ids, side in ((a, a_side), (b, b_side)):
            at, own = 0, []
            for i in ids:
                at += len(side.bytes[i])
                own.append(at)
            ends.append(own)
        shared = sorted(set(ends[0]) & set(ends[1]))
        of = defaultdict(lambda: ([], []))
        for side, (ids, own) in enumerate(((a, ends[0]), (b, ends[1]))):
            for i, e in zip(ids, own):
                of[bisect_left(shared, e)][side].append(i)
        groups = [of[n] for n in range(len(shared))]
        links = [(x, y) for left, right in groups for x in left for y in right]
        held.update(set(links))
        rows.append((len(a), len(b), groups, links))
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    out = []
    for n_a, n_b, groups, links in rows:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        best = sum(held[link] == highest[link[0]] for link in links)
        sha = hashlib.sha256(text.encode()).hexdigest() if n_a else ""
        out.append((n_a, n_b, len(groups), len(links), best, sum(held[link] for link in links), sha))
    return out


TEXTS = [
    None, "", " ", "a", "  two  spaces ", "\n\tlines\n\n and tabs", "The quick brown fox jumps over the lazy dog.", "The quick brown fox",
    "naïve café — 漢字かな交じり文 and 한국어, \U0001f600\U0001f9d1‍\U0001f52c", "<|endoftext|> </s> <0x41> [MASK]", "tab▁mark",
    "null\0byte", "a b c", "é ﬁ Å", "1234567890 12 345.67e-8", "x" * 500, " " * 300, "漢字" * 200, "=-" * 400 + " end",
    "same text", "same text", "word " * 2_000, "Ing that of. Ontiontion as thatndou the antiing thin\nReoush hewh",
]


@pytest.mark.parametrize("hot", [1, 3, alignment.HOT_PAIRS])
def test_equals_the_plain_version(spark, hot):
    texts = TEXTS + [f"number {i} of a series of texts {i * i}" for i in range(40)]
    rows = [(None if i == 3 else i // 2, t, "other", 1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, row string, n_a int").repartition(3)
    got = alignment.link_counts(frame, hot_pairs=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    expected = [(r[0], *b) for r, b in zip(rows, brute(texts), strict=True)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_windows_are_remembered_and_forgotten(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_WINDOWS", 5)
    aligner = alignment.Aligner(alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER)
    first = aligner.align(["one two three"] * 3)
    assert len(aligner.memo.known) == 3
    aligner.align(["four five six seven"])
    again = aligner.align(["one two three"] * 3)
    assert len(aligner.memo.known) == 3
    assert first["groups_sha256"] == again["groups_sha256"]


def test_long_text_and_empty_table(spark):
    long = " ".join(f"word{i % 997} and" for i in range(20_000))
    got = alignment.link_counts(spark.createDataFrame([(1, long)], "doc_id bigint, text string")).collect()
    assert tuple(got[0])[1:] == brute([long])[0]
    assert alignment.link_counts(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_words_are_tokenised_like_whole_texts():
    side = alignment.ByteSide(alignment._path(alignment.BYTE_TOKENIZER))
    assert side.by_word
    pieces = ["it's", "I'LL", "don't", "  ", "\n\n", "\t \r\n", "a1b22", "--!!", "'", "''s", "é", "Übergröße", "x'd'ye", "3.14", "<|endoftext|>", " ", "$%_", "`~", "\r"]
    rng = np.random.default_rng(0)
    for _ in range(400):
        text = "".join(rng.choice(pieces, int(rng.integers(1, 12))))
        assert side.encode(text).tolist() == side.library.encode(" " + text, add_special_tokens=False).ids, text
    assert len(side.words)


def test_single_words_have_the_ids_of_the_library():
    side = alignment.ByteSide(alignment._path(alignment.BYTE_TOKENIZER))
    for word in (" plain", "plain", " Été", " ", "  ", "'s", " 42", " ...", "\n", " naïve", "--", " x", " thndatin"):
        ids = side.library.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(side._word(word), "<u4").tolist() == ids
