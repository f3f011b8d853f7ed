import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from assaysift.llm import codebooks

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, part int"


def brute(rows, rounds=codebooks.ROUNDS):
    """Lloyd rounds over all vectors at once, part by part, in plain loops."""
    kept = []
    for key, vector, label, *_ in rows:
        if vector and len(vector) % 16 == 0 and all(x is not None and math.isfinite(x) and abs(x) < 65536 for x in vector):
            kept.append((key, tuple(math.floor(256 * float(np.float32(x))) for x in vector), label))
    if not kept:
        return []
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(ordered[0][1])
    kept, ordered = ([r for r in some if len(r[1]) == size] for some in (kept, ordered))
    d = size // 16
    books = [[list(r[1][p * d : p * d + d]) for r in ordered[:64]] for p in range(16)]

    def near(p, part):
        return min((sum((x - c) ** 2 for x, c in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(16):
            members = defaultdict(list)
            for _, v, _ in kept:
                part = v[p * d : p * d + d]
                members[near(p, part)[1]].append(part)
            for e, own in members.items():
                books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    coded, labels = [], defaultdict(int)
    for key, v, label in kept:
        at = [near(p, v[p * d : p * d + d]) for p in range(16)]
        error = sum(a for a, _ in at)
        labels[label] += error
        coded.append((key, "".join(f"{e:02x}" for _, e in at), error, label))
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(k, code, error, labels[label], sha) for k, code, error, label in coded]


def agree(spark, rows, rounds=codebooks.ROUNDS, **options):
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    got = codebooks.compress(frame, rounds=rounds, **options)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows, rounds)))


@pytest.mark.parametrize(("rounds", "owner_rows"), [(2, 50_000), (2, 20), (6, 50)])
def test_equals_the_plain_version(spark, rounds, owner_rows):
    rng = np.random.default_rng(rounds)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(150)]
    rows += [(200 + i, rows[7][1], None) for i in range(60)]  # a common vector
    agree(spark, rows, rounds, owner_rows=owner_rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    fine = [(int(k), rng.standard_normal(16).astype(np.float32).tolist(), 1) for k in rng.permutation(90)]
    odd = [
        (-5, None, 1), (-4, [], 1), (-3, [None] * 16, 1), (-2, [float("nan")] * 16, 2), (-1, [float("inf")] * 16, 2), (500, [0.5] * 17, 2),
        (501, [0.5] * 32, 2), (502, [1e30] * 16, 2), (None, [0.25] * 16, None), (None, [0.25] * 16, 3), (3, fine[0][1], None), (3, fine[0][1], None),
        (4, [65535.9] * 16, 1), (5, [-65535.9] * 16, 1), (6, [-1 / 1024] * 16, 1),
    ]
    agree(spark, fine + odd)
    agree(spark, odd[:8])
    agree(spark, odd[:6])
    agree(spark, [])
    agree(spark, [(None, [0.5] * 16, None)])


def test_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(codebooks, "_BROADCAST_LABELS", 3)
    monkeypatch.setattr(codebooks, "_HOT_LABELS", 10)
    rng = np.random.default_rng(1)
    agree(spark, [(i, rng.standard_normal(16).astype(np.float32).tolist(), None if i % 9 == 1 else 0 if i % 3 == 0 else i // 2) for i in range(120)])


def test_only_changing_parts_migrate(spark, monkeypatch):
    dealt = []
    owned = codebooks._owned

    def counted(members, salts, rows):
        out = owned(members, salts, rows)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(codebooks, "_owned", counted)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist(), 0) for i in range(300)]
    agree(spark, rows, 5)
    assert dealt[0] == 300 * 16
    assert dealt == sorted(dealt, reverse=True)
    assert dealt[1] < dealt[0] / 2
