import numpy as np

from assaysift.llm import forest


def brute(rows, cosine=0.93):
    usable = {}
    for i, (_, vector, label) in enumerate(rows):
        if label is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            usable.setdefault((label, len(vector)), []).append(i)
    links = {i: set() for i in range(len(rows))}
    for members in usable.values():
        m = np.array([rows[i][1] for i in members], np.float64)
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(m @ m.T >= cosine), strict=True):
            if a != b:
                links[members[a]].add(members[b])
    least = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        least[i] = min(keys) if keys else None
    return [(k, len(links[i]), least[i]) for i, (k, _, _) in enumerate(rows)]


def vectors(rng, n, copies, noise, labels):
    rows = []
    for base in rng.standard_normal((n, 64)):
        label = int(rng.integers(labels))
        rows += [(len(rows) + i, (base + noise * rng.standard_normal(64)).astype(np.float32).tolist(), label) for i in range(copies)]
    return rows


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = vectors(rng, 60, 3, 0.2, 3)
    one = rows[0][1]
    rows += [
        (900, None, 1), (901, [0.0] * 64, 1), (902, [None] * 64, 1), (903, [float("nan")] * 64, 1), (904, [float("inf")] * 64, 1), (905, [], 1),
        (906, one, None), (907, one, rows[0][2]), (907, one, rows[0][2]), (None, one, rows[0][2]), (908, [1.0, 2.0], 1), (909, [2.0, 4.0], 1),
        (910, [-0.0, 1.0], 2), (911, [0.0, 1.0], 2), (None, [3.0, -9.0], 2), (912, [1e38] * 64, 2), (913, [1e-38] * 64, 2),
    ]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<float>, label int, id string, weight int").repartition(3)
    got = forest.near_duplicates(df).collect()
    text = lambda x: tuple(map(str, x))
    assert sorted(text((r.vec_id, r.n_links, r.component_id)) for r in got) == sorted(map(text, brute(rows)))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert forest.near_duplicates(df.limit(0)).count() == 0


def test_recall_with_many_leaves_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = vectors(rng, 700, 3, 0.18, 2) + [(5000 + i, v, label) for i, (_, v, label) in enumerate(vectors(rng, 1, 150, 0.1, 1))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    true = {k: (n, c) for k, n, c in brute(rows)}
    monkeypatch.setattr(forest, "BLOCK", 60)
    got = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_duplicates(df, leaf=150).collect()}
    assert all(got[k][0] <= true[k][0] for k in true)
    assert sum(n for n, _ in got.values()) >= 0.9 * sum(n for n, _ in true.values())
    assert sum(got[k][1] == true[k][1] for k in true) >= 0.95 * len(true)
