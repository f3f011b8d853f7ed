import math
import zlib

import numpy as np
import pytest

from assaysift.llm import boosting


def descend(trees, row):
    """One row down every tree, node by node."""
    total = trees.base
    for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf, strict=True):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        total += leaf[node - len(feature)]
    return total


def test_flat_traversal_equals_walking_each_tree():
    rng = np.random.default_rng(0)
    rows = np.round(rng.standard_normal((1_500, 6)), 1)
    y = (rows[:, 0] * rows[:, 1] + rows[:, 2] > 0).astype(float)
    trees = boosting.grow(rows, y, np.ones(len(y)), trees=100, depth=3)
    assert np.allclose(trees.raw(rows), [descend(trees, r) for r in rows])
    assert ((trees.score(rows) >= 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("seed", range(4))
def test_first_split_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 8, (200, 3)).astype(float)
    y = (rows[:, seed % 3] > rng.integers(2, 6)).astype(float)
    y[:10] = 1 - y[:10]
    weight = np.where(y == 1, 1.0, 2.0)
    tree = boosting.grow(rows, y, weight, trees=1, depth=1)
    share = (weight * y).sum() / weight.sum()
    g, h = weight * (y - share), weight * share * (1 - share)
    value = lambda m: g[m].sum() ** 2 / (h[m].sum() + boosting.RIDGE)
    gains = {}
    for f in range(3):
        for cut in np.arange(0.5, 7.5):
            left = rows[:, f] <= cut
            if min(h[left].sum(), h[~left].sum()) >= boosting.LEAST_WEIGHT:
                gains[f, cut] = value(left) + value(~left)
    f, cut = int(tree.feature[0, 0]), float(tree.cut[0, 0])
    assert gains[f, cut] == pytest.approx(max(gains.values()))
    left = rows[:, f] <= cut
    assert np.allclose(tree.leaf[0], [boosting.RATE * g[m].sum() / (h[m].sum() + boosting.RIDGE) for m in (left, ~left)])


def test_odd_samples():
    none = boosting.grow(np.zeros((0, 4)), np.zeros(0), np.zeros(0))
    assert none.score(np.zeros((2, 4))).tolist() == [0.5, 0.5]
    same = boosting.grow(np.ones((30, 4)), np.arange(30) % 2.0, np.ones(30), trees=3)
    assert np.allclose(same.score(np.ones((1, 4))), 0.5)
    one_class = boosting.grow(np.ones((30, 4)), np.ones(30), np.ones(30))
    assert one_class.score(np.ones((1, 4)))[0] > 0.99


def test_statistics_of_odd_texts():
    texts = [None, b"", b" ", b"\n\n", b"a", b"\0", "漢字".encode(), b"word " * 200_000, bytes(range(256))]
    found = boosting.statistics_of(texts)
    assert found.shape == (len(texts), len(boosting.FEATURES))
    assert np.isfinite(found).all()
    assert (found[0] == found[1]).all()
    by_name = dict(zip(boosting.FEATURES, boosting.statistics(b"Ab cd. Ab\n12 ##!!\nAb cd. Ab\n"), strict=True))
    assert by_name["log_words"] == pytest.approx(math.log1p(8))
    assert by_name["distinct_words"] == pytest.approx(4 / 8)
    assert by_name["common_word"] == pytest.approx(4 / 8)
    assert by_name["symbol_words"] == by_name["exclaimed_words"] == by_name["digit_words"] == pytest.approx(1 / 8)
    assert by_name["distinct_lines"] == pytest.approx(2 / 3)


def test_held_out_accuracy_and_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = boosting.op12_quality_classifier(spark, sf_dir).toPandas()
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").toPandas()
    assert sorted(got.doc_id) == sorted(documents.doc_id)
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().merge(got[got.held_out], on="doc_id")
    assert (labels.predicted[labels.quality == 0] == 0).mean() >= 0.9
    assert (labels.predicted[labels.quality == 1] == 1).mean() >= 0.98


def test_copies_weigh_no_more_and_odd_tables(spark):
    rows = [(i, f"some plain words number {i} and more of them. here", "x", 0.5) for i in range(60)]
    rows += [(100 + i, f"#### $$$ {i} %%% &&&", "x", 0.5) for i in range(60)] + [(300 + i, "#### $$$ 1 %%% &&&", "x", 0.5) for i in range(200)]
    rows += [(None, "words", "x", 0.1), (700, None, "x", 0.1), (701, "", "x", 0.1), (0, "again", "x", 0.1)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, k_ string, score double")
    labels = [(i, int(i < 100)) for i in range(500)] + [(None, 1), (700, 0), (5, None), (6, 7)]
    model = boosting.fit(documents, spark.createDataFrame(labels, "doc_id bigint, quality int"), trees=20)
    assert model.base == pytest.approx(math.log(61 / 60), abs=0.05)
    got = boosting.score(documents, model)
    assert got.columns == ["doc_id", "score"]
    scores = got.collect()
    assert len(scores) == len(rows)
    assert all((r.score >= 0.5) == (r.doc_id < 100) for r in scores if r.doc_id and r.doc_id < 700)
    unlabelled = boosting.fit(documents, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert {r.score for r in boosting.score(documents, unlabelled).collect()} == {0.5}
    assert boosting.score(documents.limit(0), model).collect() == []
