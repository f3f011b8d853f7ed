"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors of a label are one class with a weight. Trees are fitted on a bounded sample: each node
splits at the median of a random projection, and vectors within a margin of the split go to both sides.
Every class is then routed through all trees; classes meet in the leaves of any tree, per label, and are
compared there by cosine in double precision. A pair that shares several leaves is counted in the first
of them only, which each leaf can tell from the leaf numbers its vectors carry, so link counts need no
list of pairs. A leaf passes on a sum per class and a spanning forest of its links. Leaves of more than
``BLOCK`` classes are split in blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, parts_for, stored, table
from .graph import components

COSINE = 0.93
TREES = 6
SAMPLE = 20_000  #: bound of the vectors that the trees are fitted on
LEAF = 2_000  #: a tree splits until its leaves hold about so many classes
SPILL = 0.16  #: the margin on unit vectors, times sqrt(dimensions). Two at cosine 0.93 differ by about 0.37 in that unit, so
#: one split parts them in about 1 case of 30 (of vectors spread evenly), and goes to 13 % of the vectors twice
BLOCK = 1_000
GROUP_ROWS = 4_000


class ProjectionTree:
    """Nodes in arrays; a leaf has its number in ``left`` as -1 - number."""

    def __init__(self, sample: np.ndarray, leaf_rows: float, spill: float, rng: np.random.Generator):
        self.directions: list[np.ndarray] = []
        self.splits: list[float] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.leaves, self.spill = 0, spill / np.sqrt(max(1, sample.shape[1]))
        self._grow(sample, leaf_rows, rng)

    def _grow(self, rows: np.ndarray, leaf_rows: float, rng: np.random.Generator) -> int:
        if len(rows) > max(leaf_rows, 20):
            for _ in range(3):
                direction = rng.standard_normal(rows.shape[1])
                direction /= np.linalg.norm(direction)
                along = rows @ direction
                split = float(np.median(along))
                below, above = along <= split + self.spill, along > split - self.spill
                if max(below.sum(), above.sum()) <= 0.9 * len(rows):  # else too dense for this line
                    node = self._node(direction, split)
                    self.left[node] = self._grow(rows[below], leaf_rows, rng)
                    self.right[node] = self._grow(rows[above], leaf_rows, rng)
                    return node
        self.leaves += 1
        return -self.leaves

    def _node(self, direction: np.ndarray, split: float) -> int:
        self.directions.append(direction)
        self.splits.append(split)
        self.left.append(0)
        self.right.append(0)
        return len(self.splits) - 1

    def route(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every place a row gets to."""
        places, todo = [], [(0 if self.splits else -1, np.arange(len(rows)))]
        while todo:
            node, which = todo.pop()
            if node < 0:
                places.append((which, np.full(len(which), -1 - node)))
                continue
            along = rows[which] @ self.directions[node]
            todo.append((self.left[node], which[along <= self.splits[node] + self.spill]))
            todo.append((self.right[node], which[along > self.splits[node] - self.spill]))
        return np.concatenate([p[0] for p in places]), np.concatenate([p[1] for p in places])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow of squares
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_trees(classes: DataFrame, *, trees: int, leaf: int, spill: float, sample: int, dimensions: int) -> list[ProjectionTree]:
    """Trees over a sample of about ``sample`` classes, picked by a hash; all classes are routed later."""
    n = classes.count()
    share = min(1.0, sample / max(1, n))
    draw = F.pmod(F.xxhash64(F.lit("forest"), "id"), F.lit(1 << 30)) / float(1 << 30)
    rows = classes.where(draw < share).select("vector").toArrow()
    matrix = _unit(_matrix(rows["vector"].combine_chunks())) if len(rows) else np.empty((0, dimensions))
    return [ProjectionTree(matrix, leaf * share, spill, np.random.default_rng(i)) for i in range(trees)]


def _classes(vectors: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """All rows numbered, with the class of those that can link; and the classes: id, label, size, weight, least key, vector."""
    values = F.col("vector")
    sound = values.isNotNull() & F.col("label").isNotNull() & F.coalesce(
        F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0), F.lit(False)
    )
    kind = "float" if vectors.schema[vector].dataType.elementType.simpleString() == "float" else "double"  # floats are doubles too, at half the size
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast(f"array<{kind}>").alias("vector")
    )
    rows = rows.withColumn("vector", F.when(sound, F.transform("vector", lambda x: x + F.lit(0.0).cast(kind))))  # one zero only
    rows = stored(rows, "vectors")
    usable = rows.where("vector is not null")
    classes = usable.groupBy("label", "vector").agg(F.min("row").alias("id"), F.count("*").alias("weight"), F.min("key").alias("least"))
    classes = stored(classes.withColumn("dimensions", F.size("vector")), "classes")
    return rows, classes


def _compare(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Of one leaf (or two blocks of it): per class the summed weight of its links counted here; spanning links."""
    out_id, out_links, out_a, out_b = [], [], [], []
    for (place, _label), leaf in group.groupby(["place", "label_id"], sort=False):
        unit = _unit(np.stack(leaf["vector"].to_numpy()).astype(np.float64))
        ids, weight, own = leaf["id"].to_numpy(), leaf["weight"].to_numpy(np.int64), leaf["own"].to_numpy()
        linked = unit @ unit.T >= cosine
        np.fill_diagonal(linked, False)
        left, right = leaf["left"].iloc[0], leaf["right"].iloc[0]
        if left >= 0 and left != right:  # within a block is another task's
            linked &= own[:, None] != own[None, :]
        if not linked.any():
            continue
        # a pair counts here only if no leaf of a smaller number has both
        codes = [c[c < place] for c in leaf["places"]]
        known = np.unique(np.concatenate(codes)) if codes else np.empty(0)
        if len(known):
            incidence = np.zeros((len(leaf), len(known)), np.float32)
            for i, c in enumerate(codes):
                incidence[i, np.searchsorted(known, c)] = 1
            counted = linked & ~(incidence @ incidence.T > 0)
        else:
            counted = linked
        sums = counted @ weight
        some = np.flatnonzero(sums)
        out_id += ids[some].tolist()
        out_links += sums[some].tolist()
        tied = np.arange(len(leaf))  # spanning forest: breadth first
        done = np.zeros(len(leaf), bool)
        for start in range(len(leaf)):
            if done[start]:
                continue
            done[start], front = True, [start]
            while front:
                at = front.pop()
                fresh = tied[linked[at] & ~done]
                done[fresh] = True
                front += fresh.tolist()
                out_a += [ids[at]] * len(fresh)
                out_b += ids[fresh].tolist()
    n = len(out_id)
    return pd.DataFrame(
        {"id": out_id + [None] * len(out_a), "links": out_links + [None] * len(out_a), "a": [None] * n + out_a, "b": [None] * n + out_b}, dtype="Int64"
    )


def near_duplicates(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, trees: int = TREES,
    leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE,
) -> DataFrame:
    """Key, n_links, component_id (smallest key reachable), kept (key = component_id) and row_key of every row.

    Only rows of equal labels are compared, and only vectors of equal length. Vectors that are null,
    empty, zero or hold a null, NaN or infinity, and rows with a null label, link with nothing: 0 links,
    a component of their own key. Equal vectors link with one another. A component of null keys only has
    a null component_id and is not kept; other columns are left out.
    """
    rows, classes = _classes(vectors, key, vector, label)
    sizes = sorted(r[0] for r in classes.select("dimensions").distinct().collect())  # one row per vector length in use
    found = None
    for d in sizes:
        part = _links_of_length(classes.where(F.col("dimensions") == d), cosine, fit_trees(classes.where(F.col("dimensions") == d), trees=trees, leaf=leaf, spill=spill, sample=sample, dimensions=d), leaf)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.col("key").isNotNull().alias("kept"), F.col("row").alias("row_key"))
    found = stored(found, "leaf-links")
    counts = found.where("id is not null").groupBy("id").agg(F.sum("links").alias("others"))
    roots = components(found.where("a is not null").select("a", "b")).withColumnRenamed("node", "id")
    least = classes.join(roots, "id").groupBy("root").agg(F.min("least").alias("component"))
    told = classes.join(counts, "id", "left").join(roots.join(least, "root").drop("root"), "id", "left")
    told = told.select(
        "label", "vector", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "least").alias("component")
    )
    joined = rows.join(told, ["label", "vector"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component"))
    return joined.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"), F.col("row").alias("row_key"),
    )


def _links_of_length(classes: DataFrame, cosine: float, forest: list[ProjectionTree], leaf: int) -> DataFrame:
    offsets = np.cumsum([0, *(t.leaves for t in forest)])
    shared = classes.sparkSession.sparkContext.broadcast(forest)  # bounded by the sample

    def route(batches: Batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(1))) if batch.num_rows else np.empty((0, 1))
            row, place = [], []
            for tree, offset in zip(shared.value, offsets, strict=False):
                a, b = tree.route(unit) if len(unit) else (np.empty(0, int), np.empty(0, int))
                row.append(a)
                place.append(b + offset)
            row, place = np.concatenate(row), np.concatenate(place)
            order = np.lexsort((place, row))
            bounds = np.searchsorted(row[order], np.arange(batch.num_rows + 1))
            places = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(place[order], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(3), places], names=["id", "vector", "label_id", "weight", "places"])

    source = classes.select("id", "vector", F.xxhash64("label").alias("label_id"), "weight")
    # labels are compared as 64-bit hashes within a leaf only after equal labels were grouped by value
    kind = classes.schema["vector"].dataType.simpleString()
    routed = stored(source.mapInArrow(route, f"id bigint, vector {kind}, label_id bigint, weight bigint, places array<int>"), "routed")
    spread = routed.select("id", "label_id", "places", F.explode("places").alias("place"))
    sizes = stored(spread.groupBy("place", "label_id").agg(F.count("*").alias("n")).where("n > 1"), "leaf-sizes")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = parts_for(total, GROUP_ROWS)
    placed = routed.withColumn("place", F.explode("places")).join(sizes, ["place", "label_id"])
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    placed = placed.withColumn("blocks", blocks).withColumn("own", own)
    large = F.col("blocks") > 1
    other = F.explode(F.when(large, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(-1))))
    dealt = placed.select("id", "vector", "label_id", "weight", "places", "place", "own", "blocks", other.alias("other"))
    part = F.when(large, F.xxhash64("place", "label_id")).otherwise(F.pmod(F.xxhash64("place", "label_id"), F.lit(parts)))
    dealt = dealt.select(
        "id", "vector", "label_id", "weight", "places", "place", "own", part.alias("part"),
        F.when(large, F.least("own", "other")).otherwise(-1).alias("left"), F.when(large, F.greatest("own", "other")).otherwise(-1).alias("right"),
    )
    return dealt.groupBy("part", "left", "right").applyInPandas(lambda g: _compare(g, cosine), "id bigint, links bigint, a bigint, b bigint")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


ORACLE_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1) USING (vec_id)
"""
