"""Connected components as joins, for links between keys that are whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that a link touches; all nodes of a component share one root, no particular one.

    Each round every node joins the smallest of its neighbours and itself; following these steps to
    their ends gives heads, and the links between different heads go on to the next round. A star
    takes one round, any graph at most log2(nodes) of them, as every head but the last has a larger
    neighbour that is none. Hubs only meet aggregations that combine before the shuffle.
    """
    rest = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"), "links")
    labels = None
    while rest.limit(1).count():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        heads = both.groupBy("a").agg(F.min("b").alias("b"))
        heads = _followed(stored(heads.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "heads"))
        if labels is None:
            labels = heads
        else:
            labels = stored(labels.join(heads.select(F.col("node").alias("root"), F.col("root").alias("far")), "root", "left")
                            .select("node", F.coalesce("far", "root").alias("root")), "labels")
        of_a, of_b = (heads.select(F.col("node").alias(c), F.col("root").alias(f"{c}_head")) for c in ("a", "b"))
        rest = rest.join(of_a, "a").join(of_b, "b").select(F.col("a_head").alias("a"), F.col("b_head").alias("b"))
        rest = stored(rest.where("a <> b").distinct(), "links")
    return labels if labels is not None else rest.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _followed(heads: DataFrame) -> DataFrame:
    """Every node with the end of its chain of steps, by pointer jumping."""
    while True:
        onward = heads.where("node <> root").select(F.col("node").alias("root"), F.col("root").alias("far"))
        jumped = heads.join(onward, "root", "left").select("node", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved"))
        if not jumped.where("moved").limit(1).count():
            return heads
        heads = stored(jumped.drop("moved"), "heads")
