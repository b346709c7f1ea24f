"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logrisk.sources.scratch import materialize


def _pull(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to the least node that it knows, itself included."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
    moved = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("to").alias("b")).distinct()


def _push(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("to"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("to")).select(F.col("b").alias("a"), F.col("to").alias("b"))
    return moved.union(least.select("a", F.col("to").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b``; the root is the component's least node.

    Edges are moved towards the least nodes in turn until only stars are left, which takes few
    rounds; each round is stored. No node's neighbours are ever gathered.
    """
    now = materialize(edges.filter("a <> b").select("a", "b").distinct(), "components")
    before = None
    while True:
        now = materialize(_push(_pull(now)), "components")
        edge = F.xxhash64("a", "b")
        state = now.agg(F.count("*"), F.bit_xor(edge), F.sum(edge.cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
