"""Connected components by alternating large-star and small-star steps; edges never leave Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b), both long; root is the component's smallest node.

    Each round joins the edges with every node's smallest neighbour: first all larger neighbours move to it, then all
    smaller ones. A popular node costs its own edges, pre-aggregated before the shuffle, and joins split hot keys.
    Every round is stored, so lineage stays short. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        large = (
            both.filter("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        ).distinct()
        # every edge now goes from a larger to a smaller node
        below = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(below, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = stored(moved.union(below.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
