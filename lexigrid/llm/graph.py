"""Connected components of large sparse graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexigrid.plans.scale import materialized


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for each node of ``edges (a, b)``; nodes are 64-bit hashes.

    Each round every root that is left hooks onto its smallest neighbour and the edges are
    rewritten between the new roots, until none is left. Hashed ids stand in random order, so
    each round drops a constant share of the roots. Only aggregates and equality joins are used;
    the tables of each round are checkpointed. No edges give no rows.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = materialized(edges)
    roots = None
    while not edges.isEmpty():
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialized(ends.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("to")))
        if roots is None:
            roots = hooks.select("id", F.col("to").alias("root"))
        else:
            moved = hooks.select(F.col("id").alias("root"), "to")
            roots = roots.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        roots = materialized(roots)
        left = hooks.select(F.col("id").alias("a"), F.col("to").alias("_a"))
        right = hooks.select(F.col("id").alias("b"), F.col("to").alias("_b"))
        moved = edges.join(left, "a").join(right, "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        edges = materialized(moved.filter("a < b").distinct())
    if roots is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots
