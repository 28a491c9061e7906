"""Distributed connected components (alternating large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the least node ``m`` of u's neighbourhood.

    The minimum is an aggregate with partial sums in every task, and the join
    back is an equi-join that adaptive execution splits, so a node with a third
    of all edges is no task of its own."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")
    return edges.join(least, F.col("u") == F.col("_u")).drop("_u")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge table; ``root`` is the least node
    of the component. Any orderable node type.

    Edges with a NULL end and loops are dropped (a node that has no other edge
    does not appear). Each round is written to the shared folder; rounds stop
    when the edge table no longer changes, after a number that grows with the
    logarithm of the largest component."""
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter(F.col("x") != F.col("y"))
    e = materialize(e.select(F.least("x", "y").alias("v"), F.greatest("x", "y").alias("u")).distinct(), "cc")
    seen = None
    while not e.isEmpty():
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_least(both).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        small = _least(large)
        e = materialize(small.select("u", F.col("m").alias("v"))
                        .union(small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
                        .distinct(), "cc")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
