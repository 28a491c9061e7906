"""Random forests as plain expressions: compile, score, explain.

A fitted forest is a few thousand numbers. ``read_forest`` takes them out of a
saved model; ``node_column`` compiles a tree into nested conditions over feature
columns, so a forest scores rows in batch and in streams without a model object
and, as text (``node_sql``), in any SQL engine. ``importances`` recomputes what
each feature contributes over any labelled rows, not only those of the fit.

Nodes are numbered as in a heap: root 1, children 2i and 2i + 1, so a leaf's
ancestors are its number shifted right.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.session import scratch_path


@dataclass(frozen=True)
class Leaf:
    """Training weight of the two classes."""
    negative: float
    positive: float

    @property
    def share(self) -> float:
        total = self.negative + self.positive
        return self.positive / total if total else 0.0


@dataclass(frozen=True)
class Split:
    """``x[feature] <= threshold`` goes left."""
    feature: int
    threshold: float
    left: Split | Leaf
    right: Split | Leaf


Tree = Split | Leaf


def read_forest(model, spark: SparkSession) -> list[Tree]:
    """Trees of a fitted binary forest, from the node table that saving it writes."""
    path = scratch_path(spark, "forest")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()       # trees x 2^depth rows
    by_id = {(n["treeID"], n["id"]): n for n in nodes}

    def build(tree: int, at: int) -> Tree:
        n = by_id[tree, at]
        if n["leftChild"] < 0:
            return Leaf(*map(float, n["impurityStats"]))
        return Split(n["split"]["featureIndex"], float(n["split"]["leftCategoriesOrThreshold"][0]),
                     build(tree, n["leftChild"]), build(tree, n["rightChild"]))

    return [build(t, 0) for t in sorted({t for t, _ in by_id})]


def depth(tree: Tree) -> int:
    return 0 if isinstance(tree, Leaf) else 1 + max(depth(tree.left), depth(tree.right))


def splits(tree: Tree, node: int = 1) -> list[tuple[int, int]]:
    """(node, feature) of every inner node."""
    if isinstance(tree, Leaf):
        return []
    return [(node, tree.feature), *splits(tree.left, 2 * node), *splits(tree.right, 2 * node + 1)]


def leaf_share(node: int, leaf: Leaf) -> float:
    return leaf.share


def leaf_number(node: int, leaf: Leaf) -> int:
    return node


def node_column(tree: Tree, x: list[Column], value: Callable = leaf_share, node: int = 1) -> Column:
    """The value of the leaf that a row falls into; ``x`` are the feature columns."""
    if isinstance(tree, Leaf):
        return F.lit(value(node, tree))
    return F.when(x[tree.feature] <= F.lit(tree.threshold), node_column(tree.left, x, value, 2 * node)) \
            .otherwise(node_column(tree.right, x, value, 2 * node + 1))


def node_sql(tree: Tree, x: list[str], value: Callable = leaf_share, node: int = 1) -> str:
    """:func:`node_column` as a SQL expression."""
    if isinstance(tree, Leaf):
        v = value(node, tree)
        return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else repr(v)
    return (f"CASE WHEN {x[tree.feature]} <= {tree.threshold!r} THEN {node_sql(tree.left, x, value, 2 * node)} "
            f"ELSE {node_sql(tree.right, x, value, 2 * node + 1)} END")


def forest_score(df: DataFrame, trees: list[Tree], x: list[Column], probability: str = "probability_rf",
                 flag: str = "anomaly_rf") -> DataFrame:
    """K4 scoring: mean positive share of the trees' leaves, and 1 where it is over a half."""
    p = functools.reduce(operator.add, [node_column(t, x) for t in trees]) / F.lit(float(len(trees)))
    df = df.withColumn(probability, p)
    return df.withColumn(flag, F.when(F.col(probability) > 0.5, 1).otherwise(0))


def forest_sql(trees: list[Tree], x: list[str]) -> str:
    """:func:`forest_score`'s probability as a SQL expression."""
    return "(" + " + ".join(node_sql(t, x) for t in trees) + f") / {float(len(trees))!r}"


def importances(labelled: DataFrame, trees: list[Tree], x: list[Column], label: str, features: list[str]) -> DataFrame:
    """K5: (feature, importance) of a forest over labelled rows (label 0 or 1).

    A split's gain is the Gini impurity of the rows that reach it less that of its
    two sides, weighted by rows. Gains add up by feature, are normalised within
    each tree, averaged over the trees and normalised again. Rows are counted by
    (tree, leaf) with partial sums in every task; what follows has one row a node.
    A feature that no split uses gets 0; without any gain all are 0."""
    spark = labelled.sparkSession
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("tree"), node_column(t, x, leaf_number).cast("long").alias("leaf"))
                             for i, t in enumerate(trees)]))
    leaves = (labelled.select(F.col(label).cast("double").alias("y"), at.alias("at"))
              .groupBy("at.tree", "at.leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive")))
    deepest = max(map(depth, trees))
    path = F.explode(F.transform(F.sequence(F.lit(0), F.lit(deepest)), lambda k: F.call_function("shiftright", F.col("leaf"), k)))
    nodes = (leaves.select("tree", path.alias("node"), "n", "positive").filter("node > 0")
             .groupBy("tree", "node").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive")))
    negative = F.col("n") - F.col("positive")
    impurity = F.col("n") - (F.col("positive") * F.col("positive") + negative * negative) / F.col("n")
    nodes = nodes.select("tree", "node", impurity.alias("impurity"))
    parts = nodes.union(nodes.filter("node > 1").select("tree", F.shiftright("node", 1), -F.col("impurity")))
    inner = spark.createDataFrame([(i, n, f) for i, t in enumerate(trees) for n, f in splits(t)] or [(0, 0, 0)],
                                  "tree int, node long, feature int")
    gains = (parts.join(F.broadcast(inner), ["tree", "node"])          # a row for each split of the forest
             .groupBy("tree", "feature").agg(F.sum("impurity").alias("gain")))
    of_tree = gains.groupBy("tree").agg(F.sum("gain").alias("total")).filter("total > 0")
    share = gains.join(of_tree, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("total")).alias("share"))
    total = share.agg(F.sum("share").alias("s")).scalar()
    names = spark.createDataFrame(list(enumerate(features)), "feature int, name string")
    return names.join(share, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce(F.col("share") / total, F.lit(0.0)).alias("importance"))


def importances_sql(rows: str, trees: list[Tree], x: list[str], label: str, features: list[str]) -> str:
    """CTEs ending in ``imp`` (feature, importance) for :func:`importances` over the CTE ``rows``."""
    leaves = " UNION ALL ".join(f"SELECT {i} AS tree, {node_sql(t, x, leaf_number)} AS leaf, {label} AS y FROM {rows}"
                                for i, t in enumerate(trees))
    inner = ", ".join(f"({i}, {n}, {f})" for i, t in enumerate(trees) for n, f in splits(t))
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(features))
    return f"""imp_leaf AS ({leaves}),
imp_node AS (SELECT tree, leaf >> k AS node, count(*) AS n, sum(y) AS pos FROM imp_leaf, range(0, {max(map(depth, trees)) + 1}) r(k)
  WHERE leaf >> k > 0 GROUP BY tree, leaf >> k),
imp_mass AS (SELECT tree, node, n - (pos * pos + (n - pos) * (n - pos)) / n AS mass FROM imp_node),
imp_gain AS (SELECT i.tree, i.feature, sum(p.mass - coalesce(l.mass, 0) - coalesce(r.mass, 0)) AS gain
  FROM (VALUES {inner}) i(tree, node, feature) JOIN imp_mass p ON p.tree = i.tree AND p.node = i.node
  LEFT JOIN imp_mass l ON l.tree = i.tree AND l.node = 2 * i.node LEFT JOIN imp_mass r ON r.tree = i.tree AND r.node = 2 * i.node + 1
  GROUP BY i.tree, i.feature),
imp_share AS (SELECT feature, sum(gain / total) AS share FROM imp_gain
  JOIN (SELECT tree, sum(gain) AS total FROM imp_gain GROUP BY tree HAVING sum(gain) > 0) t USING (tree) GROUP BY feature),
imp AS (SELECT f.name AS feature, coalesce(share / (SELECT sum(share) FROM imp_share), 0) AS importance
  FROM (VALUES {names}) f(i, name) LEFT JOIN imp_share s ON s.feature = f.i)"""
