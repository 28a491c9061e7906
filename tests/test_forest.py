"""Compiled forests and mixtures against the fitted models; Lloyd's rounds against numpy."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from barwatch.operators import detectors as dt
from barwatch.operators import forest as rf
from barwatch.operators import report as rp
from barwatch.plans import ml
from barwatch.session import materialize, scratch_path
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def rows(spark):
    g = np.random.default_rng(5)
    x = g.normal(size=(600, 3)) @ np.array([[1.0, 0.4, 0.0], [0.0, 1.0, -0.3], [0.0, 0.0, 1.2]])
    y = ((x[:, 0] > 0.8) | (x[:, 1] * x[:, 2] < -0.7)).astype(float)
    table = [(int(i), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(table, "id long, a double, b double, c double, label double")
    return materialize(df.withColumn("features", array_to_vector(F.array("a", "b", "c"))), "test-rows")


def cols():
    return [F.col(c) for c in "abc"]


def test_compiled_forest_scores_like_the_model(spark, rows):
    model = RandomForestClassifier(numTrees=12, maxDepth=4, seed=3).fit(rows)
    trees = rf.read_forest(model, spark)
    assert len(trees) == 12 and max(map(rf.depth, trees)) <= 4
    both = rf.forest_score(model.transform(rows), trees, cols())
    p = dt.vector_array("probability")[1]
    off = both.filter((F.abs(F.col("probability_rf") - p) > 1e-12) | (F.col("anomaly_rf") != F.col("prediction").cast("int")))
    assert off.count() == 0 and {r[0] for r in both.select("anomaly_rf").distinct().collect()} == {0, 1}


def test_sql_form_scores_alike(spark, rows):
    import duckdb
    trees = ml.PINNED_FOREST
    zs = [f"z{i}" for i in range(6)]
    g = np.random.default_rng(1).normal(scale=2.0, size=(300, 6))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(g)], "id int, " + ", ".join(f"{z} double" for z in zs))
    got = {r.id: r.probability_rf for r in rf.forest_score(df, trees, [F.col(z) for z in zs]).collect()}
    con = duckdb.connect()
    con.register("t", df.toPandas())
    assert got == dict(con.sql(f"SELECT id, {rf.forest_sql(trees, zs)} FROM t").fetchall())


def test_importances_equal_the_fitted_models(spark, rows):
    # Without bootstrap every tree is fitted on these very rows.
    model = RandomForestClassifier(numTrees=9, maxDepth=5, seed=8, bootstrap=False).fit(rows)
    got = {r.feature: r.importance for r in rf.importances(rows, rf.read_forest(model, spark), cols(), "label", list("abc")).collect()}
    assert got == pytest.approx(dict(zip("abc", model.featureImportances.toArray())), abs=1e-9)


def test_importances_without_any_gain(spark, rows):
    stump = [rf.Leaf(3.0, 1.0)]
    assert [r.importance for r in rf.importances(rows, stump, cols(), "label", list("abc")).collect()] == [0.0] * 3
    useless = [rf.Split(0, 1e9, rf.Leaf(1.0, 0.0), rf.Leaf(0.0, 1.0))]
    assert [r.importance for r in rf.importances(rows, useless, cols(), "label", list("abc")).collect()] == [0.0] * 3
    assert rf.Leaf(0.0, 0.0).share == 0.0
    empty = rows.limit(0)
    assert [r.importance for r in rf.importances(empty, useless, cols(), "label", list("abc")).collect()] == [0.0] * 3


def test_mixture_posterior_equals_the_fitted_models(spark, rows):
    model = dt.gmm_fit(rows, k=3)
    g = model.gaussiansDF.collect()
    far = spark.createDataFrame([(-1, 1e3, -1e3, 1e3, 0.0)], "id long, a double, b double, c double, label double")
    far = far.withColumn("features", array_to_vector(F.array("a", "b", "c")))
    every = model.transform(rows.unionByName(far)).withColumnRenamed("probability", "own")
    x = dt.gmm_posterior(every, cols(), model.weights, [r["mean"].toArray() for r in g], [r["cov"].toArray() for r in g], dt.MLLIB_FLOOR)
    for r in x.collect():
        assert r.probability == pytest.approx(r.own.toArray().tolist(), abs=1e-9)
    assert x.filter("id = -1").first().probability == pytest.approx([1 / 3] * 3)     # far from every component: equal shares
    free = dt.gmm_posterior(every, cols(), model.weights, [r["mean"].toArray() for r in g], [r["cov"].toArray() for r in g])
    assert max(free.filter("id = -1").first().probability) > 0.9                    # without the floor nothing underflows


def test_diagonal_factor_is_the_plain_density():
    (const, mu, factor), = dt.mixture_terms([0.5], [[1.0, 2.0]], [[[4.0, 0.0], [0.0, 0.25]]])
    assert mu == [1.0, 2.0] and np.allclose(factor, [[0.5, 0.0], [0.0, 2.0]])
    assert const == pytest.approx(math.log(0.5) - math.log(2 * math.pi) - 0.5 * math.log(4.0 * 0.25))


def numpy_lloyd(x, centers, rounds):
    c = np.array(centers, float)
    for _ in range(rounds):
        at = ((x[:, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[at == k].mean(axis=0) if (at == k).any() else c[k] for k in range(len(c))])
    return c


def test_lloyd_rounds(spark, rows):
    x = np.array([[r.a, r.b, r.c] for r in rows.collect()])
    first = [[0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [99.0, 99.0, 99.0]]                  # the last one never gets a row
    path = scratch_path(spark, "lloyd-test")
    assert np.allclose(dt.lloyd(rows, list("abc"), first, 3, path=path), numpy_lloyd(x, first, 3))
    done = dt.lloyd(rows, list("abc"), first, 100, path=path)                       # goes on after round 3
    assert np.allclose(done, numpy_lloyd(x, first, 100)) and done[2] == first[2]
    again = dt.lloyd(rows.filter("false"), list("abc"), first, 100, path=path)      # finds centres at rest: reads no row
    assert again == done
    assert spark.read.parquet(f"{path}/round=3").agg(F.sum("rows")).first()[0] == 600


def test_lloyd_without_rows(spark, rows):
    assert dt.lloyd(rows.limit(0), list("abc"), [[0.0] * 3, [1.0] * 3]) == [[0.0] * 3, [1.0] * 3]


def test_nearest_centre_ties_and_nulls(spark):
    df = spark.createDataFrame([(0.5,), (0.0,), (None,)], "v double")
    out = dt.nearest_center(df, [F.col("v")], [[0.0], [1.0], [0.0]]).collect()
    assert [(r.cluster, r.distance) for r in out] == [(0, 0.5), (0, 0.0), (None, None)]


def test_metrics_agree_with_the_evaluator(spark, rows):
    model = RandomForestClassifier(numTrees=3, maxDepth=2, seed=1).fit(rows)
    scored = materialize(model.transform(rows).select("label", "prediction"), "scored")
    mine = rp.classification_metrics(scored, "label", "prediction").first()
    for name, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        assert mine[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(scored), abs=1e-12)


def test_consensus_runs_on_one_frame(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ml.consensus_vote(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert len(joins) == 1 and "BroadcastHashJoin" in joins[0]                       # the join brings a few statistics
    assert plan.count("FileScan parquet") <= 5 and "Exchange hashpartitioning" not in plan


def test_methods_can_be_left_out(spark):
    x = materialize(ml.scored_frame(spark, SF_SMALL), "frame")
    three, two = ml.voted(x), ml.voted(x, ("zscore", "gmm"), min_votes=1)
    assert three.filter("votes <> anomaly_zscore + anomaly_kmeans + anomaly_gmm").count() == 0
    assert two.filter("(anomaly_zscore + anomaly_gmm >= 1) <> (final_label = 'ANOMALY')").count() == 0
