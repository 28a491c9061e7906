"""Model-based detectors: k-means distance, random forest, Gaussian mixture.

Fitting uses Spark MLlib (distributed iterations over cached partitions).
Scoring is native column expressions — the reference's two Python UDFs
(distance to centroid, max posterior) become sums over plain columns — so it
runs inside whole-stage codegen, in batch and in streams. Thresholds (mu + k*sigma, a quantile) are whole-table
aggregates attached as scalar subqueries: evaluated once, no cross join,
nothing pulled through the driver.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.functions.numeric import hash_bucket
from barwatch.operators.stats import QUANTILE_ACCURACY
from barwatch.session import materialize, path_exists, scratch_path

SEED = 42


# --- K1: assemble + standardise -------------------------------------------------

def assemble_scale(df: DataFrame, features: list[str], out: str = "features"):
    """VectorAssembler + StandardScaler(withMean, withStd) fitted as one
    Pipeline; returns (model, transformed)."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=f"{out}_raw"),
                            StandardScaler(inputCol=f"{out}_raw", outputCol=out, withMean=True, withStd=True)])
    model = pipe.fit(df)
    return model, model.transform(df)


def scale_columns(df: DataFrame, features: list[str], prefix: str = "_z", over: DataFrame | None = None) -> DataFrame:
    """Native standardisation: columns ``<prefix>0``, ``<prefix>1``, ... hold (x - mean) / std
    with the whole-table mean and sample std (of ``over``, if given) from one scalar subquery."""
    # One scalar subquery returning a struct of every statistic: a single
    # aggregation pass, reused by each field reference.
    stats = (over or df).agg(F.struct(*[F.avg(f).alias(f"m_{f}") for f in features],
                            *[F.stddev_samp(f).alias(f"s_{f}") for f in features]).alias("s")).scalar()
    return df.withColumn("_st", stats).withColumns({
        f"{prefix}{i}": F.try_divide(F.col(f) - F.col(f"_st.m_{f}"), F.col(f"_st.s_{f}")) for i, f in enumerate(features)}).drop("_st")


def scaled_names(features: list[str], prefix: str = "_z") -> list[str]:
    return [f"{prefix}{i}" for i in range(len(features))]


def vector_array(col: str) -> Column:
    return vector_to_array(F.col(col))


# --- J1 / K2: k-means -----------------------------------------------------------

def _sum(terms: list[Column]) -> Column:
    return functools.reduce(operator.add, terms, F.lit(0.0))


def _sq_dist(x: list[Column], center: list[float]) -> Column:
    diffs = [a - F.lit(float(c)) for a, c in zip(x, center)]
    return _sum([d * d for d in diffs])


def nearest_center(df: DataFrame, x: list[Column], centers: list[list[float]],
                   cluster: str = "cluster", distance: str = "distance") -> DataFrame:
    """Cluster = index of the nearest centre (lowest index on ties) and the
    Euclidean distance to it. Sums over plain columns, no UDF, no join; each
    squared distance is computed once and lands in a column."""
    names = [f"_d{i}" for i in range(len(centers))]
    df = df.withColumns({n: _sq_dist(x, c) for n, c in zip(names, centers)})
    best = F.least(*names) if len(names) > 1 else F.col(names[0])
    df = df.withColumn("_best", best)
    idx = F.lit(len(names) - 1)
    for i in reversed(range(len(names) - 1)):
        idx = F.when(F.col(names[i]) == F.col("_best"), F.lit(i)).otherwise(idx)
    return df.withColumn(cluster, F.when(F.col("_best").isNotNull(), idx).cast("int")) \
             .withColumn(distance, F.sqrt("_best")).drop("_best", *names)


def distance_to_own_center(x: list[Column], cluster: Column, centers: list[list[float]]) -> Column:
    """J1 given a predicted cluster id (C4: centre looked up by id)."""
    expr = None
    for i, c in enumerate(centers):
        d = F.sqrt(_sq_dist(x, c))
        expr = F.when(cluster == i, d) if expr is None else expr.when(cluster == i, d)
    return expr


def vector_columns(col: str, size: int) -> list[Column]:
    arr = vector_array(col)
    return [arr[i] for i in range(size)]


# Lloyd's rounds. MLlib draws its first centres from a sample and its sums
# depend on partitions; from given centres the rounds are plain aggregations.

def lloyd(x: DataFrame, cols: list[str], centers: list[list[float]], max_rounds: int = 20, rest: float = 1e-12,
          path: str | None = None) -> list[list[float]]:
    """K2 fit: centres after Lloyd's rounds from given ones.

    A round is one pass: nearest centre, then the mean of each cluster with partial
    sums in every task; k rows come back. A cluster without rows keeps its centre.
    Rounds end when no coordinate moves by more than ``rest``, or at ``max_rounds``.
    Each round's centres are written (``path``/round=i: cluster, coordinates, rows),
    and a run that finds rounds there goes on after the last. ``x`` should be a
    written table: it is read once a round."""
    spark = x.sparkSession
    path = path or scratch_path(spark, "lloyd")
    names = [f"c{i}" for i in range(len(cols))]
    done = 0
    for done in range(max_rounds, 0, -1):
        if path_exists(spark, f"{path}/round={done}/_SUCCESS"):
            found = spark.read.parquet(f"{path}/round={done}").collect()                    # k rows
            centers = [[r[n] for n in names] for r in sorted(found, key=lambda r: r["cluster"])]
            if all(r["moved"] <= rest for r in found):
                return centers
            break
    else:
        done = 0
    for i in range(done + 1, max_rounds + 1):
        got = (nearest_center(x.select(*cols), [F.col(c) for c in cols], centers).filter("cluster IS NOT NULL")
               .groupBy("cluster").agg(*[F.avg(c).alias(n) for c, n in zip(cols, names)], F.count(F.lit(1)).alias("rows")).collect())
        by = {r["cluster"]: r for r in got}                                                 # k rows
        new = [[by[k][n] for n in names] if k in by else list(c) for k, c in enumerate(centers)]
        moved = [max(abs(a - b) for a, b in zip(u, v)) for u, v in zip(new, centers)]
        spark.createDataFrame([(k, *map(float, c), int(by[k]["rows"]) if k in by else 0, float(m))
                               for k, (c, m) in enumerate(zip(new, moved))],
                              "cluster int, " + ", ".join(f"{n} double" for n in names) + ", rows long, moved double") \
             .coalesce(1).write.mode("overwrite").parquet(f"{path}/round={i}")
        centers = new
        if max(moved) <= rest:
            break
    return centers


def lloyd_sql(rows: str, x: list[str], centers: list[list[float]], rounds: int, name: str = "lc") -> str:
    """:func:`lloyd` over the CTE ``rows`` as one CTE a round; the last, ``<name><rounds>``, holds one row with k0_0, k0_1, ..."""
    ks, n = range(len(centers)), range(len(x))
    at = lambda k, i: f"k{k}_{i}"
    first = ", ".join(f"{float(c)!r} AS {at(k, i)}" for k, row in enumerate(centers) for i, c in enumerate(row))
    d, idx, _ = nearest_sql(x, len(centers))
    mean = ", ".join(f"coalesce(avg({x[i]}) FILTER (WHERE {idx} = {k}), any_value({at(k, i)})) AS {at(k, i)}" for k in ks for i in n)
    return ",\n".join([f"{name}0 AS MATERIALIZED (SELECT {first})"] + [
        f"{name}{r} AS MATERIALIZED (SELECT {mean} FROM (SELECT *, {d} FROM {rows}, {name}{r - 1}) x)" for r in range(1, rounds + 1)])


def nearest_sql(x: list[str], k: int) -> tuple[str, str, str]:
    """Squared distances d0, d1, ... to centres k0_0, ...; the nearest one's index; its squared distance."""
    d = ", ".join("0.0 + " + " + ".join(f"({c} - k{j}_{i}) * ({c} - k{j}_{i})" for i, c in enumerate(x)) + f" AS d{j}" for j in range(k))
    best = "least(" + ", ".join(f"d{j}" for j in range(k)) + ")"
    return d, "CASE " + " ".join(f"WHEN d{j} = {best} THEN {j}" for j in range(k)) + " END", best


def kmeans_fit(scaled: DataFrame, k: int = 3, seed: int = SEED, features_col: str = "features"):
    return KMeans(k=k, seed=seed, featuresCol=features_col, predictionCol="cluster").fit(scaled)


def flag_by_mean_k_std(df: DataFrame, score: str, k: float = 2.0, flag: str = "anomaly_kmeans",
                       above: bool = True, over: DataFrame | None = None) -> DataFrame:
    """D7 applied: flag = score > mu + k*sigma of the whole table (scalar subquery).
    ``over`` is the same scores in a frame that is cheaper to read, if there is one."""
    th = (over or df).agg((F.avg(score) + F.lit(k) * F.stddev_samp(score)).alias("t")).select("t").scalar()
    cond = F.col(score) > th if above else F.col(score) < th
    return df.withColumn(f"{flag}_threshold", th).withColumn(flag, F.when(cond, 1).otherwise(0))


def kmeans_detect(features_df: DataFrame, features: list[str], k: int = 3, n_sigma: float = 2.0,
                  seed: int = SEED, scaled: DataFrame | None = None):
    """K2: scale, fit k-means, distance to own centroid, flag > mu + 2 sigma.

    Returns (centers, scored). Pass ``scaled`` (persisted output of
    :func:`assemble_scale`) to share one standardisation between models."""
    if scaled is None:
        _, scaled = assemble_scale(features_df, features)
        scaled = materialize(scaled, "scaled")      # k-means iterates over its input
    model = kmeans_fit(scaled, k, seed)
    centers = [list(map(float, c)) for c in model.clusterCenters()]
    x = model.transform(scaled)
    x = x.withColumn("distance", distance_to_own_center(vector_columns("features", len(features)),
                                                           F.col("cluster"), centers))
    return centers, flag_by_mean_k_std(x, "distance", n_sigma, "anomaly_kmeans")


def kmeans_score_pinned(features_df: DataFrame, features: list[str], centers: list[list[float]],
                        n_sigma: float = 2.0, over: DataFrame | None = None) -> DataFrame:
    """K2 scoring with given centres (K10 shape): native scaling, nearest
    centre, distance, mu + 2 sigma flag.

    Adds columns to ``features_df``, so detectors chain on one frame; ``over`` is
    the feature table itself, from which the threshold is then taken. Scaled
    columns ``_z0``... stay for the next detector if they are there already."""
    names = scaled_names(features)
    own = not set(names) <= set(features_df.columns)
    def scored(f: DataFrame) -> DataFrame:
        f = f if set(names) <= set(f.columns) else scale_columns(f, features)
        return nearest_center(f, [F.col(n) for n in names], centers)
    x = flag_by_mean_k_std(scored(features_df), "distance", n_sigma, "anomaly_kmeans", over=scored(over) if over is not None else None)
    return x.drop(*names) if own else x


# --- K3: deterministic split ------------------------------------------------------

def hash_split(df: DataFrame, key: list[str], train_pct: int = 80) -> DataFrame:
    """``split`` = 'train' for md5-bucket < train_pct else 'test' — the same
    rows whatever the partitioning (unlike ``randomSplit``)."""
    return df.withColumn("split", F.when(hash_bucket(key) < train_pct, "train").otherwise("test"))


# --- K4 / K5: random forest -------------------------------------------------------

def rf_fit(train: DataFrame, trees: int = 100, depth: int = 5, seed: int = SEED,
           features_col: str = "features", label_col: str = "label"):
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol=features_col,
                                  labelCol=label_col, predictionCol="prediction").fit(train)


def rf_importance(model, features: list[str], spark) -> DataFrame:
    """Importances as a small DataFrame, highest first."""
    imp = [float(v) for v in model.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(features, imp)), "feature string, importance double") \
                .orderBy(F.col("importance").desc(), "feature")


# --- K6 / J2: Gaussian mixture ----------------------------------------------------

def gmm_fit(scaled: DataFrame, k: int = 3, seed: int = SEED, features_col: str = "features"):
    return GaussianMixture(k=k, seed=seed, featuresCol=features_col, predictionCol="cluster",
                           probabilityCol="probability").fit(scaled)


def max_probability(prob_col: str = "probability") -> Column:
    """Largest posterior — ``array_max`` over the vector, no UDF."""
    return F.array_max(vector_array(prob_col))


def flag_below_quantile(df: DataFrame, score: str, q: float = 0.10, flag: str = "anomaly_gmm",
                        accuracy: int = QUANTILE_ACCURACY, over: DataFrame | None = None) -> DataFrame:
    """D8 applied: flag = score < q-quantile of the whole table (strict)."""
    th = (over or df).agg(F.percentile_approx(score, q, accuracy).alias("t")).select("t").scalar()
    return df.withColumn(f"{flag}_threshold", th).withColumn(flag, F.when(F.col(score) < th, 1).otherwise(0))


def mixture_terms(weights: list[float], means: list[list[float]], covariances: list) -> list[tuple]:
    """Per component (constant, mean, inverse Cholesky factor): the log density of x is
    constant - |factor (x - mean)|^2 / 2, the constant including the weight."""
    terms = []
    for w, mu, cov in zip(weights, means, covariances):
        lower = np.linalg.cholesky(np.asarray(cov, float))
        const = math.log(w) - float(np.log(np.diag(lower)).sum()) - 0.5 * len(mu) * math.log(2 * math.pi)
        terms.append((const, [float(m) for m in mu], np.linalg.inv(lower).tolist()))
    return terms


def _whitened(x: list[Column], mean: list[float], factor: list[list[float]]) -> Column:
    """|factor (x - mean)|^2 for a lower triangular factor, as sums over plain columns."""
    diffs = [a - F.lit(m) for a, m in zip(x, mean)]
    rows = [_sum([diffs[j] * F.lit(row[j]) for j in range(i + 1) if row[j]]) for i, row in enumerate(factor)]
    return _sum([r * r for r in rows])


def gmm_posterior(df: DataFrame, x: list[Column], weights, means, covariances, floor: float = 0.0,
                  probability: str = "probability") -> DataFrame:
    """Posterior of a full-covariance mixture as an array column.

    The covariance enters as its Cholesky factor, written as literals. ``floor`` is
    added to every weighted density before normalising, as MLlib does with
    ``MLLIB_FLOOR``: a row that is far from all components then gets equal shares.
    With floor 0 the largest term is taken out first, so nothing underflows."""
    names = [f"_l{k}" for k in range(len(weights))]
    df = df.withColumns({n: F.lit(c) - F.lit(0.5) * _whitened(x, mu, f)
                         for n, (c, mu, f) in zip(names, mixture_terms(weights, means, covariances))})
    if floor:
        shares = [F.exp(n) + F.lit(floor) for n in names]
    else:
        df = df.withColumn("_top", F.greatest(*names) if len(names) > 1 else F.col(names[0]))
        shares = [F.exp(F.col(n) - F.col("_top")) for n in names]
    df = df.withColumns({n: e for n, e in zip(names, shares)})
    total = functools.reduce(operator.add, [F.col(n) for n in names])
    return df.withColumn(probability, F.array(*[F.col(n) / total for n in names])).drop("_top", *names)


def mixture_sql(x: list[str], weights, means, covariances, floor: float = 0.0) -> tuple[list[str], list[str]]:
    """:func:`gmm_posterior` in SQL: log densities l0, l1, ... over ``x``, and from them the unnormalised shares."""
    logs = []
    for const, mu, factor in mixture_terms(weights, means, covariances):
        rows = ["(0.0 + " + " + ".join(f"({x[j]} - {mu[j]!r}) * {row[j]!r}" for j in range(i + 1) if row[j]) + ")" for i, row in enumerate(factor)]
        logs.append(f"{const!r} - 0.5 * (0.0 + {' + '.join(f'{r} * {r}' for r in rows)})")
    n = range(len(logs))
    top = f"greatest({', '.join(f'l{k}' for k in n)})"
    return logs, [f"exp(l{k}) + {floor!r}" if floor else f"exp(l{k} - {top})" for k in n]


# Fixed value: the smallest double e with 1 + e > 1, MLlib's floor under densities.
MLLIB_FLOOR = 2.220446049250313e-16


def gmm_score_pinned(features_df: DataFrame, features: list[str], weights, means, covariances,
                     q: float = 0.10, floor: float = 0.0, over: DataFrame | None = None, cluster: str = "cluster") -> DataFrame:
    """K6 scoring with a given mixture: max posterior below its ``q`` quantile.
    ``over`` and the scaled columns as in :func:`kmeans_score_pinned`."""
    names = scaled_names(features)
    own = not set(names) <= set(features_df.columns)
    def scored(f: DataFrame) -> DataFrame:
        f = f if set(names) <= set(f.columns) else scale_columns(f, features)
        f = gmm_posterior(f, [F.col(n) for n in names], weights, means, covariances, floor)
        return f.withColumn("max_probability", F.array_max("probability"))
    x = scored(features_df)
    x = x.withColumn(cluster, F.array_position("probability", F.col("max_probability")).cast("int") - 1)
    x = flag_below_quantile(x, "max_probability", q, "anomaly_gmm", over=scored(over) if over is not None else None)
    return x.drop(*names) if own else x


def gmm_detect(features_df: DataFrame, features: list[str], k: int = 3, q: float = 0.10, seed: int = SEED,
               scaled: DataFrame | None = None):
    """K6: scale, fit GMM, max posterior, flag below its 10th percentile."""
    if scaled is None:
        _, scaled = assemble_scale(features_df, features)
        scaled = materialize(scaled, "scaled")      # EM iterates over its input
    model = gmm_fit(scaled, k, seed)
    x = model.transform(scaled).withColumn("max_probability", max_probability())
    return model, flag_below_quantile(x, "max_probability", q, "anomaly_gmm")
