"""Models and parameters that a batch job publishes and a stream scores with.

What is published lies in versions (``sources.store``): a version is whole or
absent, and a stream that asks for the newest at every micro-batch picks up a
new one without a restart.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.operators.detectors import lloyd, nearest_center
from barwatch.operators.joins import keyed_join
from barwatch.operators.scoring import with_params_table, zscore_columns
from barwatch.operators.stats import fit_stats, threshold_mean_k_std
from barwatch.session import materialize
from barwatch.sources import store

SERIES = ["symbol", "interval"]


# --- K9 / K10: fitted pipelines ------------------------------------------------------

def save_pipeline(spark: SparkSession, model: PipelineModel, root: str) -> int:
    """Publish a fitted pipeline as the next version."""
    return store.publish(spark, root, lambda path: model.write().save(path))


def load_pipeline(spark: SparkSession, root: str, version: int | None = None) -> PipelineModel:
    path = store.published(spark, root, version)
    if path is None:
        raise FileNotFoundError(f"no model is published at {root}")
    return PipelineModel.load(path)


# --- C3: parameters ------------------------------------------------------------------

def publish_params(params_long: DataFrame, root: str) -> int:
    """Publish (symbol, interval, feature, mean, std) rows; a row without symbol and
    interval holds for every series that has none of its own."""
    return store.publish(params_long.sparkSession, root, lambda path: params_long.write.parquet(path))


def zscored(batch: DataFrame, root: str, features: list[str], keys=("symbol",)) -> DataFrame:
    """z-scores of a batch by the parameters published now. Every row stays; a series
    without parameters and without a default gets NULL scores."""
    path = store.published(batch.sparkSession, root)
    if path is None:
        raise FileNotFoundError(f"no parameters are published at {root}")
    x = with_params_table(batch, batch.sparkSession.read.parquet(path), features, keys=keys)
    return zscore_columns(x, features).drop(*[f"{s}_{f}" for f in features for s in ("mean", "std")])


# --- K9 / K10: distance to centres ---------------------------------------------------

def _scaled(df: DataFrame, features: list[str]) -> DataFrame:
    return df.withColumns({f"_z{i}": F.try_divide(F.col(f) - F.col(f"mean_{f}"), F.col(f"std_{f}")) for i, f in enumerate(features)})


def _names(features: list[str]) -> list[str]:
    return [f"_z{i}" for i in range(len(features))]


def fit_centers(rows: DataFrame, features: list[str], first: list[list[float]], max_rounds: int = 20):
    """(statistics over all rows, centres): standardise by the whole table, then Lloyd's rounds."""
    whole = fit_stats(rows, features, by=[]).drop("n")
    stats = materialize(whole, "centre-stats")
    z = _scaled(rows.withColumn("_s", stats.select(F.struct(*stats.columns)).scalar()).select("*", "_s.*"), features)
    return stats, lloyd(materialize(z.select(*_names(features)), "centre-rows"), _names(features), first, max_rounds)


def publish_centers(rows: DataFrame, root: str, features: list[str], first: list[list[float]], n_sigma: float = 2.0,
                    only: DataFrame | None = None) -> int:
    """K9: fit and publish what :func:`distance_scored` needs: centres, and for every
    series (of ``only``, if given) its mean and std and the mean + ``n_sigma`` std of
    its distances; a row without symbol and interval has those of all rows."""
    spark = rows.sparkSession
    stats, centers = fit_centers(rows, features, first)
    names = [f"c{i}" for i in range(len(features))]

    def limits(own: DataFrame, by: list[str]) -> DataFrame:
        z = nearest_center(_scaled(own, features), [F.col(n) for n in _names(features)], centers)
        return threshold_mean_k_std(z, "distance", n_sigma, by=by).select(*by, "threshold")

    chosen = rows if only is None else keyed_join(rows, only, SERIES, "left_semi")
    by_series = materialize(fit_stats(chosen, features, by=SERIES).drop("n"), "series-stats")
    of_series = keyed_join(by_series, limits(keyed_join(chosen, by_series, SERIES), SERIES), SERIES)
    whole = rows.withColumn("_s", stats.select(F.struct(*stats.columns)).scalar()).select("*", "_s.*")
    default = stats.withColumn("threshold", limits(whole, []).scalar()).select(
        F.lit(None).cast("string").alias("symbol"), F.lit(None).cast("string").alias("interval"), "*")

    def write(path: str) -> None:
        of_series.unionByName(default).write.parquet(f"{path}/series")
        spark.createDataFrame([(k, *map(float, c)) for k, c in enumerate(centers)],
                              "cluster int, " + ", ".join(f"{n} double" for n in names)).coalesce(1).write.parquet(f"{path}/centers")
    return store.publish(spark, root, write)


def distance_scored(batch: DataFrame, root: str, features: list[str]) -> DataFrame:
    """Cluster, distance and flag of every row by the centres published now. A
    series that was not published takes the default row; no row is lost."""
    spark = batch.sparkSession
    path = store.published(spark, root)
    if path is None:
        raise FileNotFoundError(f"no centres are published at {root}")
    found = sorted(spark.read.parquet(f"{path}/centers").collect(), key=lambda r: r["cluster"])       # k rows
    centers = [[r[f"c{i}"] for i in range(len(features))] for r in found]
    series = spark.read.parquet(f"{path}/series")
    values = [c for c in series.columns if c not in SERIES]
    unnamed = F.col("symbol").isNull() & F.col("interval").isNull()
    default = series.filter(unnamed).agg(F.struct(*[F.max(c).alias(c) for c in values])).scalar()     # one row
    x = keyed_join(batch, series.filter(~unnamed), SERIES, "left").withColumn("_dflt", default)
    x = x.withColumns({c: F.coalesce(F.col(c), F.col(f"_dflt.{c}")) for c in values}).drop("_dflt")
    x = nearest_center(_scaled(x, features), [F.col(n) for n in _names(features)], centers)
    x = x.withColumn("anomaly_kmeans", F.when(F.col("distance") > F.col("threshold"), 1).otherwise(0))
    return x.drop(*values, *_names(features))
