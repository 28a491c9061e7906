"""Fitted statistics: per-series mean/std, score thresholds, quantiles.

All of them are aggregations with map-side partial aggregation (avg and
stddev keep a fixed-size buffer), so a hot series is reduced inside every
input task before the shuffle. Results go back to the rows either by an
equi-join on the series key (per-symbol statistics; AQE broadcasts the
small side after measuring it) or, for statistics over the whole table, as
a scalar subquery that Spark evaluates once — never a cross join, never a
whole-table window, never a value pulled through a driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.operators.joins import keyed_join
from barwatch.session import materialize

# Bounded-memory quantile sketch size: relative rank error 1/accuracy. The
# sketch returns an exact order statistic whenever the column has fewer
# values than this, which is how the small-scale oracle checks it.
QUANTILE_ACCURACY = 100_000


def fit_stats(df: DataFrame, features: list[str], by: list[str] = ("symbol",)) -> DataFrame:
    """One pass: ``mean_<f>``, ``std_<f>`` (sample) and ``n`` per group."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"mean_{f}"), F.stddev_samp(f).alias(f"std_{f}")]
    aggs.append(F.count(F.lit(1)).alias("n"))
    by = list(by)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def stats_long(wide: DataFrame, features: list[str], by: list[str] = ("symbol",)) -> DataFrame:
    """Unpivot ``fit_stats`` output to (by..., feature, mean, std)."""
    by = list(by)
    parts = ", ".join(f"'{f}', `mean_{f}`, `std_{f}`" for f in features)
    return wide.selectExpr(*[f"`{b}`" for b in by],
                           f"stack({len(features)}, {parts}) AS (feature, mean, std)")


def small(stats: DataFrame) -> DataFrame:
    """Statistics (one row per series) as a written table. Spark sizes an
    aggregate by its input, so a join with the plain aggregate shuffles the big
    side onto a handful of keys; the size of a written table is known when the
    join is planned, and below the broadcast threshold (only there) the big side
    stays where it is."""
    return materialize(stats, "stats")


def attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Bring statistics to every row: equi-join on ``by``, or scalar
    subqueries when the statistics are global (``by`` empty)."""
    by = list(by)
    if by:
        return keyed_join(df, small(stats), by, "left")
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()   # one subquery, reused
    out = df.withColumn("_st", row)
    for c in stats.columns:
        out = out.withColumn(c, F.col(f"_st.{c}"))
    return out.drop("_st")


def threshold_mean_k_std(df: DataFrame, score: str, k: float = 2.0, by: list[str] = ()) -> DataFrame:
    """μ + k·σ of ``score`` (per group, or one row) with μ and σ."""
    by = list(by)
    aggs = [F.avg(score).alias("score_mean"), F.stddev_samp(score).alias("score_std")]
    base = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return base.withColumn("threshold", F.col("score_mean") + F.lit(k) * F.col("score_std"))


def threshold_quantile(df: DataFrame, score: str, q: float = 0.10, by: list[str] = (),
                       accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """q-quantile of ``score`` with a bounded sketch (``percentile_approx``).

    Exact order statistic (smallest v with at least q of the values <= v)
    below ``accuracy`` values; rank error <= n/accuracy above.
    """
    by = list(by)
    agg = F.percentile_approx(score, q, accuracy).alias("threshold")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def sigma_bands(df: DataFrame, col: str, by: list[str] = ("symbol",), k: float = 3.0) -> DataFrame:
    """mean, mean - kσ, mean + kσ of ``col`` per group."""
    by = list(by)
    base = df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    return (base.withColumn("lower", F.col("mean") - F.lit(k) * F.col("std"))
                .withColumn("upper", F.col("mean") + F.lit(k) * F.col("std")))


def self_zscore(df: DataFrame, col: str, by: list[str] = ("symbol",), threshold: float = 3.0) -> DataFrame:
    """z of ``col`` against its own group's mean/std and a |z| > t flag."""
    by = list(by)
    st = df.groupBy(*by).agg(F.avg(col).alias("_mu"), F.stddev_samp(col).alias("_sd"))
    x = attach(df, st, by)
    z = F.try_divide(F.col(col) - F.col("_mu"), F.col("_sd"))
    return (x.withColumn(f"{col}_zscore", z)
             .withColumn("is_anomaly", F.when(F.abs(z) > threshold, 1).otherwise(0))
             .drop("_mu", "_sd"))
