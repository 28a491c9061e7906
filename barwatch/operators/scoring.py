"""Z-score scoring with fitted or supplied parameters (batch and stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.functions import flags as fl
from barwatch.operators import stats as st
from barwatch.operators.joins import keyed_join

DEFAULT_Z_THRESHOLD = 3.0


def zscore_columns(df: DataFrame, features: list[str]) -> DataFrame:
    """``<f>_zscore`` = (f - mean_f) / std_f; needs ``mean_<f>``/``std_<f>``
    columns (from :func:`stats.attach` or :func:`with_params`). NULL when σ
    is 0 or NULL."""
    out = df
    for f in features:
        out = out.withColumn(f"{f}_zscore", F.try_divide(F.col(f) - F.col(f"mean_{f}"), F.col(f"std_{f}")))
    return out


def zscore_detector(features_df: DataFrame, features: list[str], by: list[str] = ("symbol",),
                    threshold: float = DEFAULT_Z_THRESHOLD, min_votes: int = 1,
                    flag_name: str = "anomaly_zscore") -> DataFrame:
    """Fit mean/std per group, z per feature, flag when at least ``min_votes``
    features have |z| > threshold (1 = the batch "any feature" rule, 2 = the
    stream's 2-of-3 rule)."""
    stats = st.fit_stats(features_df, features, by).drop("n")
    x = zscore_columns(st.attach(features_df, stats, by), features)
    z_flags = [fl.flag_abs_gt(f"{f}_zscore", threshold) for f in features]
    if min_votes <= 1:
        flag = fl.any_condition([F.abs(F.col(f"{f}_zscore")) > threshold for f in features])
    else:
        flag = F.when(fl.votes(z_flags) >= min_votes, 1).otherwise(0)
    drop = [f"mean_{f}" for f in features] + [f"std_{f}" for f in features]
    return x.withColumn(flag_name, flag).drop(*drop)


def zscore_given_params(df: DataFrame, features: list[str], params) -> DataFrame:
    """``<f>_zscore`` from supplied (driver-side) mean/std literals."""
    out = df
    for f in features:
        z = F.try_divide(F.col(f) - F.lit(params.mean(f)).cast("double"), F.lit(params.std(f)).cast("double"))
        out = out.withColumn(f"{f}_zscore", z)
    return out


def with_params_table(df: DataFrame, params_long: DataFrame, features: list[str],
                      keys=("symbol", "interval")) -> DataFrame:
    """Per-(symbol, interval) statistics from a long params table; rows
    whose series has no entry use the default row (NULL symbol/interval).

    The params table is pivoted to one row per series (a few rows), then
    joined on the series key; AQE broadcasts it after measuring its size.
    The default row is a scalar subquery, so no row is ever multiplied.
    """
    keys = list(keys)
    aggs = []
    for f in features:
        aggs += [F.max(F.when(F.col("feature") == f, F.col("mean"))).alias(f"mean_{f}"),
                 F.max(F.when(F.col("feature") == f, F.col("std"))).alias(f"std_{f}")]
    is_default = F.lit(True)
    for k in keys:
        is_default = is_default & F.col(k).isNull()
    specific = params_long.filter(~is_default).groupBy(*keys).agg(*aggs)
    default = params_long.filter(is_default).agg(F.struct(*aggs).alias("d")).scalar()   # one subquery
    x = keyed_join(df, specific, keys, "left").withColumn("_dflt", default)
    for f in features:
        for s in ("mean", "std"):
            c = f"{s}_{f}"
            x = x.withColumn(c, F.coalesce(F.col(c), F.col(f"_dflt.{c}")))
    return x.drop("_dflt")


def candle_detector(df: DataFrame, params, features=("return", "log_return", "price_range"),
                    min_votes: int | None = None) -> DataFrame:
    """I5 scoring (stateless, batch or stream): z per intrabar feature with the
    given parameters, one vote per |z| > threshold, anomaly at >= min_votes."""
    features = list(features)
    k = params.min_votes if min_votes is None else min_votes
    x = zscore_given_params(df, features, params)
    for f in features:
        x = x.withColumn(f"anomaly_{f}", fl.flag_abs_gt(f"{f}_zscore", params.z_threshold))
    x = x.withColumn("candle_votes", fl.votes([f"anomaly_{f}" for f in features]))
    return x.withColumn("is_candle_anomaly", fl.min_votes("candle_votes", k))
