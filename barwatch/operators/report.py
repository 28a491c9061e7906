"""Reports over detector outputs: rates, counts, profiles, top-k, latest.

Everything is an aggregation with partial (map-side) aggregation or a
bounded top-k: ``orderBy().limit(k)`` plans as TakeOrderedAndProject (each
task keeps k rows), and ``row_number() <= k`` per group plans a
WindowGroupLimit before the shuffle, so a hot group never ships more than
k rows per input task. Quartiles are exact, from range-sorted value counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwatch.operators.joins import keyed_join
from barwatch.session import materialize


def anomaly_rate(df: DataFrame, flag: str, by: list[str] = ("symbol",)) -> DataFrame:
    """total, anomalies, normal, percent."""
    by = list(by)
    aggs = [F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag) == 1).alias("anomalies")]
    base = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return (base.withColumn("normal", F.col("total") - F.col("anomalies"))
                .withColumn("percent", F.col("anomalies") * 100.0 / F.col("total")))


def group_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count per value (D3), ordered by the value."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count")).orderBy(*cols)


def exact_quantiles(df: DataFrame, cols: list[str], by: list[str], probabilities: list[float]) -> DataFrame:
    """(by..., column, q): exact, linearly interpolated quantiles of each column
    per group, NULLs left out.

    Values are counted (equal values meet once per task), range-sorted by
    (group, column, value) and written, so a large group spreads over many
    partitions. Counts per (group, column, partition) give every partition its
    first rank; only rows on a wanted rank go on. No buffer holds a group."""
    by = list(by)
    parts = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = df.selectExpr(*[f"`{b}`" for b in by], f"stack({len(cols)}, {parts}) AS (`column`, value)").filter("value IS NOT NULL")
    keys = [*by, "column"]
    counted = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("k"))
    ranged = materialize(counted.repartitionByRange(*keys, "value").withColumn("_p", F.spark_partition_id()), "value-counts")
    per_part = ranged.groupBy(*keys, "_p").agg(F.sum("k").alias("_in"))
    whole = Window.partitionBy(*keys)
    first = per_part.withColumn("_before", F.sum("_in").over(whole.orderBy("_p")) - F.col("_in")) \
                    .withColumn("_n", F.sum("_in").over(whole)).drop("_in")
    x = keyed_join(ranged, materialize(first, "first-ranks"), [*keys, "_p"])
    upto = F.sum("k").over(Window.partitionBy(*keys, "_p").orderBy("value"))
    x = x.withColumn("_to", F.col("_before") + upto).withColumn("_from", F.col("_to") - F.col("k"))
    places = [(F.lit(p) * (F.col("_n") - 1)) for p in probabilities]
    holds = lambda r: (F.col("_from") <= r) & (r < F.col("_to"))
    aggs = []
    for i, place in enumerate(places):
        lo = F.floor(place)
        aggs += [F.max(F.when(holds(lo), F.col("value"))).alias(f"_lo{i}"),
                 F.max(F.when(holds(F.ceil(place)), F.col("value"))).alias(f"_hi{i}"), F.max(place - lo).alias(f"_w{i}")]
    out = x.groupBy(*keys).agg(*aggs)
    return out.select(*keys, F.array(*[F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_w{i}")
                                       for i in range(len(places))]).alias("q"))


def describe(df: DataFrame, cols: list[str], by: list[str] = ("symbol",)) -> DataFrame:
    """count, mean, std, min, 25/50/75 %, max per column (D4), long format.

    One aggregation for the moments of all columns; the quartiles are exact and
    interpolated (:func:`exact_quantiles`)."""
    by = list(by)
    df = materialize(df.select(*by, *cols), "describe")
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"),
                 F.stddev_samp(c).alias(f"{c}__std"), F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    parts = ", ".join(f"'{c}', CAST(`{c}__count` AS BIGINT), `{c}__mean`, `{c}__std`, `{c}__min`, `{c}__max`" for c in cols)
    moments = wide.selectExpr(*[f"`{b}`" for b in by],
                              f"stack({len(cols)}, {parts}) AS (`column`, `count`, mean, std, `min`, `max`)")
    x = keyed_join(moments, exact_quantiles(df, cols, by, [0.25, 0.5, 0.75]), [*by, "column"], "left")
    return x.select(*by, "column", "count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
                    F.col("q")[2].alias("p75"), "max")


def range_summary(bars: DataFrame, by: list[str] = ("symbol",), ts: str = "bar_ts") -> DataFrame:
    """rows, first/last time, day span, lowest low, highest high, avg volume."""
    return (bars.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"),
                                  F.max(ts).alias("last_ts"), F.min("low").alias("low"),
                                  F.max("high").alias("high"), F.avg("volume").alias("avg_volume"))
                .withColumn("days", F.datediff(F.col("last_ts"), F.col("first_ts"))))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULLs per column and in total (D6), one row."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols]
    total = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    return df.agg(*aggs, total.alias("total_nulls"))


def extreme_ratio(df: DataFrame, col: str, by: list[str] = ("symbol",)) -> DataFrame:
    """max/mean and (max - mean)/std of a column."""
    base = df.groupBy(*by).agg(F.max(col).alias("max"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))
    return (base.withColumn("max_over_mean", F.try_divide(F.col("max"), F.col("mean")))
                .withColumn("max_sigmas", F.try_divide(F.col("max") - F.col("mean"), F.col("std"))))


def latest_per_group(df: DataFrame, cols: list[str], by: list[str] = ("symbol",), ts: str = "bar_ts") -> DataFrame:
    """Last value of each column by time per group (D12); one ``max_by`` per
    column keeps the aggregation hash-based."""
    return df.groupBy(*by).agg(F.max(ts).alias(ts), *[F.max_by(c, ts).alias(c) for c in cols])


def histogram(df: DataFrame, col: str, bins: int = 50, by: list[str] = ("symbol",)) -> DataFrame:
    """Equal-width bins over [min, max] per group, last edge inclusive."""
    by = list(by)
    rng = df.groupBy(*by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = keyed_join(df.filter(F.col(col).isNotNull()), materialize(rng, "ranges"), by)
    width = F.col("_hi") - F.col("_lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - F.col("_lo")) / width * bins), F.lit(bins - 1))).cast("int")
    out = x.withColumn("bin", b).groupBy(*by, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    return (out.withColumn("bin_start", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins)
               .withColumn("bin_end", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / bins)
               .drop("_lo", "_hi"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, weighted precision / recall / F1 (D14), with the multiclass
    evaluator's definitions, from a confusion matrix of (classes^2) rows."""
    cm = df.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")) \
           .agg(F.count(F.lit(1)).alias("n"))
    per_label = cm.groupBy(F.col("l").alias("c")).agg(F.sum("n").alias("n_label"),
                                                       F.sum(F.when(F.col("l") == F.col("p"), F.col("n"))).alias("tp"))
    per_pred = cm.groupBy(F.col("p").alias("c")).agg(F.sum("n").alias("n_pred"))
    x = keyed_join(per_label, per_pred, ["c"], "left").fillna(0, ["tp", "n_pred"])
    total = F.sum("n_label")
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    rec = F.try_divide(F.col("tp"), F.col("n_label"))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return x.agg((F.sum("tp") / total).alias("accuracy"),
                 (F.sum(F.col("n_label") * prec) / total).alias("weighted_precision"),
                 (F.sum(F.col("n_label") * rec) / total).alias("weighted_recall"),
                 (F.sum(F.col("n_label") * f1) / total).alias("f1"))


def table_profile(df: DataFrame) -> DataFrame:
    """Shape and per-column non-NULL counts (D15), one row per column."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_nn_{i}")
                                                     for i, c in enumerate(cols)])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    parts = ", ".join(f"'{c}', {i + 1}, '{types[c]}', `_nn_{i}`" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, position, data_type, non_null)",
                          "_rows AS n_rows", f"{len(cols)} AS n_cols")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k (F2, F4, F6, F8): TakeOrderedAndProject, bounded per task."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, by: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Top-k per group (F7): ``row_number() <= k`` — Spark inserts a partial
    WindowGroupLimit before the shuffle, so each task sends <= k rows/group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def dedupe_first(df: DataFrame, key: list, order: list[Column]) -> DataFrame:
    """Keep the first row per key by ``order`` (D10); groups are duplicates
    of one key, so they stay tiny."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
