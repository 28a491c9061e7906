"""Sliding-window statistics and the window detector (batch and stream).

One code path: the same functions run on a static DataFrame (every
window) and on a streaming one (watermarked, emitted in append or update
mode). The aggregation is ``groupBy(window, symbol)`` — partial aggregation
per task before the shuffle, state kept per (window, symbol) and evicted by
the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.functions import flags as fl

WINDOW = "1 hour"
SLIDE = "1 minute"
WATERMARK = "10 minutes"
DECIMAL_VOLUME = 1e18            # sums of larger volumes could leave DECIMAL(38, 9)

# Window rule names, in reason order.
REASONS = [("VOLATILITY", "volatility_anomaly"), ("RANGE", "range_anomaly"), ("VOLUME", "volume_anomaly")]

WINDOW_OUT = ["window_start", "window_end", "symbol", "close", "avg_return", "std_return", "max_range",
              "avg_volume", "volatility_anomaly", "range_anomaly", "volume_anomaly", "total_votes",
              "is_anomaly", "confidence", "anomaly_reasons"]


def sliding_window_stats(candles: DataFrame, ts_col: str = "timestamp", window: str = WINDOW,
                         slide: str = SLIDE, watermark: str | None = None, digits: bool = True) -> DataFrame:
    """Per (window, symbol): avg/std return, avg/max range, avg volume,
    last close and last time. ``last`` is ``max_by(close, ts)`` —
    deterministic after the shuffle. ``digits`` rounds the statistics like
    the reference output (4 digits, volume 2)."""
    df = candles
    if watermark:
        df = df.withWatermark(ts_col, watermark)
    r4 = (lambda c: F.round(c, 4)) if digits else (lambda c: c)
    # Volumes are 2-decimal quantities, so a 2-digit round of their mean hits
    # exact ties (x.xx5); averaging in DECIMAL makes the tie exact and the
    # HALF_UP result independent of summation order.
    # Beyond the range of that type the mean is taken in doubles.
    exact = F.round(F.avg(F.col("volume").try_cast("decimal(38,9)")), 2).cast("double")
    avg_volume = (F.when(F.max(F.abs("volume")) < DECIMAL_VOLUME, exact).otherwise(F.round(F.avg("volume"), 2)) if digits
                  else F.avg("volume"))
    return (df.groupBy(F.window(F.col(ts_col), window, slide).alias("window"), F.col("symbol"))
              .agg(r4(F.avg("return")).alias("avg_return"),
                   r4(F.stddev_samp("return")).alias("std_return"),
                   r4(F.avg("price_range")).alias("avg_range"),
                   r4(F.max("price_range")).alias("max_range"),
                   avg_volume.alias("avg_volume"),
                   F.max_by("close", ts_col).alias("close"),
                   F.max(ts_col).alias("last_ts")))


def window_detector(stats: DataFrame, params, volume_rule: str = "volume", compat_reasons: bool = False) -> DataFrame:
    """I6 rules (B13, B8, B9, B10, B11) on window statistics.

    volatility: std_return > 2 * sigma(return); range: max_range > range
    threshold; volume: avg_volume > mean + 2 * std of ``volume`` (``params`` must
    have its statistics), or with ``volume_rule="compat"`` of ``volume_change``,
    which compares a volume with percent. A statistic that is not there flags
    nothing.
    """
    feature = {"volume": "volume", "compat": "volume_change"}[volume_rule]
    if feature not in params.stats:
        raise ValueError(f"the {volume_rule} volume rule needs mean and std of {feature} in the parameters")
    number = lambda v: F.lit(v).cast("double")
    vol_limit = number(params.mean(feature)) + number(params.std(feature)) * 2.0
    x = (stats
         .withColumn("volatility_anomaly", fl.flag_gt("std_return", number(params.std("return")) * 2.0))
         .withColumn("range_anomaly", fl.flag_gt("max_range", F.lit(params.range_threshold_pct)))
         .withColumn("volume_anomaly", fl.flag_gt("avg_volume", vol_limit)))
    x = (x.withColumn("total_votes", fl.votes([c for _, c in REASONS]))
          .withColumn("is_anomaly", fl.min_votes("total_votes", params.min_votes))
          .withColumn("confidence", fl.confidence("total_votes"))
          .withColumn("anomaly_reasons", fl.reasons(REASONS, compat=compat_reasons)))
    return x


def window_output(detected: DataFrame, ntz: bool = True) -> DataFrame:
    """M10 projection: flatten the window struct."""
    start, end = F.col("window.start"), F.col("window.end")
    if ntz:
        start, end = start.cast("timestamp_ntz"), end.cast("timestamp_ntz")
    return detected.select(start.alias("window_start"), end.alias("window_end"),
                           *[c for c in WINDOW_OUT if c not in ("window_start", "window_end")])
