"""History features per series (prev-close returns, 24-row rolling stats).

All frames reach at most ``window_rows`` rows back, so they run over the
halo blocks of :mod:`barwatch.operators.sequence` — exact, and no task ever
holds more than one block of one series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.functions.features import price_range
from barwatch.functions.numeric import finite, pct_change, safe_div, safe_ln
from barwatch.operators import sequence
from barwatch.operators.joins import keyed_join
from barwatch.session import materialize

# The six batch features, in the reference's order.
FEATURES = ["return", "log_return", "volatility_24h", "volume_change", "volume_ratio", "price_range"]
SERIES_KEYS = ["symbol", "interval"]
WARMUP_ROWS = 24


def add_history_features(bars: DataFrame, keys=SERIES_KEYS, ts_col: str = "bar_ts",
                         window_rows: int = WARMUP_ROWS,
                         block_rows: int = sequence.DEFAULT_BLOCK_ROWS,
                         range_denominator: str = "close",
                         keep_seq: bool = False) -> DataFrame:
    """Add the six features; rows keep NULLs during warm-up (see drop_incomplete).

    return        = close.pct_change() * 100          (lag 1)
    log_return    = ln(close / prev_close) * 100
    volatility_24h= sample std of the last 24 returns, NULL unless all 24 exist
    volume_change = volume.pct_change() * 100
    volume_ratio  = volume / mean of the last 24 volumes, NULL unless 24 exist
    price_range   = (high - low) / close * 100
    """
    x, w = sequence.blocked(bars, list(keys), ts_col, halo=window_rows, block_rows=block_rows)
    wn = w.rowsBetween(-(window_rows - 1), 0)
    # Window outputs land in plain columns first: an expression that reads
    # a window function several times (finite() does) would otherwise make
    # Spark evaluate that window function once per reference.
    x = (x.withColumn("_prev_close", F.lag("close", 1).over(w))
          .withColumn("_prev_volume", F.lag("volume", 1).over(w)))
    x = (x.withColumn("return", finite(pct_change(F.col("close"), F.col("_prev_close"))))
          .withColumn("log_return", finite(safe_ln(safe_div(F.col("close"), F.col("_prev_close"))) * 100.0))
          .withColumn("volume_change", finite(pct_change(F.col("volume"), F.col("_prev_volume"))))
          .withColumn("price_range", finite(price_range(denominator=range_denominator))))
    x = (x.withColumn("_n_ret", F.count("return").over(wn))
          .withColumn("_sd_ret", F.stddev_samp("return").over(wn))
          .withColumn("_n_vol", F.count("volume").over(wn))
          .withColumn("_avg_vol", F.avg("volume").over(wn)))
    x = (x.withColumn("volatility_24h", F.when(F.col("_n_ret") == window_rows, F.col("_sd_ret")))
          .withColumn("volume_ratio", F.when(F.col("_n_vol") == window_rows,
                                             finite(safe_div(F.col("volume"), F.col("_avg_vol")))))
          .drop("_prev_close", "_prev_volume", "_n_ret", "_sd_ret", "_n_vol", "_avg_vol"))
    out = sequence.unblock(x, keep_seq=keep_seq)
    return out


def drop_incomplete(df: DataFrame, features=FEATURES) -> DataFrame:
    """Remove rows with a NULL in any feature (NaN/inf were already NULLed)."""
    return df.dropna(subset=list(features))


def feature_table(bars: DataFrame, keys=SERIES_KEYS, ts_col: str = "bar_ts",
                  window_rows: int = WARMUP_ROWS, block_rows: int = sequence.DEFAULT_BLOCK_ROWS,
                  range_denominator: str = "close") -> DataFrame:
    """All six features, warm-up rows removed (24 per series on clean data)."""
    feats = add_history_features(bars, keys, ts_col, window_rows, block_rows, range_denominator)
    return drop_incomplete(feats)


def row_number_key(df: DataFrame, keys=SERIES_KEYS, ts_col: str = "bar_ts",
                   name: str = "row_id") -> DataFrame:
    """1-based consecutive position per series (display only; joins use keys)."""
    x = sequence.with_sequence(df, list(keys), ts_col)
    return x.withColumn(name, F.col("_seq") + 1).drop("_seq", "_chunk")


def fill_forward(df: DataFrame, cols: list[str], keys=SERIES_KEYS, ts_col: str = "bar_ts",
                 block_rows: int = sequence.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Replace NULLs by the last non-NULL value earlier in the series.

    Inside a block ``last(ignorenulls)`` does it; a NULL run that starts in an
    earlier block takes the last non-NULL value of the preceding blocks,
    carried by a running ``max_by`` over the small per-block summary table.
    """
    keys = list(keys)
    x, w = sequence.blocked(df, keys, ts_col, halo=0, block_rows=block_rows)
    w_run = w.rowsBetween(Window.unboundedPreceding, 0)
    summary_aggs = []
    for c in cols:
        x = x.withColumn(f"_ff_{c}", F.last(c, ignorenulls=True).over(w_run))
        summary_aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_seq"))).alias(f"_bl_{c}"))
    blocks = x.groupBy(*keys, "_blk").agg(*summary_aggs)
    w_blk = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(*keys, "_blk",
                          *[F.last(f"_bl_{c}", ignorenulls=True).over(w_blk).alias(f"_carry_{c}") for c in cols])
    x = keyed_join(x, carry, keys + ["_blk"], "left")
    for c in cols:
        x = x.withColumn(c, F.coalesce(F.col(c), F.col(f"_ff_{c}"), F.col(f"_carry_{c}")))
    drop = [f"_ff_{c}" for c in cols] + [f"_carry_{c}" for c in cols]
    return sequence.unblock(x.drop(*drop))


def fill_mean(df: DataFrame, cols: list[str], keys=("symbol",)) -> DataFrame:
    """Replace NULLs by the series mean (a partial aggregate + join, no
    whole-series window)."""
    keys = list(keys)
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols])
    x = keyed_join(df, materialize(means, "means"), keys, "left")
    for c in cols:
        x = x.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}")))
    return x.drop(*[f"_m_{c}" for c in cols])
