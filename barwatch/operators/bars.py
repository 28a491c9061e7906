"""Tick -> bar adapter and bar-level cleaning.

The exchange builds candles for the reference; here a table of ticks
(``events``: one value per timestamp and event type) becomes OHLCV bars.
This is one hash aggregation on (symbol, bar_ts) with map-side partial
aggregation, so a hot symbol is pre-reduced in every input task before the
shuffle and each reducer holds one row per (symbol, bar).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwatch.functions.time import interval_label

# (ts, tie) packed into one DECIMAL(38,0): micros * 2^64 + (tie + 2^63).
# Order-preserving for any timestamp in years 0001-9999 and any signed long.
_TIE_SHIFT = 2 ** 63
_TS_SCALE = 2 ** 64


def tick_order_key(ts: Column, tie: Column) -> Column:
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(38,0)")
    scale = F.lit(Decimal(_TS_SCALE)).cast("decimal(38,0)")
    shift = F.lit(Decimal(_TIE_SHIFT)).cast("decimal(38,0)")
    return micros * scale + (tie.cast("decimal(38,0)") + shift)


BAR_COLUMNS = ["symbol", "interval", "bar_ts", "open", "high", "low", "close", "volume", "trades"]


def bars_from_ticks(ticks: DataFrame, interval: str = "1 hour", symbol_col: str = "event_type",
                    ts_col: str = "ts", price_col: str = "value", tie_col: str = "event_id",
                    label: str | None = None) -> DataFrame:
    """OHLCV bars per (symbol, interval start).

    open/close are the first/last price by (ts, tie) — ``min_by``/``max_by``
    on one fixed-width key, deterministic after any shuffle (unlike
    ``first``) and hash-aggregatable (a struct key would force a sort-based
    aggregation over every tick). volume is the sum of prices, trades the
    tick count.
    """
    order_key = tick_order_key(F.col(ts_col), F.col(tie_col))
    label = label or interval_label(interval)
    return (
        ticks.select(
            F.col(symbol_col).alias("symbol"),
            F.window(F.col(ts_col), interval).start.alias("bar_ts"),
            F.col(price_col).alias("price"),
            order_key.alias("_k"),
        )
        .groupBy("symbol", "bar_ts")
        .agg(
            F.min_by("price", "_k").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_k").alias("close"),
            F.sum("price").alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
        .select("symbol", F.lit(label).alias("interval"), "bar_ts",
                "open", "high", "low", "close", "volume", "trades")
    )


def dedupe_by_time(df: DataFrame, keys=("symbol",), ts_col: str = "bar_ts",
                   order_col: str | None = None) -> DataFrame:
    """Keep one row per (keys, ts): the first by ``order_col`` (ingest order).

    The window is partitioned by the full (keys, ts) pair, so each group is a
    handful of duplicates, never a whole symbol.
    """
    part = list(keys) + [ts_col]
    order = F.col(order_col) if order_col else F.col(ts_col)
    w = Window.partitionBy(*part).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
