"""Decoding exchange payloads into candle rows (batch or streaming).

* ``decode_candles``    — candle-message JSON (M2) -> flat typed columns + event time.
* ``normalize_klines``  — raw kline envelopes (combined-stream or bare) ->
  closed candles only, prices cast from text. Parsed as VARIANT, so the
  case-colliding keys (t/T, v/V, q/Q) need no case-sensitive session.
* ``klines_from_pages`` — landed REST pages (array of 12-element arrays) -> OHLCV rows.
* ``candle_messages``   — the inverse: candle rows -> (key = symbol, value = JSON).

All are per-row expressions: they run in whichever task reads the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from barwatch.functions.numeric import finite
from barwatch.functions.time import ms_to_iso, ms_to_ts

# The candle message schema (field names, order, types).
CANDLE_SCHEMA = StructType([
    StructField("symbol", StringType(), True),
    StructField("interval", StringType(), True),
    StructField("open_time", LongType(), True),
    StructField("close_time", LongType(), True),
    StructField("datetime", StringType(), True),
    StructField("open", DoubleType(), True),
    StructField("high", DoubleType(), True),
    StructField("low", DoubleType(), True),
    StructField("close", DoubleType(), True),
    StructField("volume", DoubleType(), True),
    StructField("quote_volume", DoubleType(), True),
    StructField("taker_buy_volume", DoubleType(), True),
    StructField("taker_buy_quote_volume", DoubleType(), True),
    StructField("trades", IntegerType(), True),
    StructField("is_closed", BooleanType(), True),
    StructField("received_at", StringType(), True),
])

PRICE_FIELDS = ["open", "high", "low", "close", "volume"]

# Kline field letters -> candle columns, and the REST page
# positions (0 open ms, 1-5 o/h/l/c/v, 6 close ms, 7 quote volume, 8 trades,
# 9 taker base, 10 taker quote, 11 ignore).
KLINE_FIELDS = [
    ("interval", "i", "string"), ("open_time", "t", "bigint"), ("close_time", "T", "bigint"),
    ("open", "o", "double"), ("high", "h", "double"), ("low", "l", "double"), ("close", "c", "double"),
    ("volume", "v", "double"), ("quote_volume", "q", "double"), ("taker_buy_volume", "V", "double"),
    ("taker_buy_quote_volume", "Q", "double"), ("trades", "n", "int"),
]
PAGE_FIELDS = [("open_time", 0, "bigint"), ("open", 1, "double"), ("high", 2, "double"), ("low", 3, "double"),
               ("close", 4, "double"), ("volume", 5, "double"), ("close_time", 6, "bigint"),
               ("quote_volume", 7, "double"), ("trades", 8, "int"), ("taker_buy_volume", 9, "double"),
               ("taker_buy_quote_volume", 10, "double")]


def _as_text(c: Column) -> Column:
    return c.cast("string")


def decode_candles(df: DataFrame, value_col: str = "value", keep_invalid: bool = False) -> DataFrame:
    """A5: JSON candle message -> 16 typed columns + ``timestamp`` (close time).

    Malformed JSON yields a row of NULLs (PERMISSIVE); ``_valid`` marks rows
    with a symbol and a close time in the calendar's range, and invalid rows are dropped unless
    ``keep_invalid`` (the dead-letter branch reads them).
    """
    parsed = df.select(F.from_json(_as_text(F.col(value_col)), CANDLE_SCHEMA).alias("m"),
                       _as_text(F.col(value_col)).alias("_raw"))
    out = parsed.select("m.*", "_raw")
    for c in PRICE_FIELDS:
        out = out.withColumn(c, finite(c))
    out = out.withColumn("timestamp", ms_to_ts(F.col("close_time"))) \
             .withColumn("_valid", F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())
    if keep_invalid:
        return out
    return out.filter("_valid").drop("_valid", "_raw")


def normalize_klines(df: DataFrame, value_col: str = "value", received_at: Column | None = None,
                     keep_invalid: bool = False) -> DataFrame:
    """A6 + B15: exchange envelopes -> closed candle rows (M2 columns).

    Accepts the combined-stream form ``{stream, data: {...}}`` and the bare
    payload; keeps only ``e = 'kline'`` events whose candle is closed.

    With ``keep_invalid`` every envelope comes back with its ``_raw`` text and a
    ``_status``: ``candle`` (what is kept otherwise), ``ignored`` (another event, or
    a candle still open) or ``invalid`` (no JSON, no event name, or a closed candle
    without symbol or a close time), so that nothing vanishes uncounted.
    """
    raw = _as_text(F.col(value_col))
    x = df.select(F.try_parse_json(raw).alias("_v"), raw.alias("_raw"))
    payload = F.coalesce(F.try_variant_get("_v", "$.data", "variant"), F.col("_v"))
    x = x.select(payload.alias("p"), "_raw")
    k = F.try_variant_get("p", "$.k", "variant")
    cols = [F.try_variant_get("p", "$.s", "string").alias("symbol")]
    for name, letter, typ in KLINE_FIELDS:
        cols.append(F.try_variant_get(k, f"$.{letter}", typ).alias(name))
    x = x.select(F.try_variant_get("p", "$.e", "string").alias("_e"),
                 F.try_variant_get(k, "$.x", "boolean").alias("_x"), *cols, "_raw")
    closed = F.coalesce((F.col("_e") == "kline") & F.col("_x"), F.lit(False))
    if keep_invalid:
        whole = F.col("symbol").isNotNull() & ms_to_ts(F.col("close_time")).isNotNull()
        x = x.withColumn("_status", F.when(F.col("_e").isNull(), "invalid").when(~closed, "ignored")
                         .when(whole, "candle").otherwise("invalid"))
    else:
        x = x.filter(closed)
    recv = received_at if received_at is not None else F.date_format(F.current_timestamp(),
                                                                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return x.select(
        "symbol", "interval", "open_time", "close_time", ms_to_iso(F.col("open_time")).alias("datetime"),
        *[finite(c).alias(c) for c in [*PRICE_FIELDS, "quote_volume", "taker_buy_volume", "taker_buy_quote_volume"]],
        "trades",
        (F.col("_x") if keep_invalid else F.lit(True)).alias("is_closed"), recv.alias("received_at"),
        *(["_raw", "_status"] if keep_invalid else []))


def klines_from_pages(df: DataFrame, page_col: str = "page", symbol_col: str = "symbol",
                      keep_invalid: bool = False) -> DataFrame:
    """Landed REST pages (JSON ``array<array<string>>``) -> OHLCV rows.

    One page holds at most 1,000 klines, so the ``explode`` stays per row. A
    field that is absent, no number, NaN or infinite is NULL; rows without a
    time or a close are dropped, or with ``keep_invalid`` marked ``_valid =
    false`` beside their ``_raw`` text (the dead-letter branch reads them).
    """
    arr = F.from_json(_as_text(F.col(page_col)), "array<array<string>>")
    x = df.select(F.col(symbol_col).alias("symbol"), F.explode(arr).alias("k"))
    field = lambda i, t: finite(F.get("k", i).try_cast(t)) if t == "double" else F.get("k", i).try_cast(t)
    x = x.select("symbol", *[field(F.lit(i), t).alias(n) for n, i, t in PAGE_FIELDS], F.to_json("k").alias("_raw")) \
         .withColumn("timestamp", ms_to_ts(F.col("open_time")).cast("timestamp_ntz")) \
         .withColumn("_valid", F.col("timestamp").isNotNull() & F.col("close").isNotNull())
    return x if keep_invalid else x.filter("_valid").drop("_valid", "_raw")


def candle_messages(df: DataFrame, received_at: Column | None = None) -> DataFrame:
    """A7 payload: ``key`` = symbol (per-symbol order within one partition),
    ``value`` = the candle message JSON (M2 field order)."""
    recv = received_at if received_at is not None else F.lit(None).cast("string")
    fields = []
    for f in CANDLE_SCHEMA.fields:
        if f.name == "received_at":
            fields.append(recv.alias("received_at"))
        elif f.name in df.columns:
            fields.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            fields.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(F.col("symbol").cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
