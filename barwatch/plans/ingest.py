"""Source / sink queries (A series) and parameter publishing.

Every input is derived by Spark from the driver tables: bars become CSV
exports, exchange envelopes, REST pages and topic payloads, which the
decoders read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barwatch.functions import features as fx
from barwatch.functions import time as tm
from barwatch.operators import detectors as dt
from barwatch.operators import features as fe
from barwatch.operators import sequence
from barwatch.operators import stats as st
from barwatch.plans import sql as q
from barwatch.plans.batch import OHLCV, _CANDLE_SQL_OUT, bars, candles, features, zscore_flags
from barwatch.plans.catalog import r9, register, rounded
from barwatch.plans.streams import P, _stream_candles, candle_rows, land_messages
from barwatch.session import materialize, scratch_path
from barwatch.sources import files as fs
from barwatch.sources import kline as kl
from barwatch.sources import params as pm
from barwatch.streaming import batches, models, runner

_OHLCV_SQL = ", ".join(r9(f'"{c}"', c) for c in OHLCV)


@register("src_ohlcv_csv", sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, "interval", bar_ts AS "timestamp", {_OHLCV_SQL} FROM bars""")
def src_ohlcv_csv(spark, sf_dir):
    """A1: bars exported as raw OHLCV CSV (header) and read back with the explicit schema."""
    path = scratch_path(spark, "a1-ohlcv")
    b = bars(spark, sf_dir).select("symbol", "interval", F.col("bar_ts").alias("timestamp"), *OHLCV)
    b.write.option("header", True).csv(path)
    return rounded(fs.read_ohlcv(spark, path))


@register("src_features_csv", sql=f"""{q.with_features()}
SELECT symbol, "interval", bar_ts AS "timestamp", {_OHLCV_SQL}, trades,
  {', '.join(r9(f'"{f}"', f) for f in fe.FEATURES)} FROM feats""")
def src_features_csv(spark, sf_dir):
    """A2: feature table as CSV, read back with an explicit schema (no inference scan)."""
    path = scratch_path(spark, "a2-features")
    f = features(spark, sf_dir).withColumnRenamed("bar_ts", "timestamp")
    f.select(*[c.name for c in fs.FEATURE_SCHEMA.fields]).write.option("header", True).csv(path)
    return rounded(fs.read_features(spark, path))


_RESULT_SQL = f"""{q.with_features()},
{q.zscore_cte()}
SELECT symbol, bar_ts AS "timestamp", {r9('close')}, {r9('"return"', 'return')}, anomaly_zscore AS anomaly FROM zs"""


def _results(spark, sf_dir):
    z = zscore_flags(spark, sf_dir)
    return z.select("symbol", F.col("bar_ts").alias("timestamp"), "close", "return",
                    F.col("anomaly_zscore").alias("anomaly"))


@register("src_method_results", sql=_RESULT_SQL)
def src_method_results(spark, sf_dir):
    """A3: a detector's result directory written and read back (parquet)."""
    path = scratch_path(spark, "a3-results")
    fs.write_results(_results(spark, sf_dir), path)
    return rounded(fs.read_results(spark, path).select("symbol", "timestamp", "close", "return", "anomaly"))


@register("sink_csv_overwrite", sql=_RESULT_SQL)
def sink_csv_overwrite(spark, sf_dir):
    """CSV result sink with header, partitioned by symbol; written, then written
    again for one symbol only, whose partition is replaced, and read back."""
    path = scratch_path(spark, "a9-csv")
    res = materialize(_results(spark, sf_dir), "results")
    fs.write_results(res, path, fmt="csv")
    fs.write_results(res.filter(F.col("symbol") == res.agg(F.min("symbol")).scalar()), path, fmt="csv")
    file_schema = fs.StructType([f for f in fs.RESULT_SCHEMA.fields if f.name != "symbol"])
    back = fs.read_results(spark, path, fmt="csv", schema=file_schema)   # symbol from the partition path
    return rounded(back.select("symbol", "timestamp", "close", "return", "anomaly"))


_CANDLE_COLS = ["symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "volume",
                "trades", "timestamp"]
_CANDLE_SQL = f"""WITH {q.candles_cte()},
c AS (SELECT symbol, "interval", epoch_ms(bar_ts) AS open_time, epoch_ms(bar_ts) + 599999 AS close_time,
  {_OHLCV_SQL}, CAST(trades AS INTEGER) AS trades, "timestamp" FROM candles)"""


@register("decode_candle_json", sql=f"""{_CANDLE_SQL}
SELECT * FROM c""")
def decode_candle_json(spark, sf_dir):
    """A5: candle-message JSON -> typed columns and event time (batch decode)."""
    msgs = kl.candle_messages(candle_rows(spark, sf_dir))
    d = kl.decode_candles(msgs)
    return rounded(d.select(*_CANDLE_COLS[:-1], F.col("timestamp").cast("timestamp_ntz").alias("timestamp")))


def _envelopes(spark, sf_dir):
    """Exchange envelopes built from the candles: 1 in 4 sent bare (no
    ``data`` wrapper), each also preceded by an open (x=false) update, plus
    a non-kline event per candle — all must be filtered or unwrapped."""
    c = candle_rows(spark, sf_dir)
    s = lambda n: F.col(n).cast("string")  # noqa: E731  prices travel as text
    def k(closed):
        return F.struct(F.col("open_time").alias("t"), F.col("close_time").alias("T"),
                        F.col("interval").alias("i"), s("open").alias("o"), s("high").alias("h"),
                        s("low").alias("l"), s("close").alias("c"), s("volume").alias("v"),
                        s("volume").alias("q"), F.col("trades").alias("n"), F.lit(closed).alias("x"),
                        s("volume").alias("V"), s("volume").alias("Q"))
    def payload(closed, event="kline"):
        return F.struct(F.lit(event).alias("e"), F.upper("symbol").alias("s"), k(closed).alias("k"))
    bare = (F.abs(F.hash("symbol", "open_time")) % 4) == 0
    wrapped = lambda p: F.to_json(F.struct(F.concat(F.lower("symbol"), F.lit("@kline_10m")).alias("stream"),
                                           p.alias("data")))
    closed = F.when(bare, F.to_json(payload(True))).otherwise(wrapped(payload(True)))
    opened = wrapped(payload(False))
    trade = wrapped(payload(True, "trade"))
    return c.select(F.explode(F.array(opened, closed, trade)).alias("value"))


@register("normalize_kline_events", sql=f"""{_CANDLE_SQL}
SELECT upper(symbol) AS symbol, "interval", open_time, close_time, {_OHLCV_SQL}, trades FROM c""")
def normalize_kline_events(spark, sf_dir):
    """A6 + B15: envelopes (wrapped or bare, open and closed, kline and
    other events) -> closed candles with prices cast from text."""
    n = kl.normalize_klines(_envelopes(spark, sf_dir))
    return rounded(n.select("symbol", "interval", "open_time", "close_time", *OHLCV, "trades"))


@register("filter_closed_klines", sql=f"""{_CANDLE_SQL}
SELECT upper(symbol) AS symbol, count(*) AS closed_candles FROM c GROUP BY 1""")
def filter_closed_klines(spark, sf_dir):
    """Only closed kline events survive — count per symbol."""
    n = kl.normalize_klines(_envelopes(spark, sf_dir))
    return n.groupBy("symbol").agg(F.count(F.lit(1)).alias("closed_candles"))


@register("explode_kline_pages", sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, epoch_ms(bar_ts) AS open_time, {_OHLCV_SQL}, epoch_ms(bar_ts) + 3599999 AS close_time,
  CAST(trades AS INTEGER) AS trades, bar_ts AS "timestamp" FROM bars""")
def explode_kline_pages(spark, sf_dir):
    """Bars landed as REST pages (<= 1,000 klines of 12 text fields per
    page) and exploded back into typed OHLCV rows."""
    b = bars(spark, sf_dir, keep=True)
    b = sequence.with_sequence(b, ["symbol"], "bar_ts").withColumn("page", F.floor(F.col("_seq") / 1000))
    ms = tm.ts_to_ms(F.col("bar_ts"))
    s = lambda c: F.col(c).cast("string")
    arr = F.array(ms.cast("string"), s("open"), s("high"), s("low"), s("close"), s("volume"),
                  (ms + F.lit(3_599_999)).cast("string"), s("volume"), s("trades"), s("volume"), s("volume"),
                  F.lit("0"))
    pages = b.groupBy("symbol", "page").agg(F.to_json(F.collect_list(arr)).alias("page_json"))
    rows = kl.klines_from_pages(pages, page_col="page_json")
    return rounded(rows.select("symbol", "open_time", *OHLCV, "close_time", "trades", "timestamp"))


@register("sink_kafka_candles", sql=f"""{_CANDLE_SQL}
SELECT symbol AS "key", symbol, close_time, {r9('close')} FROM c""")
def sink_kafka_candles(spark, sf_dir):
    """Topic payload — key = symbol, value = candle JSON; checked by
    reading the fields back out of the value text."""
    m = kl.candle_messages(candle_rows(spark, sf_dir))
    return rounded(m.select("key", F.get_json_object("value", "$.symbol").alias("symbol"),
                            F.get_json_object("value", "$.close_time").cast("long").alias("close_time"),
                            F.get_json_object("value", "$.close").cast("double").alias("close")))


@register("save_model_params", sql=f"""{q.with_features()},
w AS (SELECT symbol, {', '.join(f'avg("{f}") AS "m_{f}", stddev_samp("{f}") AS "s_{f}"' for f in fe.FEATURES)}
      FROM feats GROUP BY symbol)
{' UNION ALL '.join(f"SELECT symbol, '1h' AS \"interval\", '{f}' AS feature, {r9(f'\"m_{f}\"', 'mean')}, {r9(f'\"s_{f}\"', 'std')} FROM w" for f in fe.FEATURES)}""")
def save_model_params(spark, sf_dir):
    """K9: publish per-(symbol, interval) statistics for the stream; returns
    what a reader of the published location sees."""
    path = scratch_path(spark, "k9-params")
    wide = st.fit_stats(features(spark, sf_dir), fe.FEATURES, by=["symbol", "interval"])
    long = st.stats_long(wide, fe.FEATURES, by=["symbol", "interval"])
    pm.save_params(long, path, extra={"z_threshold": 3.0, "min_votes": 2})
    return rounded(spark.read.parquet(f"{path}/statistics"))


@register("latest_files_scan", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(P)}
SELECT {_CANDLE_SQL_OUT} FROM (SELECT * FROM scored ORDER BY "timestamp" DESC, symbol LIMIT 200)""")
def latest_files_scan(spark, sf_dir):
    """Newest part files of a streaming CSV sink, bad lines and bad
    timestamps dropped, last 200 rows by time."""
    from barwatch.plans.streams import _score_candles
    src, sink, ckpt = (scratch_path(spark, n) for n in ("a13-src", "a13-sink", "a13-ckpt"))
    rows = candle_rows(spark, sf_dir)
    land_messages(kl.candle_messages(rows), src)
    qy = runner.start_file_sink(_score_candles(_stream_candles(spark, src)), sink, ckpt, fmt="csv")
    runner.run_until_done(qy)
    out = _score_candles(_stream_candles(spark, src))
    schema = fs.StructType([fs.StructField(f.name, f.dataType if f.name != "timestamp" else fs.TimestampNTZType())
                            for f in out.schema.fields])
    return rounded(fs.latest_output(spark, sink, schema, n_files=50, n_rows=200))


# Pinned centres for the realtime features (return,
# log_return, price_range) in standardised space.
REALTIME_CENTERS = [[0.0, 0.0, 0.0], [2.0, 2.0, 2.0], [-2.0, -2.0, 2.0]]
REALTIME_FEATURES = ["return", "log_return", "price_range"]


_DZ = [f"z{i}" for i in range(len(REALTIME_FEATURES))]
_D, _DI, _DB = dt.nearest_sql(_DZ, len(REALTIME_CENTERS))
_DSTATS = ", ".join(f'avg("{f}") AS m{i}, stddev_samp("{f}") AS s{i}' for i, f in enumerate(REALTIME_FEATURES))


def _z_of(stats: str) -> str:
    return ", ".join(f'("{f}" - {stats}.m{i}) / NULLIF({stats}.s{i}, 0) AS z{i}' for i, f in enumerate(REALTIME_FEATURES))


@register("score_stream_with_model", sql=f"""WITH {q.candles_cte()},
st0 AS (SELECT {_DSTATS} FROM candles),
sym AS (SELECT symbol, {_DSTATS} FROM candles WHERE symbol <> (SELECT max(symbol) FROM candles) GROUP BY symbol),
zz AS (SELECT "timestamp", c.symbol, {_z_of('st0')} FROM candles c, st0),
{dt.lloyd_sql('zz', _DZ, REALTIME_CENTERS, 20)},
own AS (SELECT "timestamp", c.symbol, {', '.join(f'coalesce(sym.m{i}, st0.m{i}) AS m{i}, coalesce(sym.s{i}, st0.s{i}) AS s{i}' for i in range(len(_DZ)))},
  {', '.join(f'"{f}"' for f in REALTIME_FEATURES)} FROM candles c CROSS JOIN st0 LEFT JOIN sym ON c.symbol = sym.symbol),
oz AS (SELECT "timestamp", symbol, {_z_of('own')} FROM own),
od AS (SELECT x.*, CAST({_DI} AS INTEGER) AS cluster, sqrt({_DB}) AS distance FROM (SELECT *, {_D} FROM oz, lc20) x),
dd AS (SELECT sqrt({_DB}) AS distance FROM (SELECT *, {_D} FROM zz, lc20) x),
lim AS (SELECT symbol, avg(distance) + 2 * stddev_samp(distance) AS threshold FROM od WHERE symbol IN (SELECT symbol FROM sym) GROUP BY symbol)
SELECT "timestamp", od.symbol, cluster, {r9('distance')},
  CASE WHEN distance > coalesce(threshold, (SELECT avg(distance) + 2 * stddev_samp(distance) FROM dd)) THEN 1 ELSE 0 END AS anomaly_kmeans
FROM od LEFT JOIN lim ON od.symbol = lim.symbol""")
def score_stream_with_model(spark, sf_dir):
    """K9 -> K10: a batch job fits centres on the candles and publishes them with each
    series' statistics and threshold, but for one series; the stream loads what is
    published at every micro-batch and scores every candle with it, the series
    without statistics by the default row."""
    model, src, sink, ckpt = (scratch_path(spark, n) for n in ("k10-model", "k10-src", "k10-sink", "k10-ckpt"))
    c = materialize(candles(spark, sf_dir).select("symbol", "interval", *REALTIME_FEATURES), "candles")
    known = c.filter(F.col("symbol") != c.agg(F.max("symbol")).scalar()).select("symbol", "interval").distinct()
    models.publish_centers(c, model, REALTIME_FEATURES, REALTIME_CENTERS, only=known)
    land_messages(kl.candle_messages(candle_rows(spark, sf_dir)), src)

    def scored(batch):
        x = (batch.withColumn("return", fx.return_intrabar()).withColumn("log_return", fx.log_return_intrabar())
             .withColumn("price_range", fx.price_range_low()))
        return models.distance_scored(x, model, REALTIME_FEATURES).select(
            F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "symbol", "cluster", "distance", "anomaly_kmeans")

    runner.run_until_done(batches.start_scored_sink(_stream_candles(spark, src), sink, ckpt, scored))
    return rounded(batches.landed(spark, sink, fs.StructType.fromDDL(
        "timestamp timestamp_ntz, symbol string, cluster int, distance double, anomaly_kmeans int")))


@register("dead_letter_stream", sql=f"""{_CANDLE_SQL}
SELECT 'good' AS sink, symbol, close_time, CAST(NULL AS VARCHAR) AS reason, count(*) AS "rows" FROM c GROUP BY ALL
UNION ALL SELECT 'dead', symbol, close_time, r.reason, count(*) FROM c,
  (VALUES (0, 'no JSON'), (1, 'no symbol'), (2, 'no close time')) r(k, reason)
WHERE (close_time + 1) // 600000 % 3 = r.k GROUP BY ALL""")
def dead_letter_stream(spark, sf_dir):
    """A5 with a dead letter: every candle's message and a broken copy of it (cut off,
    without symbol, or without close time) over three runs. What decodes goes to
    one sink, the rest to the other with its raw text and the reason."""
    src, good, dead, ckpt = (scratch_path(spark, n) for n in ("a5-src", "a5-good", "a5-dead", "a5-ckpt"))
    rows = materialize(candle_rows(spark, sf_dir), "candles")
    kind = F.floor((F.col("close_time") + 1) / 600000) % 3
    mark = F.concat_ws("/", "symbol", F.col("close_time").cast("string"))                    # lets the check find the candle again
    whole = kl.candle_messages(rows.withColumn("received_at", mark), received_at=mark)
    broken = rows.select(F.when(kind == 0, F.concat(F.lit('{"cut": "'), mark, F.lit('"'))).otherwise(F.to_json(F.struct(
        F.when(kind == 2, F.col("symbol")).alias("symbol"), F.when(kind == 1, F.col("close_time")).alias("close_time"),
        mark.alias("cut")))).alias("value"))
    parts = whole.select("value").union(broken).withColumn("part", F.pmod(F.crc32(F.col("value").cast("binary")), F.lit(3)))
    parts = materialize(parts, "messages")
    for i in range(3):
        land_messages(parts.filter(F.col("part") == i), src)
        runner.run_until_done(batches.start_candles_with_dead_letter(runner.candle_stream(spark, src), good, dead, ckpt))
    g = batches.landed(spark, good, fs.StructType.fromDDL("symbol string, close_time long")).withColumn("reason", F.lit(None).cast("string"))
    d = batches.landed(spark, dead, fs.StructType.fromDDL("raw string, reason string"))
    cut = F.split(F.regexp_extract("raw", '"cut": ?"([^"]*)"', 1), "/")
    d = d.select(cut[0].alias("symbol"), cut[1].cast("long").alias("close_time"), "reason")
    both = g.select(F.lit("good").alias("sink"), "*").unionByName(d.select(F.lit("dead").alias("sink"), "*"))
    return both.groupBy("sink", "symbol", "close_time", "reason").agg(F.count(F.lit(1)).alias("rows"))


@register("load_model_params", sql=f"""WITH {q.candles_cte()},
st AS (SELECT {', '.join(f'avg("{f}") AS m_{f}, stddev_samp("{f}") AS s_{f}' for f in REALTIME_FEATURES)} FROM candles)
SELECT symbol, "timestamp", {', '.join(r9(f'("{f}" - m_{f}) / s_{f}', f + '_zscore') for f in REALTIME_FEATURES)}
FROM candles, st""")
def load_model_params(spark, sf_dir):
    """Statistics of the candles published as one JSON document, loaded from
    the first path that exists and used as pinned parameters."""
    from barwatch.operators import scoring
    path = scratch_path(spark, "a12-params")
    c = materialize(candles(spark, sf_dir).select("symbol", "timestamp", *REALTIME_FEATURES), "candles")
    stats = st.fit_stats(c, REALTIME_FEATURES, by=[])
    doc = F.to_json(F.struct(F.struct(F.lit(3.0).alias("threshold"), F.struct(*[
        F.struct(F.col(f"mean_{f}").alias("mean"), F.col(f"std_{f}").alias("std")).alias(f)
        for f in REALTIME_FEATURES]).alias("statistics")).alias("zscore")))
    stats.select(doc.alias("value")).coalesce(1).write.text(path)         # one row
    params = pm.load_params(spark, [path + "-absent", path])
    scored = scoring.zscore_given_params(c, REALTIME_FEATURES, params)
    return rounded(scored.select("symbol", "timestamp", *[f"{f}_zscore" for f in REALTIME_FEATURES]))


@register("sink_stream_csv", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(P)}
SELECT {_CANDLE_SQL_OUT} FROM scored""")
def sink_stream_csv(spark, sf_dir):
    """A10: scored candles appended to CSV files with a header by a checkpointed stream; all rows read back."""
    from barwatch.plans.streams import _score_candles
    src, sink, ckpt = (scratch_path(spark, n) for n in ("a10-src", "a10-sink", "a10-ckpt"))
    land_messages(kl.candle_messages(candle_rows(spark, sf_dir)), src)
    out = _score_candles(_stream_candles(spark, src))
    runner.run_until_done(runner.start_file_sink(out, sink, ckpt, fmt="csv"))
    return rounded(spark.read.schema(out.schema).option("header", True).csv(sink))


@register("sink_stream_console", sql=f"""WITH {q.candles_cte()}
SELECT symbol, count(*) AS candles, max("timestamp") AS last_ts FROM candles GROUP BY symbol""")
def sink_stream_console(spark, sf_dir):
    """The monitoring sink in update mode (memory in place of the console):
    one row a symbol, so the driver holds a few rows."""
    src, ckpt = scratch_path(spark, "a11-src"), scratch_path(spark, "a11-ckpt")
    land_messages(kl.candle_messages(candle_rows(spark, sf_dir)), src)
    name = "monitor_" + ckpt.rsplit("-", 1)[-1]
    counts = _stream_candles(spark, src).groupBy("symbol").agg(F.count(F.lit(1)).alias("candles"), F.max("timestamp").alias("last_ts"))
    runner.run_until_done(runner.start_console_sink(counts, ckpt, fmt="memory", query_name=name))
    return spark.table(name).groupBy("symbol").agg(
        F.max("candles").alias("candles"), F.max("last_ts").cast("timestamp_ntz").alias("last_ts"))


@register("src_kafka_candles", sql=f"""{_CANDLE_SQL}
SELECT * FROM c""")
def src_kafka_candles(spark, sf_dir):
    """A4: the topic's messages read as a stream and decoded (files of messages in place of a broker)."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("a4-src", "a4-sink", "a4-ckpt"))
    land_messages(kl.candle_messages(candle_rows(spark, sf_dir)), src)
    d = _stream_candles(spark, src).select(*_CANDLE_COLS[:-1], F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
    runner.run_until_done(runner.start_file_sink(d, sink, ckpt))
    return rounded(spark.read.parquet(sink))
