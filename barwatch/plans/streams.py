"""Window and streaming queries (I series, B10/B11/B13/B18/B21).

Candles are 10-minute bars built from ``events``. Batch forms run the same
functions on a static DataFrame; streaming forms land the candle messages
as JSON-lines files (a Kafka topic's drop-in), replay them through
Structured Streaming with ``availableNow`` into file sinks under the shared
checkpoint folder, and return what the sink committed.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barwatch.functions import features as fx
from barwatch.functions import flags as fl
from barwatch.functions import time as tm
from barwatch.operators import report as rp
from barwatch.operators import scoring
from barwatch.plans import sql as q
from barwatch.plans.batch import CANDLE_FEATURES, CANDLE_OUT, _CANDLE_SQL_OUT, _interval_ms, candles
from barwatch.plans.catalog import r9, register, rounded
from barwatch.session import materialize, scratch_path
from barwatch.sources import params as pm
from barwatch.sources.kline import candle_messages
from barwatch.streaming import batches, models, runner
from barwatch.streaming import windows as wn

P = pm.Params()
STATS_OUT = ["window_start", "window_end", "symbol", "close", "avg_return", "std_return", "avg_range",
             "max_range", "avg_volume", "last_ts"]


# --- oracle SQL pieces ---------------------------------------------------------

def _r4(expr: str) -> str:
    # Spark rounds HALF_UP on the shortest decimal text of the double; do the
    # same in SQL (text -> DECIMAL -> round) so exact ties agree.
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), 4) AS DOUBLE)"


def _avg2(col: str) -> str:
    # Exact mean of 9-digit decimals rounded HALF_UP to 2 digits, in integers
    # (values are non-negative volumes): (2*100*S + n*1e9) // (2*n*1e9) / 100.
    s = f"CAST(sum(CAST({col} AS DECIMAL(38, 9))) * 1000000000 AS HUGEINT)"
    n = f"CAST(count({col}) AS HUGEINT)"
    return f"CAST(({s} * 200 + {n} * 1000000000) // ({n} * 2000000000) AS DOUBLE) / 100"


_WSTATS_SQL = f"""WITH {q.candles_cte()},
expanded AS (
  SELECT c.*, unnest(generate_series(time_bucket(INTERVAL '1 minute', "timestamp") - INTERVAL 59 minutes,
                                     time_bucket(INTERVAL '1 minute', "timestamp"), INTERVAL 1 minute)) AS window_start
  FROM candles c),
wstats AS (
  SELECT window_start, window_start + INTERVAL 1 hour AS window_end, symbol,
    {_r4('avg("return")')} AS avg_return, {_r4('stddev_samp("return")')} AS std_return,
    {_r4('avg(price_range)')} AS avg_range, {_r4('max(price_range)')} AS max_range,
    {_avg2('volume')} AS avg_volume, arg_max(close, "timestamp") AS close, max("timestamp") AS last_ts
  FROM expanded WHERE "timestamp" >= window_start AND "timestamp" < window_start + INTERVAL 1 hour
  GROUP BY window_start, symbol),
wdet_1 AS (
  SELECT *, CASE WHEN std_return > {q.lit(P.std('return'))} * 2.0 THEN 1 ELSE 0 END AS volatility_anomaly,
    CASE WHEN max_range > {q.lit(P.range_threshold_pct)} THEN 1 ELSE 0 END AS range_anomaly,
    CASE WHEN avg_volume > {q.lit(P.mean('volume_change') + P.std('volume_change') * 2)} THEN 1 ELSE 0 END AS volume_anomaly
  FROM wstats),
wdet AS (
  SELECT *, volatility_anomaly + range_anomaly + volume_anomaly AS total_votes,
    volatility_anomaly + range_anomaly + volume_anomaly >= {P.min_votes} AS is_anomaly,
    CASE WHEN volatility_anomaly + range_anomaly + volume_anomaly >= 3 THEN 'HIGH'
         WHEN volatility_anomaly + range_anomaly + volume_anomaly = 2 THEN 'MEDIUM'
         WHEN volatility_anomaly + range_anomaly + volume_anomaly = 1 THEN 'LOW' ELSE 'NONE' END AS confidence,
    concat_ws(' | ', CASE WHEN volatility_anomaly = 1 THEN 'VOLATILITY' END,
              CASE WHEN range_anomaly = 1 THEN 'RANGE' END, CASE WHEN volume_anomaly = 1 THEN 'VOLUME' END)
      AS anomaly_reasons
  FROM wdet_1),
closed AS (SELECT * FROM wdet WHERE window_end <= (SELECT max("timestamp") FROM candles) - INTERVAL 10 minutes)"""

_STATS_SEL = ", ".join(r9(f'"{c}"', c) if c in ("close", "avg_return", "std_return", "avg_range", "max_range",
                                                   "avg_volume") else f'"{c}"' for c in STATS_OUT)
_WOUT_SEL = ", ".join(r9(f'"{c}"', c) if c in ("close", "avg_return", "std_return", "max_range", "avg_volume")
                      else f'"{c}"' for c in wn.WINDOW_OUT)


# --- batch forms -------------------------------------------------------------------

def _stats_out(stats: DataFrame) -> DataFrame:
    return stats.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                        "symbol", "close", "avg_return", "std_return", "avg_range", "max_range", "avg_volume",
                        F.col("last_ts").cast("timestamp_ntz").alias("last_ts"))


def window_stats_batch(spark, sf_dir) -> DataFrame:
    c = candles(spark, sf_dir).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return wn.sliding_window_stats(c)


def window_detected_batch(spark, sf_dir) -> DataFrame:
    return wn.window_output(wn.window_detector(window_stats_batch(spark, sf_dir), P, volume_rule="compat"))


@register("sliding_window_stats", sql=f"""{_WSTATS_SQL}
SELECT {_STATS_SEL} FROM wstats""")
def sliding_window_stats(spark, sf_dir):
    """I1 (batch form): 1 h windows sliding by 1 min over 10-minute candles."""
    return rounded(_stats_out(window_stats_batch(spark, sf_dir)))


@register("window_detector", sql=f"""{_WSTATS_SQL}
SELECT {_WOUT_SEL} FROM wdet""")
def window_detector(spark, sf_dir):
    """I6 (batch form): window rules, votes, confidence and reasons for every window."""
    return rounded(window_detected_batch(spark, sf_dir))


_RULES = ["window_start", "symbol", "volatility_anomaly", "range_anomaly", "volume_anomaly"]


@register("window_threshold_flags", sql=f"""{_WSTATS_SQL}
SELECT window_start, symbol, volatility_anomaly, range_anomaly,
  CASE WHEN avg_volume > (SELECT avg(volume) + 2.0 * stddev_samp(volume) FROM candles) THEN 1 ELSE 0 END AS volume_anomaly FROM wdet""")
def window_threshold_flags(spark, sf_dir):
    """Volatility / range / volume rules per window; a volume is judged by the
    mean and std of volumes, fitted on the candles."""
    from barwatch.operators import stats as st
    row = st.fit_stats(candles(spark, sf_dir), ["volume"], by=[]).first()                # one row
    params = replace(P, stats=P.stats | {"volume": {"mean": row["mean_volume"], "std": row["std_volume"]}})
    return wn.window_output(wn.window_detector(window_stats_batch(spark, sf_dir), params)).select(*_RULES)


@register("window_threshold_flags_compat", sql=f"""{_WSTATS_SQL}
SELECT window_start, symbol, volatility_anomaly, range_anomaly, volume_anomaly FROM wdet""")
def window_threshold_flags_compat(spark, sf_dir):
    """B13 with the original volume rule, which compares a volume with percent statistics."""
    return window_detected_batch(spark, sf_dir).select(*_RULES)


@register("confidence_band", sql=f"""{_WSTATS_SQL}
SELECT window_start, symbol, total_votes, confidence FROM wdet""")
def confidence_band(spark, sf_dir):
    """HIGH / MEDIUM / LOW / NONE from the window votes."""
    return window_detected_batch(spark, sf_dir).select("window_start", "symbol", "total_votes", "confidence")


@register("anomaly_reasons", sql=f"""{_WSTATS_SQL}
SELECT window_start, symbol, anomaly_reasons FROM wdet""")
def anomaly_reasons(spark, sf_dir):
    """Names of the raised rules joined by ' | ' (no empty slots)."""
    return window_detected_batch(spark, sf_dir).select("window_start", "symbol", "anomaly_reasons")


@register("round_outputs", sql=f"""{_WSTATS_SQL}
SELECT window_start, symbol, avg_return, std_return, avg_range, max_range, avg_volume FROM wstats""")
def round_outputs(spark, sf_dir):
    """Window statistics rounded to 4 digits (volume to 2), as published."""
    return _stats_out(window_stats_batch(spark, sf_dir)).select(
        "window_start", "symbol", "avg_return", "std_return", "avg_range", "max_range", "avg_volume")


@register("status_label", sql=f"""{_WSTATS_SQL},
lastw AS (SELECT symbol, arg_max(is_anomaly, window_end) AS is_anomaly, max(window_end) AS window_end
          FROM wdet GROUP BY symbol),
scored AS (SELECT symbol, "timestamp", {' + '.join(f'CASE WHEN abs(("{f}" - {q.lit(P.mean(f))}) / {q.lit(P.std(f))}) > {q.lit(P.z_threshold)} THEN 1 ELSE 0 END' for f in CANDLE_FEATURES)} >= {P.min_votes} AS is_candle_anomaly
           FROM candles QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) <= 200),
recent AS (SELECT symbol, count(*) FILTER (WHERE is_candle_anomaly) AS recent_anomalies FROM scored GROUP BY symbol)
SELECT l.symbol, l.window_end, CASE WHEN l.is_anomaly THEN 'VOLATILE' ELSE 'STABLE' END AS window_status,
  r.recent_anomalies, CASE WHEN r.recent_anomalies > 0 THEN 'ANOMALY ACTIVE' ELSE 'MARKET NORMAL' END AS market_status
FROM lastw l JOIN recent r ON l.symbol = r.symbol""")
def status_label(spark, sf_dir):
    """Per-symbol VOLATILE/STABLE from the latest window and ANOMALY
    ACTIVE/MARKET NORMAL from anomalies among the latest 200 candles."""
    from barwatch.operators.joins import keyed_join
    w = window_detected_batch(spark, sf_dir)
    lastw = w.groupBy("symbol").agg(F.max("window_end").alias("window_end"),
                                    F.max_by("is_anomaly", "window_end").alias("is_anomaly"))
    c = scoring.candle_detector(candles(spark, sf_dir), P)
    recent = rp.top_k_per_group(c.select("symbol", "timestamp", "is_candle_anomaly"), ["symbol"],
                                [F.col("timestamp").desc()], 200)
    recent = recent.groupBy("symbol").agg(F.count_if("is_candle_anomaly").alias("recent_anomalies"))
    x = keyed_join(lastw, recent, ["symbol"])
    return x.select("symbol", "window_end", fl.volatility_status("is_anomaly").alias("window_status"),
                    "recent_anomalies", fl.market_status("recent_anomalies").alias("market_status"))


# --- streaming forms -----------------------------------------------------------------

def candle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-minute candles with the message fields (open/close ms, ISO time)."""
    step = _interval_ms("10 minutes")
    c = candles(spark, sf_dir)
    return (c.withColumn("open_time", tm.ts_to_ms(F.col("bar_ts")))
             .withColumn("close_time", F.col("open_time") + F.lit(step - 1))
             .withColumn("datetime", tm.ms_to_iso(F.col("open_time")))
             .withColumn("trades", F.col("trades").cast("int"))
             .withColumn("is_closed", F.lit(True)))


def candle_message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candle messages (key, value) built from the 10-minute candles."""
    return candle_messages(candle_rows(spark, sf_dir))


def land_messages(msgs: DataFrame, path: str) -> None:
    """Append messages as JSON-lines text files (what a topic would hold)."""
    msgs.select("value").write.mode("append").text(path)


def time_cuts(rows: DataFrame, parts: int) -> list[int]:
    """Inner bounds of ``parts`` equal time ranges, from the data's first and last close time."""
    lo, hi = rows.agg(F.min("close_time"), F.max("close_time")).first()
    return [] if lo is None else [lo + (hi - lo) * i // parts for i in range(1, parts)]


def land_in_turn(rows: DataFrame, path: str, parts: int, run) -> None:
    """Land the candles in ``parts`` time slices, calling ``run()`` after each:
    every run is a micro-batch of its own over the checkpoint, so state, updates
    and the watermark move across batches."""
    bounds = [None, *time_cuts(rows, parts), None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = rows if lo is None else rows.filter(F.col("close_time") >= lo)
        land_messages(candle_messages(part if hi is None else part.filter(F.col("close_time") < hi)), path)
        run()


def _stream_candles(spark, src: str) -> DataFrame:
    return runner.decoded_stream(spark, src)


def _score_candles(decoded: DataFrame) -> DataFrame:
    x = (decoded.withColumn("return", fx.return_intrabar())
                .withColumn("log_return", fx.log_return_intrabar())
                .withColumn("price_range", fx.price_range_low()))
    x = scoring.candle_detector(x, P)
    return x.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).select(*CANDLE_OUT)


def _window_stream(decoded: DataFrame) -> DataFrame:
    x = (decoded.withColumn("return", fx.return_intrabar())
                .withColumn("price_range", fx.price_range_low()))
    return wn.sliding_window_stats(x, watermark=wn.WATERMARK)


def _run_candle_sink(spark, src: str, sink: str, ckpt: str) -> None:
    qy = runner.start_file_sink(_score_candles(_stream_candles(spark, src)), sink, ckpt)
    runner.run_until_done(qy)


@register("watermark_append", sql=f"""{_WSTATS_SQL}
SELECT {_STATS_SEL} FROM wstats WHERE window_end <= (SELECT max("timestamp") FROM candles) - INTERVAL 10 minutes""")
def watermark_append(spark, sf_dir):
    """Streamed window stats in append mode — a window is emitted once the
    10-minute watermark passes its end."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("i2-src", "i2-sink", "i2-ckpt"))
    land_messages(candle_message_rows(spark, sf_dir), src)
    qy = runner.start_file_sink(_stats_out(_window_stream(_stream_candles(spark, src))), sink, ckpt)
    runner.run_until_done(qy)
    return rounded(spark.read.parquet(sink))


@register("window_update_mode", sql=f"""{_WSTATS_SQL}
SELECT {_STATS_SEL} FROM wstats""")
def window_update_mode(spark, sf_dir):
    """The same stream in update mode over five runs, landed as a change log that
    is compacted every other batch; the current row of every window gives the
    full, unclosed result."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("i3-src", "i3-sink", "i3-ckpt"))
    keys = ["window_start", "symbol"]
    stream = lambda: _stats_out(_window_stream(_stream_candles(spark, src)))
    land_in_turn(materialize(candle_rows(spark, sf_dir), "candles"), src, 5, lambda: runner.run_until_done(
        batches.start_update_log(stream(), sink, ckpt, keys, compact_every=2)))
    return rounded(batches.latest(spark, sink, keys, stream().schema))


def run_with_late_rows(spark, sf_dir):
    """All candles through the append-mode window stream, then the first tenth of the
    time span again with doubled prices; (sink, rows dropped behind the watermark)."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("i4-src", "i4-sink", "i4-ckpt"))
    rows = materialize(candle_rows(spark, sf_dir), "candles")
    land_messages(candle_messages(rows), src)
    stream = lambda: runner.start_file_sink(_stats_out(_window_stream(_stream_candles(spark, src))), sink, ckpt)
    runner.run_until_done(stream())
    cuts = time_cuts(rows, 10)
    first = rows.filter(F.col("close_time") < F.lit(cuts[0] if cuts else 0))
    land_messages(candle_messages(first.withColumns({c: F.col(c) * 2 for c in ("open", "high", "low", "close")})), src)
    query = stream()
    runner.run_until_done(query)
    return sink, runner.rows_dropped_late(query)


@register("late_rows_dropped", sql=f"""{_WSTATS_SQL}
SELECT {_STATS_SEL} FROM wstats WHERE window_end <= (SELECT max("timestamp") FROM candles) - INTERVAL 10 minutes""")
def late_rows_dropped(spark, sf_dir):
    """I4: rows re-sent behind the watermark change no emitted window; the stream's
    progress counts what it dropped (``run_with_late_rows``)."""
    sink, _ = run_with_late_rows(spark, sf_dir)
    return rounded(spark.read.parquet(sink))


@register("dedupe_stream", sql=f"""WITH {q.candles_cte()}
SELECT symbol, "timestamp", {r9('close')} FROM candles""")
def dedupe_stream(spark, sf_dir):
    """D10 on a stream: candles landed in four runs, each run also re-sending the run
    before with doubled prices; the first row of each (symbol, close time) stays."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("d10-src", "d10-sink", "d10-ckpt"))
    rows = materialize(candle_rows(spark, sf_dir), "candles")
    bounds = [None, *time_cuts(rows, 4), None]
    again = None
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = rows if lo is None else rows.filter(F.col("close_time") >= lo)
        part = part if hi is None else part.filter(F.col("close_time") < hi)
        land_messages(candle_messages(part), src)
        if again is not None:
            land_messages(candle_messages(again.withColumn("close", F.col("close") * 2)), src)
        once = runner.first_seen(_stream_candles(spark, src), ["symbol", "timestamp"], "timestamp", "40 days")
        runner.run_until_done(runner.start_file_sink(
            once.select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "close"), sink, ckpt))
        again = part
    return rounded(spark.read.parquet(sink))


@register("candle_stream_detector", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(P)}
SELECT {_CANDLE_SQL_OUT} FROM scored""")
def candle_stream_detector(spark, sf_dir):
    """Stateless per-candle votes on the stream, every candle emitted (append)."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("i5-src", "i5-sink", "i5-ckpt"))
    land_messages(candle_message_rows(spark, sf_dir), src)
    _run_candle_sink(spark, src, sink, ckpt)
    return rounded(spark.read.parquet(sink))


@register("window_stream_detector", sql=f"""{_WSTATS_SQL}
SELECT {_WOUT_SEL} FROM closed""")
def window_stream_detector(spark, sf_dir):
    """Window rules on the watermarked stream, closed windows appended."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("i6-src", "i6-sink", "i6-ckpt"))
    land_messages(candle_message_rows(spark, sf_dir), src)
    det = wn.window_output(wn.window_detector(_window_stream(_stream_candles(spark, src)), P, volume_rule="compat"))
    runner.run_until_done(runner.start_file_sink(det, sink, ckpt))
    return rounded(spark.read.parquet(sink))


@register("dual_stream_run", sql=f"""{_WSTATS_SQL},
{q.candle_detector_cte(P)}
SELECT 'candle' AS sink, symbol, "timestamp" AS ts, CAST(candle_votes AS INTEGER) AS votes, is_candle_anomaly AS is_anomaly
FROM scored UNION ALL
SELECT 'window', symbol, window_end, CAST(total_votes AS INTEGER), is_anomaly FROM closed""")
def dual_stream_run(spark, sf_dir):
    """Candle and window queries from one source, each with its checkpoint,
    run together until both end (the first failure stops both); the rows of
    both sinks."""
    src = scratch_path(spark, "i7-src")
    land_messages(candle_message_rows(spark, sf_dir), src)
    c_sink, c_ckpt, w_sink, w_ckpt = (scratch_path(spark, n) for n in ("i7-c", "i7-cc", "i7-w", "i7-wc"))
    qc = runner.start_file_sink(_score_candles(_stream_candles(spark, src)), c_sink, c_ckpt, fmt="parquet")
    det = wn.window_output(wn.window_detector(_window_stream(_stream_candles(spark, src)), P, volume_rule="compat"))
    qw = runner.start_file_sink(det, w_sink, w_ckpt, fmt="csv")
    runner.run_until_done(qc, qw)
    c = spark.read.parquet(c_sink)
    w = spark.read.schema(det.schema).option("header", True).csv(w_sink)
    return c.select(F.lit("candle").alias("sink"), "symbol", F.col("timestamp").alias("ts"),
                    F.col("candle_votes").cast("int").alias("votes"), F.col("is_candle_anomaly").alias("is_anomaly")).union(
        w.select(F.lit("window"), "symbol", "window_end", F.col("total_votes").cast("int"), "is_anomaly"))


class Unavailable(Exception):
    """A sink that is down."""


@register("checkpoint_resume", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(P)}
SELECT {_CANDLE_SQL_OUT} FROM scored""")
def checkpoint_resume(spark, sf_dir):
    """I8: first half of the messages; an idle restart; the second half, with a sink
    that fails after it has written its rows and before the batch is committed; a
    restart on the same checkpoint. Every candle is in the sink exactly once."""
    src, sink, ckpt = (scratch_path(spark, n) for n in ("i8-src", "i8-sink", "i8-ckpt"))
    rows = materialize(candle_rows(spark, sf_dir), "candles")
    cuts = time_cuts(rows, 2)
    cut = F.lit(cuts[0] if cuts else 0)
    down = []

    def work(batch: DataFrame, i: int) -> None:
        batches.land(batch, sink, i)
        if down and down.pop():
            raise Unavailable("after the rows were written")

    def run() -> None:
        runner.run_until_done(batches.start_batches(_score_candles(_stream_candles(spark, src)), ckpt, work))

    land_messages(candle_messages(rows.filter(F.col("close_time") < cut)), src)
    run()
    run()                                             # idle restart: adds nothing
    land_messages(candle_messages(rows.filter(F.col("close_time") >= cut)), src)
    down.append(True)
    try:
        run()
    except StreamingQueryException:
        run()                                         # the failed batch runs again, into the same folder
    return rounded(batches.landed(spark, sink, _score_candles(_stream_candles(spark, src)).schema))


@register("lookup_params_stream", sql=f"""WITH {q.candles_cte()},
cut AS (SELECT epoch_ms(min("timestamp")) + (epoch_ms(max("timestamp")) - epoch_ms(min("timestamp"))) // 2 AS ms FROM candles),
fit AS (SELECT symbol, avg("return") AS m, stddev_samp("return") AS s FROM candles WHERE symbol <> (SELECT max(symbol) FROM candles) GROUP BY symbol)
SELECT c.symbol, c."timestamp", CASE WHEN epoch_ms(c."timestamp") < cut.ms THEN {r9(f'(c."return" - {P.mean("return")}) / {P.std("return")}', 'x').rsplit(' AS', 1)[0]}
  ELSE {r9(f'(c."return" - coalesce(fit.m, {P.mean("return")})) / NULLIF(coalesce(fit.s, {P.std("return")}), 0)', 'x').rsplit(' AS', 1)[0]} END AS return_zscore
FROM candles c CROSS JOIN cut LEFT JOIN fit ON c.symbol = fit.symbol""")
def lookup_params_stream(spark, sf_dir):
    """C3 on a stream: only the default row is published at first; between two
    batches each series' own statistics follow, but for one. The second batch
    uses them, and the series that
    has none keeps the default."""
    src, sink, ckpt, root = (scratch_path(spark, n) for n in ("c3-src", "c3-sink", "c3-ckpt", "c3-params"))
    rows = materialize(candle_rows(spark, sf_dir), "candles")
    default = P.table(spark).filter(F.col("feature") == "return")
    c = materialize(candles(spark, sf_dir).select("symbol", "return"), "candles")
    fit = c.filter(F.col("symbol") != c.agg(F.max("symbol")).scalar()).groupBy("symbol").agg(
        F.avg("return").alias("mean"), F.stddev_samp("return").alias("std"))
    own = fit.select("symbol", F.lit(None).cast("string").alias("interval"), F.lit("return").alias("feature"), "mean", "std")
    versions = iter([default, default.unionByName(own)])

    def scored(batch: DataFrame) -> DataFrame:
        x = models.zscored(batch.withColumn("return", fx.return_intrabar()), root, ["return"])
        return x.select("symbol", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "return_zscore")

    def run() -> None:
        models.publish_params(next(versions), root)
        runner.run_until_done(batches.start_scored_sink(_stream_candles(spark, src), sink, ckpt, scored))

    land_in_turn(rows, src, 2, run)
    return rounded(batches.landed(spark, sink, StructType.fromDDL("symbol string, timestamp timestamp_ntz, return_zscore double")))
