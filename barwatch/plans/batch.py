"""Batch queries over the driver tables: bars, features, z-score detector.

``bars`` is the adapter view over ``events`` (symbol = event_type, value =
trade price); everything downstream is the reference's batch pipeline,
run for all symbols at once and keyed by (symbol, interval, bar_ts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.operators import features as fe
from barwatch.operators import scoring
from barwatch.operators.bars import bars_from_ticks
from barwatch.operators.joins import keyed_join
from barwatch.plans import sql as q
from barwatch.plans.catalog import r9, register, rounded, table
from barwatch.session import materialize

KEY = ["symbol", "interval", "bar_ts"]
OHLCV = ["open", "high", "low", "close", "volume"]


def bars(spark: SparkSession, sf_dir: str, interval: str = "1 hour", keep: bool = False) -> DataFrame:
    """Bars from the tick table; ``keep`` writes them once to the shared
    checkpoint folder when several branches will read them."""
    b = bars_from_ticks(table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"),
                        interval)
    return materialize(b) if keep else b


def raw_features(spark: SparkSession, sf_dir: str, interval: str = "1 hour") -> DataFrame:
    """Six features with warm-up NULLs kept (bars materialised: the row
    numbering reads them twice)."""
    return fe.add_history_features(bars(spark, sf_dir, interval, keep=True))


def features(spark: SparkSession, sf_dir: str, interval: str = "1 hour", keep: bool = False) -> DataFrame:
    f = fe.drop_incomplete(raw_features(spark, sf_dir, interval))
    return materialize(f) if keep else f


def zscore_flags(spark: SparkSession, sf_dir: str, feats: DataFrame | None = None) -> DataFrame:
    """K7 over the feature table (pass ``feats`` to reuse a materialised one)."""
    f = feats if feats is not None else features(spark, sf_dir, keep=True)
    return scoring.zscore_detector(f, fe.FEATURES, by=["symbol"])


def _cols_sql(cols):
    return ", ".join(r9(f'"{c}"', c) if c not in ("symbol", "interval", "bar_ts", "trades") else f'"{c}"'
                     for c in cols)


# --- support: the tick -> bar adapter ---------------------------------------

@register("bars_1h", sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, "interval", bar_ts, {_cols_sql(OHLCV)}, trades FROM bars""")
def bars_1h(spark, sf_dir):
    """One-hour OHLCV bars per event type (the adapter every batch query reads)."""
    return rounded(bars(spark, sf_dir))


# --- E6 feature table and slice-1 detector ----------------------------------

FEATURE_COLS = KEY + OHLCV + ["trades"] + fe.FEATURES


@register("feature_table", sql=f"""{q.with_features()}
SELECT {_cols_sql(FEATURE_COLS)} FROM feats""")
def feature_table(spark, sf_dir):
    """Six features per bar, 24 warm-up rows dropped per series."""
    return rounded(features(spark, sf_dir).select(*FEATURE_COLS))


ZSCORE_COLS = KEY + ["close", "return", "volume_change", "volatility_24h"] + \
    [f"{f}_zscore" for f in fe.FEATURES] + ["anomaly_zscore"]


@register("zscore_detector", sql=f"""{q.with_features()},
{q.zscore_cte()}
SELECT {_cols_sql(ZSCORE_COLS[:-1])}, anomaly_zscore FROM zs""")
def zscore_detector(spark, sf_dir):
    """K7: per-symbol mean/std, |z| > 3 in any of the six features."""
    return rounded(zscore_flags(spark, sf_dir).select(*ZSCORE_COLS))


# --- B1-B4: intrabar expressions ---------------------------------------------

from barwatch.functions import features as fx  # noqa: E402
from barwatch.functions import flags as fl  # noqa: E402
from barwatch.functions import time as tm  # noqa: E402
from barwatch.operators import stats as st  # noqa: E402
from barwatch.sources import params as pm  # noqa: E402

_INTRABAR = {
    "feat_return_intrabar": (lambda: fx.return_intrabar(), "(close - open) / NULLIF(open, 0) * 100"),
    "feat_price_range_low": (lambda: fx.price_range_low(), "(high - low) / NULLIF(low, 0) * 100"),
    "feat_log_return_intrabar": (lambda: fx.log_return_intrabar(),
                                 "CASE WHEN close / NULLIF(open, 0) > 0 THEN ln(close / NULLIF(open, 0)) * 100 END"),
    "feat_price_range_close": (lambda: fx.price_range_close(), "(high - low) / NULLIF(close, 0) * 100"),
}


def _intrabar_query(name, build):
    def fn(spark, sf_dir):
        return rounded(bars(spark, sf_dir).select(*KEY, build().alias("value")))
    fn.__doc__ = f"{name}: per-bar expression over 1 h bars."
    return fn


for _name, (_build, _sql) in _INTRABAR.items():
    register(_name, sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, "interval", bar_ts, {r9(_sql, 'value')} FROM bars""")(_intrabar_query(_name, _build))


# --- E1-E5: history features with warm-up NULLs kept --------------------------

_HISTORY = {
    "feat_return_prev_close": "return",
    "feat_log_return_prev_close": "log_return",
    "feat_volatility_24": "volatility_24h",
    "feat_volume_change": "volume_change",
    "feat_volume_ratio_24": "volume_ratio",
}


def _history_query(name, col):
    def fn(spark, sf_dir):
        return rounded(raw_features(spark, sf_dir).select(*KEY, F.col(col).alias("value")))
    fn.__doc__ = f"{name}: {col} over lag/rolling-24 frames, NULL during warm-up."
    return fn


for _name, _col in _HISTORY.items():
    register(_name, sql=f"""WITH {q.bars_cte('1 hour')}, {q.feats_raw_cte()}
SELECT symbol, "interval", bar_ts, {r9(f'"{_col}"', 'value')} FROM feats_raw""")(_history_query(_name, _col))


# --- E7/E8: fill strategies, E9 self z-score, E10 row number ------------------

def _holey_bars(spark, sf_dir):
    """1 h bars on a complete hourly grid per symbol: hours without ticks get
    NULL prices (the gaps the fill strategies are for)."""
    b = bars(spark, sf_dir, keep=True)
    span = b.groupBy("symbol", "interval").agg(F.min("bar_ts").alias("t0"), F.max("bar_ts").alias("t1"))
    # Two-level grid (days, then 24 hours) so no single row holds a whole
    # series' worth of timestamps.
    days = span.select("symbol", "interval", "t0", "t1",
                       F.explode(F.sequence(F.to_date("t0"), F.to_date("t1"))).alias("day"))
    hours = days.select("symbol", "interval", "t0", "t1",
                        F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"), "day")
    grid = hours.select("symbol", "interval", "t0", "t1",
                        (F.col("day").cast("timestamp_ntz") + F.make_interval(hours=F.col("h"))).alias("bar_ts")) \
                .filter((F.col("bar_ts") >= F.col("t0")) & (F.col("bar_ts") <= F.col("t1"))) \
                .select("symbol", "interval", "bar_ts")
    return keyed_join(grid, b.select(*KEY, "close", "volume"), KEY, "left")


_GRID_SQL = f"""WITH {q.bars_cte('1 hour')},
span AS (SELECT symbol, "interval", min(bar_ts) AS t0, max(bar_ts) AS t1 FROM bars GROUP BY 1, 2),
grid AS (SELECT symbol, "interval", unnest(generate_series(t0, t1, INTERVAL 1 HOUR)) AS bar_ts FROM span),
holey AS (SELECT g.symbol, g."interval", g.bar_ts, b.close, b.volume FROM grid g
          LEFT JOIN bars b ON g.symbol = b.symbol AND g.bar_ts = b.bar_ts)"""


@register("fill_forward", sql=f"""{_GRID_SQL}
SELECT symbol, "interval", bar_ts,
  {r9('last_value(close IGNORE NULLS) OVER (PARTITION BY symbol, "interval" ORDER BY bar_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'close')},
  {r9('last_value(volume IGNORE NULLS) OVER (PARTITION BY symbol, "interval" ORDER BY bar_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'volume')}
FROM holey""")
def fill_forward_q(spark, sf_dir):
    """Forward-fill close/volume over the hourly grid (blocked, exact)."""
    return rounded(fe.fill_forward(_holey_bars(spark, sf_dir), ["close", "volume"]).select(*KEY, "close", "volume"))


@register("fill_mean", sql=f"""{_GRID_SQL}
SELECT symbol, "interval", bar_ts,
  {r9('coalesce(close, avg(close) OVER (PARTITION BY symbol))', 'close')},
  {r9('coalesce(volume, avg(volume) OVER (PARTITION BY symbol))', 'volume')}
FROM holey""")
def fill_mean_q(spark, sf_dir):
    """Fill gaps with the symbol mean (aggregate + join, no whole-series window)."""
    return rounded(fe.fill_mean(_holey_bars(spark, sf_dir), ["close", "volume"]).select(*KEY, "close", "volume"))


@register("batch_zscore_self", sql=f"""{q.with_features()},
s AS (SELECT symbol, avg("return") AS mu, stddev_samp("return") AS sd FROM feats GROUP BY symbol),
z AS (SELECT f.symbol, f."interval", f.bar_ts, f."return", (f."return" - s.mu) / NULLIF(s.sd, 0) AS return_zscore
      FROM feats f JOIN s ON f.symbol = s.symbol)
SELECT symbol, "interval", bar_ts, {r9('"return"', 'return')}, {r9('return_zscore')},
  CASE WHEN abs(return_zscore) > 3.0 THEN 1 ELSE 0 END AS is_anomaly FROM z""")
def batch_zscore_self(spark, sf_dir):
    """Z of returns against the symbol's own mean/std, |z| > 3 flag."""
    f = features(spark, sf_dir, keep=True).select(*KEY, "return")
    return rounded(st.self_zscore(f, "return", by=["symbol"], threshold=3.0))


@register("row_number_key", sql=f"""{q.with_features()}
SELECT symbol, "interval", bar_ts, row_number() OVER (PARTITION BY symbol, "interval" ORDER BY bar_ts) AS row_id
FROM feats""")
def row_number_key_q(spark, sf_dir):
    """Consecutive 1-based row number per series after cleaning."""
    f = features(spark, sf_dir, keep=True)
    return fe.row_number_key(f.select(*KEY)).select(*KEY, F.col("row_id").cast("long").alias("row_id"))


# --- B5-B9: pinned-parameter candle scoring (stream rules, batch form) -------

CANDLE_INTERVAL = "10 minutes"
CANDLE_FEATURES = ["return", "log_return", "price_range"]
CANDLE_OUT = ["timestamp", "symbol", "open", "high", "low", "close", "volume", "return", "log_return",
              "price_range", "return_zscore", "log_return_zscore", "price_range_zscore", "candle_votes",
              "is_candle_anomaly"]


def candles(spark: SparkSession, sf_dir: str, interval: str = CANDLE_INTERVAL) -> DataFrame:
    """Candles in the stream's shape from 10-minute bars (intrabar features,
    event time = close time)."""
    b = bars(spark, sf_dir, interval)
    step_ms = _interval_ms(interval)
    close_ms = tm.ts_to_ms(F.col("bar_ts")) + F.lit(step_ms - 1)
    return (b.withColumn("timestamp", tm.ms_to_ts_ntz(close_ms))
             .withColumn("return", fx.return_intrabar())
             .withColumn("log_return", fx.log_return_intrabar())
             .withColumn("price_range", fx.price_range_low()))


def _interval_ms(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")]
    return int(n) * mult


_CANDLE_SQL_OUT = ", ".join(
    (r9(f'"{c}"', c) if c not in ("timestamp", "symbol", "candle_votes", "is_candle_anomaly") else f'"{c}"')
    for c in CANDLE_OUT)


@register("zscore_given_params", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(pm.Params())}
SELECT "timestamp", symbol, {r9('return_zscore')}, {r9('log_return_zscore')}, {r9('price_range_zscore')} FROM scored""")
def zscore_given_params_q(spark, sf_dir):
    """Z-scores of intrabar features against the fallback (pinned) parameters."""
    c = scoring.zscore_given_params(candles(spark, sf_dir), CANDLE_FEATURES, pm.Params())
    return rounded(c.select("timestamp", "symbol", *[f"{f}_zscore" for f in CANDLE_FEATURES]))


@register("candle_detector", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(pm.Params())}
SELECT {_CANDLE_SQL_OUT} FROM scored""")
def candle_detector_q(spark, sf_dir):
    """I5 batch form (B1-B3, B5, B6, B8, B9): per-candle votes, pinned parameters."""
    return rounded(scoring.candle_detector(candles(spark, sf_dir), pm.Params()).select(*CANDLE_OUT))


@register("flag_abs_gt", sql=f"""{q.with_features()},
{q.zscore_cte()}
SELECT symbol, "interval", bar_ts,
  {', '.join(f'CASE WHEN abs("{f}_zscore") > 3.0 THEN 1 ELSE 0 END AS "anomaly_{f}"' for f in fe.FEATURES)}
FROM zs""")
def flag_abs_gt_q(spark, sf_dir):
    """One strict |z| > 3 flag per feature (NULL z -> 0)."""
    z = zscore_flags(spark, sf_dir)
    return z.select(*KEY, *[fl.flag_abs_gt(f"{f}_zscore", 3.0).alias(f"anomaly_{f}") for f in fe.FEATURES])


_VOTES_SQL = " + ".join(f'CASE WHEN abs("{f}_zscore") > 3.0 THEN 1 ELSE 0 END' for f in fe.FEATURES)


@register("votes_sum", sql=f"""{q.with_features()},
{q.zscore_cte()}
SELECT symbol, "interval", bar_ts, {_VOTES_SQL} AS votes, ({_VOTES_SQL}) >= 2 AS is_anomaly FROM zs""")
def votes_sum_q(spark, sf_dir):
    """Per-bar count of flagged features and the >= 2 rule."""
    z = zscore_flags(spark, sf_dir)
    v = fl.votes([fl.flag_abs_gt(f"{f}_zscore", 3.0) for f in fe.FEATURES])
    return z.select(*KEY, v.alias("votes"), fl.min_votes(v, 2).alias("is_anomaly"))


@register("filter_anomalies", sql=f"""{q.with_features()},
{q.zscore_cte()}
SELECT symbol, bar_ts AS "timestamp", {r9('close')}, {r9('"return"', 'return')}, {r9('return_zscore')},
  {r9('volume_change')}, {r9('volume_change_zscore')} FROM zs WHERE anomaly_zscore = 1""")
def filter_anomalies_q(spark, sf_dir):
    """Flagged rows with the context projection."""
    z = zscore_flags(spark, sf_dir).filter(F.col("anomaly_zscore") == 1)
    return rounded(z.select("symbol", F.col("bar_ts").alias("timestamp"), "close", "return", "return_zscore",
                            "volume_change", "volume_change_zscore"))


@register("drop_incomplete", sql=f"""WITH {q.bars_cte('1 hour')}, {q.feats_raw_cte()}
SELECT symbol, count(*) AS rows_before,
  count(*) FILTER (WHERE {' AND '.join(f'"{f}" IS NOT NULL' for f in fe.FEATURES)}) AS rows_after,
  count(*) FILTER (WHERE NOT ({' AND '.join(f'"{f}" IS NOT NULL' for f in fe.FEATURES)})) AS rows_removed
FROM feats_raw GROUP BY symbol""")
def drop_incomplete_q(spark, sf_dir):
    """Rows before/after removing incomplete feature rows, per symbol."""
    raw = raw_features(spark, sf_dir)
    complete = F.lit(True)
    for f in fe.FEATURES:
        complete = complete & F.col(f).isNotNull()
    return raw.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows_before"),
                                     F.count_if(complete).alias("rows_after"),
                                     F.count_if(~complete).alias("rows_removed"))


@register("sigma_bands", sql=f"""{q.with_features()}
SELECT symbol, {r9('avg("return")', 'mean')}, {r9('stddev_samp("return")', 'std')},
  {r9('avg("return") - 3 * stddev_samp("return")', 'lower')},
  {r9('avg("return") + 3 * stddev_samp("return")', 'upper')}
FROM feats GROUP BY symbol""")
def sigma_bands_q(spark, sf_dir):
    """Mean and mean +/- 3 sigma of return per symbol."""
    return rounded(st.sigma_bands(features(spark, sf_dir), "return", by=["symbol"], k=3.0))


@register("cast_rename_project", sql=f"""{q.with_features()},
{q.zscore_cte()}
SELECT symbol, bar_ts AS "timestamp", {r9('close')}, {r9('"return"', 'return')}, {r9('volume_change')},
  {r9('volatility_24h')}, CAST(anomaly_zscore AS INTEGER) AS anomaly_zscore,
  CAST(anomaly_zscore AS DOUBLE) AS label FROM zs""")
def cast_rename_project_q(spark, sf_dir):
    """Detector output shaping — rename, integer flag, double label."""
    z = zscore_flags(spark, sf_dir)
    return rounded(z.select("symbol", F.col("bar_ts").alias("timestamp"), "close", "return", "volume_change",
                            "volatility_24h", F.col("anomaly_zscore").cast("int").alias("anomaly_zscore"),
                            F.col("anomaly_zscore").cast("double").alias("label")))


@register("epoch_ms_to_ts", sql=f"""WITH {q.bars_cte('1 hour')},
ms AS (SELECT symbol, bar_ts, epoch_ms(bar_ts) AS open_time,
              epoch_ms(bar_ts) + 3600000 - 1 AS close_time FROM bars)
SELECT symbol, open_time, close_time,
  CAST(make_timestamp(close_time * 1000) AS TIMESTAMP) AS "timestamp",
  strftime(make_timestamp(open_time * 1000), '%Y-%m-%dT%H:%M:%S.%g') AS "datetime"
FROM ms""")
def epoch_ms_to_ts_q(spark, sf_dir):
    """Ms epoch <-> timestamp <-> ISO text round trip on bar times."""
    b = bars(spark, sf_dir).select("symbol", tm.ts_to_ms(F.col("bar_ts")).alias("open_time"))
    b = b.withColumn("close_time", F.col("open_time") + F.lit(3_600_000 - 1))
    return b.select("symbol", "open_time", "close_time",
                    tm.ms_to_ts_ntz(F.col("close_time")).alias("timestamp"),
                    tm.ms_to_iso(F.col("open_time")).alias("datetime"))


@register("time_range_filter", sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, "interval", bar_ts, {r9('close')} FROM bars
WHERE bar_ts >= TIMESTAMP '2024-01-23 00:00:00' AND bar_ts < TIMESTAMP '2024-01-30 00:00:00'""")
def time_range_filter_q(spark, sf_dir):
    """Keep bars with start <= bar_ts < end (a 7-day collection window);
    the tick-time predicate reaches the parquet scan."""
    ev = table(spark, sf_dir, "events").filter(
        (F.col("ts") >= F.lit("2024-01-23 00:00:00").cast("timestamp_ntz"))
        & (F.col("ts") < F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")))
    b = bars_from_ticks(ev.select("event_id", "ts", "event_type", "value"), "1 hour")
    return rounded(b.select(*KEY, "close"))


@register("lookup_params", sql=f"""WITH {q.candles_cte()},
p AS (SELECT * FROM (VALUES ('click', 0.5, 50.0), ('view', 1.0, 40.0)) AS t(symbol, mean_return, std_return))
SELECT c.symbol, c."timestamp",
  {r9('(c."return" - coalesce(p.mean_return, 0.0034)) / NULLIF(coalesce(p.std_return, 0.3741), 0)', 'return_zscore')}
FROM candles c LEFT JOIN p ON c.symbol = p.symbol""")
def lookup_params_q(spark, sf_dir):
    """Per-symbol parameter rows with a default row for other symbols."""
    default = pm.Params().table(spark).filter(F.col("feature") == "return")
    specific = spark.createDataFrame([("click", None, "return", 0.5, 50.0), ("view", None, "return", 1.0, 40.0)],
                                     pm.PARAMS_SCHEMA)
    c = candles(spark, sf_dir)
    x = scoring.with_params_table(c, default.unionByName(specific), ["return"], keys=["symbol"])
    x = scoring.zscore_columns(x, ["return"])
    return rounded(x.select("symbol", "timestamp", "return_zscore"))


@register("flag_any_feature", sql=f"""{q.with_features()},
{q.zscore_cte()}
SELECT symbol, "interval", bar_ts, anomaly_zscore AS any_feature FROM zs""")
def flag_any_feature(spark, sf_dir):
    """1 when any feature's |z| exceeds the threshold."""
    f = features(spark, sf_dir, keep=True)
    x = scoring.zscore_columns(st.attach(f, st.fit_stats(f, fe.FEATURES).drop("n"), ["symbol"]), fe.FEATURES)
    flag = fl.any_condition([F.abs(F.col(f"{c}_zscore")) > 3.0 for c in fe.FEATURES])
    return x.select("symbol", "interval", "bar_ts", flag.alias("any_feature"))


@register("flag_min_votes", sql=f"""WITH {q.candles_cte()}, {q.candle_detector_cte(pm.Params())}
SELECT symbol, "timestamp", CAST(candle_votes AS INTEGER) AS votes, candle_votes >= 2 AS flagged FROM scored""")
def flag_min_votes(spark, sf_dir):
    """True when at least two of the votes are raised."""
    c = scoring.candle_detector(candles(spark, sf_dir), pm.Params())
    return c.select("symbol", "timestamp", F.col("candle_votes").cast("int").alias("votes"),
                    fl.min_votes("candle_votes", 2).alias("flagged"))
