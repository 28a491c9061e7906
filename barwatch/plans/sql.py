"""Oracle SQL fragments (DuckDB dialect, ANSI where possible).

Spark-side equivalents: ``bars_from_ticks`` (BARS), ``add_history_features``
(FEATS_RAW), ``feature_table`` (FEATS). Divisions use NULLIF, logarithms a
positivity guard, to match Spark's ``try_divide``/NULL semantics.
"""

from __future__ import annotations

from barwatch.functions.time import interval_label

FEATURES = ["return", "log_return", "volatility_24h", "volume_change", "volume_ratio", "price_range"]


def bars_cte(interval: str = "1 hour", name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT event_type AS symbol, '{interval_label(interval)}' AS "interval",
         time_bucket(INTERVAL '{interval}', ts) AS bar_ts,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close, sum(value) AS volume, count(*) AS trades
  FROM events GROUP BY event_type, time_bucket(INTERVAL '{interval}', ts))"""


def feats_raw_cte(src: str = "bars", name: str = "feats_raw", window_rows: int = 24) -> str:
    n = window_rows
    return f"""{name}_1 AS (
  SELECT *,
    (close - lag(close) OVER w) / NULLIF(lag(close) OVER w, 0) * 100 AS "return",
    CASE WHEN close / NULLIF(lag(close) OVER w, 0) > 0 THEN ln(close / NULLIF(lag(close) OVER w, 0)) * 100 END AS log_return,
    (volume - lag(volume) OVER w) / NULLIF(lag(volume) OVER w, 0) * 100 AS volume_change,
    (high - low) / NULLIF(close, 0) * 100 AS price_range
  FROM {src} WINDOW w AS (PARTITION BY symbol, "interval" ORDER BY bar_ts)),
{name} AS (
  SELECT *,
    CASE WHEN count("return") OVER wn = {n} THEN stddev_samp("return") OVER wn END AS volatility_24h,
    CASE WHEN count(volume) OVER wn = {n} THEN volume / NULLIF(avg(volume) OVER wn, 0) END AS volume_ratio
  FROM {name}_1
  WINDOW wn AS (PARTITION BY symbol, "interval" ORDER BY bar_ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))"""


def feats_cte(src: str = "feats_raw", name: str = "feats") -> str:
    cond = " AND ".join(f'"{f}" IS NOT NULL' for f in FEATURES)
    return f"""{name} AS (SELECT * FROM {src} WHERE {cond})"""


def with_features(interval: str = "1 hour") -> str:
    """WITH bars, feats_raw, feats."""
    return "WITH " + ",\n".join([bars_cte(interval), feats_raw_cte(), feats_cte()])


def zscore_cte(src: str = "feats", name: str = "zs", by: str = "symbol", threshold: float = 3.0,
               features=FEATURES, min_votes: int = 1, flag: str = "anomaly_zscore") -> str:
    stats = ", ".join(f'avg("{f}") AS "mean_{f}", stddev_samp("{f}") AS "std_{f}"' for f in features)
    zs = ", ".join(f'("{f}" - s."mean_{f}") / NULLIF(s."std_{f}", 0) AS "{f}_zscore"' for f in features)
    if min_votes <= 1:
        cond = " OR ".join(f'abs("{f}_zscore") > {threshold}' for f in features)
        flag_sql = f"CASE WHEN {cond} THEN 1 ELSE 0 END"
    else:
        s = " + ".join(f'CASE WHEN abs("{f}_zscore") > {threshold} THEN 1 ELSE 0 END' for f in features)
        flag_sql = f"CASE WHEN {s} >= {min_votes} THEN 1 ELSE 0 END"
    return f"""{name}_stats AS (SELECT {by}, {stats} FROM {src} GROUP BY {by}),
{name}_z AS (SELECT t.*, {zs} FROM {src} t JOIN {name}_stats s ON t.{by} IS NOT DISTINCT FROM s.{by}),
{name} AS (SELECT *, {flag_sql} AS {flag} FROM {name}_z)"""


def lit(v: float) -> str:
    return repr(float(v))


def candles_cte(interval: str = "10 minutes", name: str = "candles") -> str:
    """10-minute candles in the stream's shape: intrabar features and the
    event time ``timestamp`` = close time (start + interval - 1 ms)."""
    return f"""{bars_cte(interval, name + '_bars')},
{name} AS (
  SELECT CAST(bar_ts + INTERVAL '{interval}' - INTERVAL '1 millisecond' AS TIMESTAMP) AS "timestamp",
    symbol, "interval", bar_ts, open, high, low, close, volume, trades,
    (close - open) / NULLIF(open, 0) * 100 AS "return",
    CASE WHEN close / NULLIF(open, 0) > 0 THEN ln(close / NULLIF(open, 0)) * 100 END AS log_return,
    (high - low) / NULLIF(low, 0) * 100 AS price_range
  FROM {name}_bars)"""


def candle_detector_cte(params, src: str = "candles", name: str = "scored",
                        features=("return", "log_return", "price_range")) -> str:
    zs = ", ".join(f'("{f}" - {lit(params.mean(f))}) / {lit(params.std(f))} AS "{f}_zscore"' for f in features)
    votes = " + ".join(f'CASE WHEN abs("{f}_zscore") > {lit(params.z_threshold)} THEN 1 ELSE 0 END'
                       for f in features)
    return f"""{name}_z AS (SELECT *, {zs} FROM {src}),
{name} AS (SELECT *, {votes} AS candle_votes, ({votes}) >= {params.min_votes} AS is_candle_anomaly FROM {name}_z)"""
