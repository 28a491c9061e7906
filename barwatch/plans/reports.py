"""Report queries (D, F, G series) over bars, features and detector flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from barwatch.operators import features as fe
from barwatch.operators import report as rp
from barwatch.operators import stats as st
from barwatch.plans import sql as q
from barwatch.plans.batch import KEY, bars, candles, features, raw_features, zscore_flags
from barwatch.plans.catalog import r9, register, rounded, table

_ZS = f"""{q.with_features()},
{q.zscore_cte()}"""


@register("fit_feature_stats", sql=f"""{q.with_features()},
w AS (SELECT symbol, {', '.join(f'avg("{f}") AS "m_{f}", stddev_samp("{f}") AS "s_{f}"' for f in fe.FEATURES)}
      FROM feats GROUP BY symbol)
{' UNION ALL '.join(f"SELECT symbol, '{f}' AS feature, {r9(f'"m_{f}"', 'mean')}, {r9(f'"s_{f}"', 'std')} FROM w" for f in fe.FEATURES)}""")
def fit_feature_stats(spark, sf_dir):
    """Mean and sample std of all six features per symbol in one pass."""
    wide = st.fit_stats(features(spark, sf_dir), fe.FEATURES, by=["symbol"])
    return rounded(st.stats_long(wide, fe.FEATURES, by=["symbol"]))


@register("anomaly_rate", sql=f"""{_ZS}
SELECT symbol, count(*) AS total, count(*) FILTER (WHERE anomaly_zscore = 1) AS anomalies,
  count(*) - count(*) FILTER (WHERE anomaly_zscore = 1) AS normal,
  {r9('CAST(count(*) FILTER (WHERE anomaly_zscore = 1) AS DOUBLE) * 100.0 / count(*)', 'percent')}
FROM zs GROUP BY symbol""")
def anomaly_rate(spark, sf_dir):
    """Total / anomalies / normal / percent per symbol for the z-score detector."""
    return rounded(rp.anomaly_rate(zscore_flags(spark, sf_dir), "anomaly_zscore", by=["symbol"]))


_VOTES6 = " + ".join(f'CASE WHEN abs("{f}_zscore") > 3.0 THEN 1 ELSE 0 END' for f in fe.FEATURES)


@register("group_counts", sql=f"""{_ZS}
SELECT {_VOTES6} AS votes, count(*) AS "count" FROM zs GROUP BY 1""")
def group_counts(spark, sf_dir):
    """D3: number of bars per count of flagged features."""
    from barwatch.functions import flags as fl
    z = zscore_flags(spark, sf_dir)
    v = fl.votes([fl.flag_abs_gt(f"{f}_zscore", 3.0) for f in fe.FEATURES])
    return rp.group_counts(z.select(v.alias("votes")), ["votes"])


_DESC_SQL = " UNION ALL ".join(
    f"""SELECT symbol, '{f}' AS "column", count("{f}") AS "count", {r9(f'avg("{f}")', 'mean')},
  {r9(f'stddev_samp("{f}")', 'std')}, {r9(f'min("{f}")', 'min')}, {r9(f'quantile_cont("{f}", 0.25)', 'p25')},
  {r9(f'quantile_cont("{f}", 0.5)', 'p50')}, {r9(f'quantile_cont("{f}", 0.75)', 'p75')}, {r9(f'max("{f}")', 'max')}
FROM feats GROUP BY symbol""" for f in fe.FEATURES)


@register("describe_stats", sql=f"""{q.with_features()}
{_DESC_SQL}""")
def describe_stats(spark, sf_dir):
    """Count, mean, std, min, quartiles, max of every feature per symbol."""
    return rounded(rp.describe(features(spark, sf_dir), fe.FEATURES, by=["symbol"]))


@register("range_summary", sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, count(*) AS "rows", min(bar_ts) AS first_ts, max(bar_ts) AS last_ts, {r9('min(low)', 'low')},
  {r9('max(high)', 'high')}, {r9('avg(volume)', 'avg_volume')},
  CAST(date_diff('day', CAST(min(bar_ts) AS DATE), CAST(max(bar_ts) AS DATE)) AS INTEGER) AS days
FROM bars GROUP BY symbol""")
def range_summary(spark, sf_dir):
    """Rows, time span, lowest low, highest high, average volume per symbol."""
    return rounded(rp.range_summary(bars(spark, sf_dir), by=["symbol"]))


@register("null_counts", sql=f"""WITH {q.bars_cte('1 hour')}, {q.feats_raw_cte()}
SELECT {', '.join(f'count(*) FILTER (WHERE "{f}" IS NULL) AS "{f}"' for f in fe.FEATURES)},
  {' + '.join(f'count(*) FILTER (WHERE "{f}" IS NULL)' for f in fe.FEATURES)} AS total_nulls
FROM feats_raw""")
def null_counts(spark, sf_dir):
    """NULLs per feature column and in total, before cleaning."""
    return rp.null_counts(raw_features(spark, sf_dir), fe.FEATURES)


@register("threshold_mean_k_std", sql=f"""{q.with_features()},
s AS (SELECT symbol, avg(price_range) AS score_mean, stddev_samp(price_range) AS score_std FROM feats GROUP BY symbol)
SELECT s.symbol, {r9('score_mean')}, {r9('score_std')}, {r9('score_mean + 2.0 * score_std', 'threshold')},
  count(*) FILTER (WHERE f.price_range > score_mean + 2.0 * score_std) AS n_above
FROM s JOIN feats f ON f.symbol = s.symbol GROUP BY s.symbol, score_mean, score_std""")
def threshold_mean_k_std(spark, sf_dir):
    """Mu + 2 sigma of a score per symbol and how many bars exceed it."""
    from barwatch.operators.joins import keyed_join
    f = features(spark, sf_dir, keep=True)
    th = st.threshold_mean_k_std(f, "price_range", k=2.0, by=["symbol"])
    n = keyed_join(f.select("symbol", "price_range"), th.select("symbol", "threshold"), ["symbol"]) \
        .groupBy("symbol").agg(F.count_if(F.col("price_range") > F.col("threshold")).alias("n_above"))
    return rounded(keyed_join(th, n, ["symbol"]))


@register("threshold_quantile", sql=f"""{q.with_features()},
s AS (SELECT symbol, quantile_disc(volume_ratio, 0.1) AS threshold FROM feats GROUP BY symbol)
SELECT s.symbol, {r9('threshold')}, count(*) FILTER (WHERE f.volume_ratio < threshold) AS n_below
FROM s JOIN feats f ON f.symbol = s.symbol GROUP BY s.symbol, threshold""")
def threshold_quantile(spark, sf_dir):
    """10th percentile (bounded sketch) per symbol and the rows strictly below it."""
    from barwatch.operators.joins import keyed_join
    f = features(spark, sf_dir, keep=True)
    th = st.threshold_quantile(f, "volume_ratio", 0.10, by=["symbol"])
    n = keyed_join(f.select("symbol", "volume_ratio"), th, ["symbol"]) \
        .groupBy("symbol").agg(F.count_if(F.col("volume_ratio") < F.col("threshold")).alias("n_below"))
    return rounded(keyed_join(th, n, ["symbol"]))


@register("extreme_ratio", sql=f"""WITH {q.bars_cte('1 hour')},
s AS (SELECT symbol, max(volume) AS mx, avg(volume) AS mu, stddev_samp(volume) AS sd FROM bars GROUP BY symbol)
SELECT symbol, {r9('mx', 'max')}, {r9('mu', 'mean')}, {r9('sd', 'std')}, {r9('mx / NULLIF(mu, 0)', 'max_over_mean')},
  {r9('(mx - mu) / NULLIF(sd, 0)', 'max_sigmas')} FROM s""")
def extreme_ratio(spark, sf_dir):
    """max/mean and (max - mean)/std of bar volume per symbol."""
    return rounded(rp.extreme_ratio(bars(spark, sf_dir), "volume", by=["symbol"]))


@register("dedupe_by_time", sql="""SELECT event_type AS symbol, date_trunc('minute', ts) AS minute_ts,
  event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts) ORDER BY ts, event_id) = 1""")
def dedupe_by_time(spark, sf_dir):
    """One tick per (symbol, minute): the first by (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.date_trunc("minute", F.col("ts")).cast("timestamp_ntz").alias("minute_ts"), "event_id", "ts", "value")
    return rp.dedupe_first(ev, ["symbol", "minute_ts"], [F.col("ts"), F.col("event_id")])


@register("latest_per_symbol", sql=f"""{q.with_features()}
SELECT symbol, max(bar_ts) AS bar_ts, {r9('arg_max(close, bar_ts)', 'close')},
  {r9('arg_max("return", bar_ts)', 'return')} FROM feats GROUP BY symbol""")
def latest_per_symbol(spark, sf_dir):
    """Last close and return per symbol (by bar time, not file order)."""
    return rounded(rp.latest_per_group(features(spark, sf_dir), ["close", "return"], by=["symbol"]))


@register("histogram", sql=f"""{q.with_features()},
r AS (SELECT symbol, min("return") AS lo, max("return") AS hi FROM feats GROUP BY symbol),
b AS (SELECT f.symbol, lo, hi, CAST(CASE WHEN hi - lo = 0 THEN 0 ELSE least(floor((f."return" - lo) / (hi - lo) * 50), 49) END AS INTEGER) AS bin
      FROM feats f JOIN r ON f.symbol = r.symbol)
SELECT symbol, bin, count(*) AS "count", {r9('lo + (hi - lo) * bin / 50', 'bin_start')},
  {r9('lo + (hi - lo) * (bin + 1) / 50', 'bin_end')} FROM b GROUP BY symbol, bin, lo, hi""")
def histogram(spark, sf_dir):
    """50 equal-width bins of return per symbol (last edge inclusive)."""
    return rounded(rp.histogram(features(spark, sf_dir), "return", 50, by=["symbol"]))


@register("classification_metrics", sql=f"""WITH cm AS (
  SELECT CAST(quality AS DOUBLE) AS l, CAST(toxic AS DOUBLE) AS p, count(*) AS n FROM labels GROUP BY 1, 2),
pl AS (SELECT l AS c, CAST(sum(n) AS DOUBLE) AS n_label, CAST(sum(CASE WHEN l = p THEN n END) AS DOUBLE) AS tp FROM cm GROUP BY 1),
pp AS (SELECT p AS c, CAST(sum(n) AS DOUBLE) AS n_pred FROM cm GROUP BY 1),
x AS (SELECT pl.c, n_label, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred FROM pl LEFT JOIN pp ON pl.c IS NOT DISTINCT FROM pp.c),
m AS (SELECT *, coalesce(tp / NULLIF(n_pred, 0), 0.0) AS prec, tp / n_label AS rec FROM x)
SELECT {r9('sum(tp) / sum(n_label)', 'accuracy')}, {r9('sum(n_label * prec) / sum(n_label)', 'weighted_precision')},
  {r9('sum(n_label * rec) / sum(n_label)', 'weighted_recall')},
  {r9('sum(n_label * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) / sum(n_label)', 'f1')}
FROM m""")
def classification_metrics(spark, sf_dir):
    """Accuracy and weighted precision/recall/F1 (label = quality, prediction = toxic)."""
    lab = table(spark, sf_dir, "labels")
    return rounded(rp.classification_metrics(lab, "quality", "toxic"))


_PROFILE_COLS = KEY + ["open", "high", "low", "close", "volume", "trades"] + fe.FEATURES


@register("table_profile", sql=f"""{q.with_features()}
{' UNION ALL '.join(f"SELECT '{c}' AS column_name, {i + 1} AS position, count(\"{c}\") AS non_null, count(*) AS n_rows, {len(_PROFILE_COLS)} AS n_cols FROM feats" for i, c in enumerate(_PROFILE_COLS))}""")
def table_profile(spark, sf_dir):
    """Shape and per-column non-NULL counts of the feature table."""
    prof = rp.table_profile(features(spark, sf_dir).select(*_PROFILE_COLS))
    return prof.select("column_name", "position", "non_null", "n_rows", "n_cols")


@register("sort_by_time", sql=f"""WITH {q.bars_cte('1 hour')}
SELECT symbol, bar_ts, {r9('close')} FROM bars ORDER BY symbol, bar_ts""")
def sort_by_time(spark, sf_dir):
    """bars sorted by (symbol, time) — a range-partitioned sort, at the sink only."""
    return rounded(bars(spark, sf_dir).select("symbol", "bar_ts", "close").orderBy("symbol", "bar_ts"))


@register("first_n", sql=f"""{q.with_features()}
SELECT symbol, bar_ts, {r9('close')}, {r9('"return"', 'return')} FROM feats ORDER BY bar_ts, symbol LIMIT 20""")
def first_n(spark, sf_dir):
    """the first 20 feature rows in a defined order (head)."""
    f = features(spark, sf_dir).select("symbol", "bar_ts", "close", "return")
    return rounded(rp.top_k(f, [F.col("bar_ts"), F.col("symbol")], 20))


@register("recent_alerts", sql=f"""{_ZS}
SELECT symbol, bar_ts, {r9('close')}, {r9('"return"', 'return')},
  row_number() OVER (PARTITION BY symbol ORDER BY bar_ts DESC) AS "rank"
FROM zs WHERE anomaly_zscore = 1 QUALIFY "rank" <= 5""")
def recent_alerts(spark, sf_dir):
    """the 5 newest anomalies per symbol, newest first."""
    z = zscore_flags(spark, sf_dir).filter(F.col("anomaly_zscore") == 1).select("symbol", "bar_ts", "close", "return")
    return rounded(rp.top_k_per_group(z, ["symbol"], [F.col("bar_ts").desc()], 5))


@register("latest_rows", sql=f"""WITH {q.candles_cte()},
t AS (SELECT "timestamp", symbol, close, "return" FROM candles ORDER BY "timestamp" DESC, symbol DESC LIMIT 200)
SELECT "timestamp", symbol, {r9('close')}, {r9('"return"', 'return')} FROM t ORDER BY "timestamp", symbol""")
def latest_rows(spark, sf_dir):
    """F8: the last 200 candles by time, returned in ascending order."""
    c = candles(spark, sf_dir).select("timestamp", "symbol", "close", "return")
    last = rp.top_k(c, [F.col("timestamp").desc(), F.col("symbol").desc()], 200)
    return rounded(last.orderBy("timestamp", "symbol"))


@register("union_outputs", sql=f"""WITH {q.bars_cte('1 hour', 'b1')}, {q.bars_cte('10 minutes', 'b2')}
SELECT symbol, "interval", bar_ts, {r9('close')}, trades FROM b1
UNION ALL SELECT symbol, "interval", bar_ts, {r9('close')}, NULL AS trades FROM b2""")
def union_outputs(spark, sf_dir):
    """G1: concatenate partial outputs by column name, missing columns as NULL."""
    a = bars(spark, sf_dir, "1 hour").select(*KEY, "close", "trades")
    b = bars(spark, sf_dir, "10 minutes").select(*KEY, "close")
    return rounded(a.unionByName(b, allowMissingColumns=True))
