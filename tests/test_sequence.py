"""Blocked windows with halo rows equal whole-series windows."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barwatch.operators import features as fe
from barwatch.operators import sequence
from barwatch.session import materialize


def _bars(spark, n=130, symbols=("a", "b")):
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for s_i, s in enumerate(symbols):
        for i in range(n):
            if i % 7 == 3:      # gaps: row-based windows must skip them
                continue
            p = 100.0 + ((i * 37 + s_i * 11) % 23) - (5 if i % 11 == 0 else 0)
            rows.append((s, "1h", t0 + dt.timedelta(hours=i), p, p + 2.0, p - 1.0, p + 0.5, 10.0 + (i % 5)))
    return spark.createDataFrame(rows, "symbol string, interval string, bar_ts timestamp_ntz, open double, "
                                       "high double, low double, close double, volume double")


def _reference(bars):
    w = Window.partitionBy("symbol", "interval").orderBy("bar_ts")
    wn = w.rowsBetween(-23, 0)
    prev = F.lag("close").over(w)
    x = bars.withColumn("return", (F.col("close") - prev) / prev * 100)
    return (x.withColumn("volatility_24h", F.when(F.count("return").over(wn) == 24, F.stddev_samp("return").over(wn)))
             .withColumn("volume_ratio", F.when(F.count("volume").over(wn) == 24,
                                                F.col("volume") / F.avg("volume").over(wn))))


def test_blocks_equal_whole_series(spark):
    bars = _bars(spark)
    got = fe.add_history_features(bars, block_rows=30).select("symbol", "bar_ts", "return", "volatility_24h",
                                                             "volume_ratio")
    exp = _reference(bars).select("symbol", "bar_ts", "return", "volatility_24h", "volume_ratio")
    a = {(r.symbol, r.bar_ts): r for r in got.collect()}
    b = {(r.symbol, r.bar_ts): r for r in exp.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in ("return", "volatility_24h", "volume_ratio"):
            x, y = a[k][c], b[k][c]
            assert (x is None and y is None) or abs(x - y) < 1e-9, (k, c, x, y)


def test_sequence_is_dense(spark):
    bars = _bars(spark)
    seq = sequence.with_sequence(bars, ["symbol"], "bar_ts", chunk_seconds=6 * 3600)
    for s in ("a", "b"):
        got = sorted(r._seq for r in seq.filter(F.col("symbol") == s).collect())
        assert got == list(range(len(got)))


def test_warmup_24_rows_per_series(spark):
    bars = _bars(spark)
    n = bars.groupBy("symbol").count().collect()
    full = fe.feature_table(bars, block_rows=30).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] - 24 for r in n} == {r.symbol: r["count"] for r in full}


def test_fill_forward_across_blocks(spark):
    rows = [("a", "1h", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 1.0 * i if i in (0, 5, 40) else None)
            for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, interval string, bar_ts timestamp_ntz, close double")
    got = {r.bar_ts: r.close for r in fe.fill_forward(df, ["close"], block_rows=8).collect()}
    for i in range(60):
        exp = 0.0 if i < 5 else (5.0 if i < 40 else 40.0)
        assert got[dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)] == exp


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_rows_are_shuffled_twice_at_most(spark, threshold):
    """Once for the numbering, once for the blocks; the offsets are broadcast, or joined on the numbering's partitions."""
    rows = [("a" if i % 3 else None, i, float(i)) for i in range(3000)]
    df = materialize(spark.createDataFrame(rows, "symbol string, t bigint, v double"), "seq-test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        x, w = sequence.blocked(df, ["symbol"], "t", halo=2, block_rows=100, chunk_seconds=50)
        out = sequence.unblock(x.withColumn("before", F.lag("v").over(w)), keep_seq=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    big = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(big) == (2 if threshold == "10m" else 3)              # without broadcast the third one moves the offsets
    got = sorted(((r.symbol or "", r["_seq"], r.before) for r in out.collect()))
    want = []
    for s in ("", "a"):
        own = [v for k, _, v in rows if (k or "") == s]
        want += [(s, i, own[i - 1] if i else None) for i in range(len(own))]
    assert got == sorted(want, key=lambda r: r[:2])
