"""Storage, stream and bad-record behaviour that a result must never hide."""

import json
import warnings

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barwatch.operators import report, sequence, stats
from barwatch.session import checkpoint_root, freed_shuffles, materialize, path_exists, scratch_path, scratch_scope
from barwatch.sources import files as fs
from barwatch.sources import kline as kl
from barwatch.sources import params as pm
from barwatch.streaming import runner
from barwatch.streaming.windows import sliding_window_stats


def test_time_limit_raises_instead_of_returning_a_partial_sink(spark):
    rows = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = runner.start_file_sink(rows, scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt"),
                               trigger={"processingTime": "1 second"})
    with pytest.raises(TimeoutError):
        runner.run_until_done(q, timeout_s=3)
    assert not q.isActive


def test_a_failing_query_stops_the_others(spark):
    rows = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    ok = runner.start_file_sink(rows, scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt"),
                                trigger={"processingTime": "1 second"})
    bad = runner.start_file_sink(rows.withColumn("x", F.raise_error(F.lit("boom"))), scratch_path(spark, "t-sink"),
                                 scratch_path(spark, "t-ckpt"), trigger={"processingTime": "1 second"})
    with pytest.raises(Exception, match="boom"):
        runner.run_until_done(ok, bad)
    assert not ok.isActive and not bad.isActive


def test_shared_folder_is_required_off_local():
    class Context:
        master = "spark://somewhere:1"

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        class O:
                            @staticmethod
                            def isDefined():
                                return False
                        return O
                return S

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


SCHEMA = fs.StructType([fs.StructField("symbol", fs.StringType()), fs.StructField("timestamp", fs.TimestampNTZType()),
                        fs.StructField("close", fs.DoubleType())])


def test_latest_output_listing(spark, tmp_path):
    with pytest.raises(AnalysisException):
        fs.latest_output(spark, str(tmp_path / "missing"), SCHEMA)
    (tmp_path / "d").mkdir()
    assert fs.latest_output(spark, str(tmp_path / "d"), SCHEMA).count() == 0
    head = "symbol,timestamp,close\n"
    import os
    (tmp_path / "d" / "part-0.csv").write_text(head + "a,2024-01-01 00:00:00,1\na,2024-01-01 00:01:00,2,extra\na,never,3\n"
                                               "b,2024-01-01 00:00:00\n")
    (tmp_path / "d" / "part-1.csv").write_text(head)
    os.utime(tmp_path / "d" / "part-0.csv", (1, 1))
    got = fs.latest_output(spark, f"file://{tmp_path}/d", SCHEMA).collect()
    assert [(r.symbol, r.close) for r in got] == [("a", 1.0), ("b", None)]
    # A newer file with only a header counts as the newest file.
    assert fs.latest_output(spark, str(tmp_path / "d"), SCHEMA, n_files=1).count() == 0
    assert [r.symbol for r in fs.latest_output(spark, str(tmp_path / "d"), SCHEMA, n_rows=1).collect()] == ["a"]


def test_load_params_warns_or_raises(spark, tmp_path):
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert pm.load_params(spark, [str(tmp_path / "none.json")]).z_threshold == pm.FALLBACK_Z_THRESHOLD
    assert any("fallback" in str(x.message) for x in w)
    (tmp_path / "p.json").write_text(json.dumps({"zscore": {"threshold": 2.5}}, indent=1))
    assert pm.load_params(spark, [str(tmp_path / "none.json"), f"file://{tmp_path}/p.json"]).z_threshold == 2.5
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(ValueError):
        pm.load_params(spark, str(tmp_path / "bad.json"))


def test_rows_with_a_null_time_stay(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", 5, 2.0), (None, 7, 3.0)], "symbol string, t bigint, v double")
    assert sequence.with_sequence(df, ["symbol"], "t").count() == 3


def test_bad_pages_and_messages(spark):
    pages = spark.createDataFrame([("a", json.dumps([["1704067200000", "1", "2", "0.5", "NaN", "9"],
                                                     ["1704067200000", "1", "2", "x", "1.5", "9"],
                                                     ["1704067200000", "1"], ["9" * 19, "1", "2", "1", "1", "1"]]))],
                                  "symbol string, page string")
    good = kl.klines_from_pages(pages).collect()
    assert [(r.close, r.low) for r in good] == [(1.5, None)]
    kept = kl.klines_from_pages(pages, keep_invalid=True)
    assert kept.count() == 4 and kept.filter("NOT _valid").count() == 3
    msgs = spark.createDataFrame([(json.dumps({"symbol": "a", "close_time": 9 * 10 ** 18}),), ("{",),
                                  (json.dumps({"symbol": "a", "close_time": 1704067200000, "close": 1.0}),)], "value string")
    assert kl.decode_candles(msgs).count() == 1
    nan = spark.createDataFrame([(json.dumps({"e": "kline", "s": "A", "k": {"t": 1704067200000, "T": 1704067259999, "i": "1m",
                                  "o": "NaN", "h": "1", "l": "1", "c": "1", "v": "1", "q": "1", "n": 1, "x": True,
                                  "V": "1", "Q": "1"}}),)], "value string")
    assert kl.normalize_klines(nan).first()["open"] is None


def test_huge_volume_has_an_average(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00", 1e30, 1.0, 0.1, 0.2), ("a", "2024-01-01 00:10:00", 3e30, 1.0, 0.1, 0.2)],
                               "symbol string, ts string, volume double, close double, return double, price_range double") \
              .withColumn("timestamp", F.to_timestamp("ts"))
    assert sliding_window_stats(df, slide="1 hour").first()["avg_volume"] == pytest.approx(2e30)


def test_exact_quantiles_and_sketch_error(spark):
    n = 250_000
    df = spark.range(n).select(F.lit("a").alias("symbol"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    q = report.exact_quantiles(df, ["v"], ["symbol"], [0.25, 0.5, 0.75]).first()["q"]
    assert q == [(n - 1) * p for p in (0.25, 0.5, 0.75)]
    got = stats.threshold_quantile(df, "v", 0.1, accuracy=1000).first()["threshold"]
    assert abs(got - 0.1 * n) <= n / 1000 + 1


def test_statistics_join_leaves_the_big_side_in_place(spark):
    df = spark.range(200_000).select((F.col("id") % 3).cast("string").alias("symbol"), F.rand(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        plan = stats.self_zscore(df, "v")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_scratch_folders_go_with_their_scope(spark):
    out = scratch_path(spark, "stays")
    with pytest.raises(ValueError):
        with scratch_scope(spark):
            inner = materialize(spark.range(5), "goes")
            path = inner.inputFiles()[0].rsplit("/", 1)[0]
            inner.write.parquet(out)
            with scratch_scope(spark):
                nested = scratch_path(spark, "nested")
                spark.range(1).write.parquet(nested)
            assert not path_exists(spark, nested) and path_exists(spark, path)
            raise ValueError
    assert not path_exists(spark, path) and spark.read.parquet(out).count() == 5


def test_one_off_writes_give_the_setting_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with freed_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert materialize(df).count() == 7 and materialize(df).count() == 7 and df.count() == 7      # the frame itself stays usable


def test_entry_works_without_the_optional_parts(tmp_path):
    import pathlib
    import shutil
    import subprocess
    import sys
    root = pathlib.Path(__file__).resolve().parent.parent
    shutil.copytree(root / "barwatch", tmp_path / "barwatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'zscore_detector' in q and not any(n.startswith('op1') for n in q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120,
                          env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    assert done.returncode == 0 and int(done.stdout) > 90, done.stderr


def test_topic_sink_hands_over_keyed_messages(spark, tmp_path):
    """The topic writer with a file sink in the connector's place."""
    src, ckpt, out = (scratch_path(spark, n) for n in ("k-src", "k-ckpt", "k-out"))
    msg = {"symbol": "a", "interval": "1m", "close_time": 1704067259999, "close": 1.5}
    spark.createDataFrame([(json.dumps(msg),)], "value string").write.text(src)
    runner.run_until_done(runner.start_kafka_sink(runner.decoded_stream(spark, src), "topic", "nowhere", ckpt, fmt="parquet", path=out))
    got = spark.read.parquet(out).first()
    assert got.key == "a" and json.loads(got.value)["close"] == 1.5
