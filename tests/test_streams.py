"""Batch-wise sinks, change logs, published models and parameters, triggers, state stores."""

import json
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from barwatch.operators.detectors import distance_to_own_center, vector_columns
from barwatch.plans import streams
from barwatch.plans.streams import land_messages
from barwatch.session import path_exists, scratch_path, use_state_store
from barwatch.sources import files as fs
from barwatch.sources import kline as kl
from barwatch.sources import params as pm
from barwatch.sources import store
from barwatch.streaming import batches, models, runner
from barwatch.streaming.windows import window_detector
from tests.conftest import SF_SMALL

MINUTE = 60_000
START = 1704067200000


def candle(symbol, minute, close=100.0, **more):
    return json.dumps({"symbol": symbol, "interval": "1m", "open_time": START + minute * MINUTE, "close_time": START + (minute + 1) * MINUTE - 1,
                       "open": 100.0, "high": close + 1, "low": close - 1, "close": close, "volume": 5.0, "trades": 3, "is_closed": True} | more)


def messages(spark, values, src):
    land_messages(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), src)


def folders(spark, *names):
    return [scratch_path(spark, n) for n in names]


class Down(Exception):
    pass


# --- versions ---------------------------------------------------------------------

def test_a_version_is_whole_or_absent(spark):
    root, = folders(spark, "versions")
    assert store.published(spark, root) is None
    write = lambda n: lambda path: spark.range(n).write.parquet(path)
    assert [store.publish(spark, root, write(n)) for n in (1, 2)] == [1, 2]

    def dies(path):
        spark.range(9).write.parquet(path)
        raise Down()
    with pytest.raises(Down):
        store.publish(spark, root, dies)
    assert spark.read.parquet(store.published(spark, root)).count() == 2
    assert spark.read.parquet(store.published(spark, root, 1)).count() == 1
    assert store.publish(spark, root, write(3)) == 3 and spark.read.parquet(store.published(spark, root)).count() == 3


# --- A5, A6: dead letter ------------------------------------------------------------

def test_good_and_dead_are_the_input_also_after_a_replay(spark, monkeypatch):
    src, good, dead, ckpt = folders(spark, "src", "good", "dead", "ckpt")
    bad = ["{", "", json.dumps({"close_time": START}), json.dumps({"symbol": "a"}), "[1]", json.dumps({"symbol": "a", "close_time": 9 * 10 ** 18})]
    messages(spark, [candle("a", i) for i in range(5)] + bad[:3], src)
    run = lambda: runner.run_until_done(batches.start_candles_with_dead_letter(runner.candle_stream(spark, src), good, dead, ckpt))
    run()
    messages(spark, [candle("b", i) for i in range(4)] + bad[3:], src)
    real = batches.land

    def fails(batch, path, i):
        real(batch, path, i)
        if path == dead:
            raise Down()
    monkeypatch.setattr(batches, "land", fails)
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(batches, "land", real)
    run()
    g = batches.landed(spark, good, fs.StructType.fromDDL("symbol string, close_time long"))
    d = batches.landed(spark, dead, fs.StructType.fromDDL("raw string, reason string"))
    assert g.groupBy("symbol").count().collect() and sorted((r.symbol, r["count"]) for r in g.groupBy("symbol").count().collect()) == [("a", 5), ("b", 4)]
    assert sorted(r.raw for r in d.collect()) == sorted(bad)
    assert {r.raw: r.reason for r in d.collect()} == {"{": "no JSON", "": "no JSON", bad[2]: "no symbol", bad[3]: "no close time",
                                                      "[1]": "no symbol", bad[5]: "no close time"}


def test_no_batch_gives_no_rows(spark):
    good, = folders(spark, "none")
    assert batches.landed(spark, good, fs.StructType.fromDDL("symbol string")).count() == 0
    assert batches.latest(spark, good, ["symbol"], fs.StructType.fromDDL("symbol string")).count() == 0


def test_every_envelope_has_a_status(spark):
    k = {"t": START, "T": START + MINUTE - 1, "i": "1m", "o": "1", "h": "1", "l": "1", "c": "1", "v": "1", "q": "1", "n": 1, "x": True, "V": "1", "Q": "1"}
    rows = {"candle": [{"e": "kline", "s": "A", "k": k}, {"stream": "s", "data": {"e": "kline", "s": "A", "k": k}}],
            "ignored": [{"e": "trade", "s": "A"}, {"e": "kline", "s": "A", "k": k | {"x": False}}],
            "invalid": [{"e": "kline", "k": k}, {"e": "kline", "s": "A", "k": {x: v for x, v in k.items() if x != "T"}}, {"s": "A"}]}
    texts = [(json.dumps(v), s) for s, vs in rows.items() for v in vs] + [("{", "invalid"), ("", "invalid")]
    df = spark.createDataFrame([(t,) for t, _ in texts], "value string")
    got = kl.normalize_klines(df, keep_invalid=True).collect()
    assert sorted((r["_raw"], r["_status"]) for r in got) == sorted(texts)
    assert kl.normalize_klines(df).filter("symbol = 'A' AND close_time IS NOT NULL").count() == 2


# --- I3: change log -----------------------------------------------------------------

def counts_of(spark, src):
    return runner.decoded_stream(spark, src, max_files_per_trigger=1).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.max("close").alias("top"))


@pytest.mark.parametrize("kind", ["memory", "rocksdb"])
def test_change_log_stays_bounded_and_bears_a_replay(spark, kind):
    src, sink, ckpt = folders(spark, "src", "log", "ckpt")
    use_state_store(spark, kind)
    try:
        for i in range(20):
            messages(spark, [candle(s, i, 100.0 + i) for s in ("a", "b") if s == "a" or i % 3 == 0], src)
        stream = counts_of(spark, src)
        schema = stream.schema
        runner.run_until_done(batches.start_update_log(stream, sink, ckpt, ["symbol"], compact_every=4))
        current = lambda: sorted(map(tuple, batches.latest(spark, sink, ["symbol"], schema).collect()))
        want = [("a", 20, 119.0), ("b", 7, 118.0)]
        assert current() == want
        assert len(store.names_in(spark, f"{sink}/snapshots")) <= 2 and len(store.names_in(spark, f"{sink}/deltas")) <= 8
        last = max(int(n.split("=")[1]) for n in store.names_in(spark, f"{sink}/deltas"))
        again = spark.read.parquet(f"{sink}/deltas/batch={last}").collect()
        spark.createDataFrame(again, schema).write.mode("overwrite").parquet(f"{sink}/deltas/batch={last}")      # the batch runs again
        old = spark.createDataFrame([("a", 1, 1.0)], schema)
        old.write.mode("overwrite").parquet(f"{sink}/deltas/batch=0")                                             # one that a snapshot holds
        assert current() == want
        spark.createDataFrame([("x", 1, 1.0)], schema).write.parquet(f"{sink}/snapshots/upto=99")
        store.remove(spark, f"{sink}/snapshots/upto=99/_SUCCESS")                                                 # an unfinished snapshot
        assert current() == want
        if kind == "rocksdb":
            state = [f for f in _below(spark, f"{ckpt}/state") if f.endswith((".zip", ".changelog"))]
            assert state
    finally:
        use_state_store(spark, "memory")


def _below(spark, path):
    out = []
    for n in store.names_in(spark, path):
        p = f"{path}/{n}"
        out += [p] if "." in n else _below(spark, p)
    return out


def test_state_store_names():
    from barwatch.session import STATE_STORES
    assert set(STATE_STORES) == {"memory", "rocksdb"}
    with pytest.raises(ValueError):
        use_state_store(None, "disk")


@pytest.mark.parametrize("kind", ["memory", "rocksdb"])
def test_failure_in_the_middle_of_a_batch_loses_and_doubles_nothing(spark, kind):
    src, sink, ckpt = folders(spark, "src", "sink", "ckpt")
    use_state_store(spark, kind)
    try:
        seen = lambda: runner.first_seen(runner.decoded_stream(spark, src, max_files_per_trigger=1),
                                         ["symbol", "timestamp"], "timestamp", "1 day").select("symbol", "close_time")
        schema = None
        for part in range(4):
            messages(spark, [candle("a", i) for i in range(part * 10, part * 10 + 12)], src)        # two of each part come again
        failed = []

        def work(batch, i):
            batches.land(batch, sink, i)
            if i == 2 and not failed:
                failed.append(i)
                raise Down()
        with pytest.raises(StreamingQueryException):
            runner.run_until_done(batches.start_batches(seen(), ckpt, work))
        runner.run_until_done(batches.start_batches(seen(), ckpt, work))
        schema = fs.StructType.fromDDL("symbol string, close_time long")
        rows = [r.close_time for r in batches.landed(spark, sink, schema).collect()]
        assert failed == [2] and sorted(rows) == [START + (i + 1) * MINUTE - 1 for i in range(42)]
    finally:
        use_state_store(spark, "memory")


# --- I4, I7 ---------------------------------------------------------------------------

def test_late_rows_are_counted(spark, tmp_path):
    _, dropped = streams.run_with_late_rows(spark, SF_SMALL)
    assert dropped > 0
    empty = str(tmp_path / "empty")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(f"{empty}/events.parquet")
    sink, dropped = streams.run_with_late_rows(spark, empty)
    assert dropped == 0 and spark.read.parquet(sink).count() == 0
    assert streams.checkpoint_resume(spark, empty).count() == 0


def test_two_sinks_run_live_until_one_ends(spark):
    src, a, b, ca, cb = folders(spark, "src", "a", "b", "ca", "cb")
    messages(spark, [candle("a", i) for i in range(6)], src)
    every = {"processingTime": "1 second"}
    qa = runner.start_file_sink(runner.decoded_stream(spark, src), a, ca, trigger=every)
    qb = runner.start_file_sink(runner.decoded_stream(spark, src).filter("open_time % 2 = 0"), b, cb, trigger={"processingTime": "2 seconds"})
    until = time.monotonic() + 60
    done = lambda: (path_exists(spark, f"{a}/_spark_metadata/0") and path_exists(spark, f"{b}/_spark_metadata/0")) or time.monotonic() > until
    runner.run_live(qa, qb, stop=done)
    assert not qa.isActive and not qb.isActive
    assert spark.read.parquet(a).count() == 6 and spark.read.parquet(b).count() == 6
    ok = runner.start_file_sink(runner.decoded_stream(spark, src), a + "2", ca + "2", trigger=every)
    bad = runner.start_file_sink(runner.decoded_stream(spark, src).withColumn("x", F.raise_error(F.lit("boom"))), b + "2", cb + "2", trigger=every)
    with pytest.raises(StreamingQueryException, match="boom"):
        runner.run_live(ok, bad, stop=lambda: time.monotonic() > until)
    assert not ok.isActive


def test_alert_sinks_can_hold_only_anomalies(spark):
    df = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "symbol string, is_anomaly boolean")
    assert runner.only_flagged(df).count() == 3
    assert [r.symbol for r in runner.only_flagged(df, only_anomalies=True).collect()] == ["a"]


# --- C3, K9, K10 -----------------------------------------------------------------------

def test_published_rows_change_the_next_batch_only(spark):
    src, sink, ckpt, root = folders(spark, "src", "sink", "ckpt", "params")
    row = lambda s, m: (s, None, "close", m, 10.0)
    publish = lambda *rows: models.publish_params(spark.createDataFrame(list(rows), pm.PARAMS_SCHEMA), root)

    def scored(batch):
        return models.zscored(batch, root, ["close"]).select("symbol", "open_time", "close_zscore")

    run = lambda: runner.run_until_done(batches.start_scored_sink(runner.decoded_stream(spark, src), sink, ckpt, scored))
    messages(spark, [candle("a", 0), candle("new", 0)], src)
    with pytest.raises(StreamingQueryException):
        run()                                                                            # nothing is published: an error, no row lost
    publish(row(None, 90.0))
    run()
    publish(row(None, 90.0), row("a", 100.0))
    messages(spark, [candle("a", 1), candle("new", 1)], src)
    run()
    out = batches.landed(spark, sink, fs.StructType.fromDDL("symbol string, open_time long, close_zscore double")).collect()
    assert sorted((r.symbol, (r.open_time - START) // MINUTE, r.close_zscore) for r in out) == [("a", 0, 1.0), ("a", 1, 0.0), ("new", 0, 1.0), ("new", 1, 1.0)]


def test_a_saved_pipeline_scores_the_stream_like_the_batch(spark):
    src, sink, ckpt, root = folders(spark, "src", "sink", "ckpt", "model")
    messages(spark, [candle(s, i, 100.0 + (i * 7 + len(s)) % 13) for s in ("a", "bb") for i in range(40)], src)
    fit_on = kl.decode_candles(spark.read.text(src))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["close", "high"], outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            KMeans(k=3, seed=42, featuresCol="features", predictionCol="cluster")])
    with pytest.raises(FileNotFoundError):
        models.load_pipeline(spark, root)
    assert models.save_pipeline(spark, pipe.fit(fit_on), root) == 1

    def scored(batch):
        model = models.load_pipeline(spark, root)
        centers = [list(map(float, c)) for c in model.stages[-1].clusterCenters()]
        x = model.transform(batch)
        return x.select("symbol", "open_time", "cluster", distance_to_own_center(vector_columns("features", 2), F.col("cluster"), centers).alias("distance"))

    runner.run_until_done(batches.start_scored_sink(runner.decoded_stream(spark, src), sink, ckpt, scored))
    out = batches.landed(spark, sink, fs.StructType.fromDDL("symbol string, open_time long, cluster int, distance double"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, scored(fit_on).collect())) and out.count() == 80
    assert out.agg(F.max("distance")).first()[0] > 0


def test_centres_score_unpublished_series_by_the_default_row(spark):
    root, = folders(spark, "centres")
    rows = spark.createDataFrame([(s, "1m", float(i % 5), float(i)) for s in ("a", "b", "new") for i in range(30)], "symbol string, interval string, u double, v double")
    known = spark.createDataFrame([("a", "1m"), ("b", "1m")], "symbol string, interval string")
    models.publish_centers(rows, root, ["u", "v"], [[0.0, 0.0], [1.0, 1.0]], only=known)
    out = models.distance_scored(rows, root, ["u", "v"])
    assert out.count() == 90 and out.filter("distance IS NULL OR cluster IS NULL").count() == 0
    assert out.columns == ["symbol", "interval", "u", "v", "cluster", "distance", "anomaly_kmeans"]
    series = spark.read.parquet(store.published(spark, root) + "/series")
    assert sorted(str(r.symbol) for r in series.collect()) == ["None", "a", "b"]


# --- A9, A12, B13 ------------------------------------------------------------------------

def test_a_rerun_of_one_symbol_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "symbol string, v int")
    fs.write_results(rows, path, fmt="csv")
    before = {p.name for p in (tmp_path / "results" / "symbol=b").iterdir()}
    fs.write_results(spark.createDataFrame([("a", 9)], "symbol string, v int"), path, fmt="csv")
    assert {p.name for p in (tmp_path / "results" / "symbol=b").iterdir()} == before
    read = lambda: sorted((r.symbol, int(r.v)) for r in fs.read_results(spark, path, fmt="csv").collect())
    assert read() == [("a", 9), ("b", 2), ("b", 3)]
    fs.write_results(spark.createDataFrame([("a", 5)], "symbol string, v int"), path, fmt="csv", replace="static")
    assert read() == [("a", 5)]
    with pytest.raises(ValueError):
        fs.write_results(rows, path, replace="none")


def test_statistics_of_no_rows_load_as_null(spark, tmp_path):
    empty = str(tmp_path / "empty")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(0).write.parquet(f"{empty}/events.parquet")
    from barwatch.plans import ingest
    assert ingest.load_model_params(spark, empty).count() == 0
    p = pm.from_dict({"zscore": {"statistics": {"return": {}}}})
    assert p.mean("return") is None and p.table(spark).first()["std"] is None


def test_volume_rules(spark):
    stats = spark.createDataFrame([(0.0, 0.0, 250.0), (0.0, 0.0, 150.0), (0.0, 0.0, None)], "std_return double, max_range double, avg_volume double")
    p = pm.Params()
    with pytest.raises(ValueError):
        window_detector(stats, p)
    flags = lambda df: [r.volume_anomaly for r in df.collect()]
    assert flags(window_detector(stats, p, volume_rule="compat")) == [1, 0, 0]                   # limit 207.532
    p.stats["volume"] = {"mean": 100.0, "std": 20.0}
    assert flags(window_detector(stats, p)) == [1, 1, 0]                                         # limit 140
    p.stats["volume"] = {}
    assert flags(window_detector(stats, p)) == [0, 0, 0]
