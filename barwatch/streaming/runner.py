"""Running streaming queries: sources, sinks, triggers, checkpoints.

Live deployments read Kafka (``candle_stream(..., fmt="kafka")``); tests and
replays read landed message files with the same decode path. Sinks write
files with exactly-once commit logs; update-mode output is merged per key
with ``foreachBatch``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barwatch.sources.kline import candle_messages, decode_candles

KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def candle_stream(spark: SparkSession, source: str, fmt: str = "text", max_files_per_trigger: int | None = None,
                  **options) -> DataFrame:
    """A4: a stream of candle messages with a ``value`` column.

    ``fmt="kafka"``: ``source`` is the topic, ``options`` carry
    ``kafka.bootstrap.servers`` etc. (defaults: latest offsets, tolerate
    data loss). ``fmt="text"``: ``source`` is a directory of JSON lines, one
    message per line — the drop-in used for tests and replays.
    """
    if fmt == "kafka":
        opts = dict(KAFKA_DEFAULTS)
        opts.update(options)
        reader = spark.readStream.format("kafka").option("subscribe", source)
        for k, v in opts.items():
            reader = reader.option(k, v)
        return reader.load()
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(source)


def decoded_stream(spark: SparkSession, source: str, **kw) -> DataFrame:
    """A4 + A5: messages -> typed candles with a TIMESTAMP event time."""
    return decode_candles(candle_stream(spark, source, **kw))


def start_file_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                    fmt: str = "parquet", mode: str = "append", header: bool = True,
                    query_name: str | None = None) -> StreamingQuery:
    """A10: append rows to files; the sink's commit log makes restarts exactly-once.

    ``trigger``: e.g. ``{"processingTime": "5 seconds"}`` live or
    ``{"availableNow": True}`` for a bounded replay.
    """
    w = df.writeStream.outputMode(mode).format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if fmt == "csv":
        w = w.option("header", str(header).lower())
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def start_console_sink(df: DataFrame, checkpoint: str, trigger: dict | None = None, num_rows: int = 10,
                       fmt: str = "console", query_name: str | None = None) -> StreamingQuery:
    """Monitoring sink in update mode (console, or ``memory`` for tests)."""
    w = df.writeStream.outputMode("update").format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "console":
        w = w.option("truncate", "false").option("numRows", num_rows)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def first_seen(df: DataFrame, keys: list[str], ts_col: str, watermark: str) -> DataFrame:
    """D10 on a stream: the first row of each key to arrive; later ones go, in the same
    batch or another, as long as the watermark has not passed the key's time. State
    holds the keys of that span only."""
    return df.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(keys)


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows that stateful operators dropped behind the watermark, over the progress that
    the query still holds. Aggregations count after partial aggregation: rows of
    state they would have touched, not input rows."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def only_flagged(df: DataFrame, flag: str = "is_anomaly", only_anomalies: bool = False) -> DataFrame:
    """Rows for an alert sink: all of them, or the flagged ones."""
    return df.filter(F.coalesce(F.col(flag).cast("boolean"), F.lit(False))) if only_anomalies else df


def start_update_merge(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Update-mode output landed per micro-batch with its batch id; read
    it back with :func:`latest_per_key` for the current value of each key."""
    def land(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(path)

    return (df.writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})).start())


def latest_per_key(landed: DataFrame, keys: list[str]) -> DataFrame:
    """Keep each key's row from the newest batch (groups = one key's updates)."""
    from barwatch.operators.report import dedupe_first
    return dedupe_first(landed, keys, [F.col("_batch_id").desc()]).drop("_batch_id")


def start_kafka_sink(candles: DataFrame, topic: str, servers: str, checkpoint: str, trigger: dict | None = None,
                     fmt: str = "kafka", **options) -> StreamingQuery:
    """Candles as keyed topic messages (key = symbol keeps a symbol's order).

    Needs the Kafka connector on the session's class path. ``fmt`` and
    ``options`` let another sink take the same rows."""
    w = candle_messages(candles).writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        w = w.option("kafka.bootstrap.servers", servers).option("topic", topic)
    for k, v in options.items():
        w = w.option(k, v)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def write_candles_kafka(candles: DataFrame, topic: str, servers: str) -> None:
    """A7, batch form: the same messages written once."""
    candle_messages(candles).write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()


def run_live(*queries: StreamingQuery, stop: Callable[[], bool] = lambda: False, poll_s: float = 0.5) -> None:
    """Wait for any of several long-running queries to end, as a job that serves
    several sinks does; the others are then stopped, and a failure is raised.
    ``stop()`` ends the job from outside, after the running micro-batches."""
    try:
        while not stop():
            for qy in queries:
                if qy.awaitTermination(poll_s / len(queries)):          # raises if the query failed
                    return
    finally:
        for qy in queries:
            qy.stop()


def run_until_done(*queries: StreamingQuery, timeout_s: float | None = None, poll_s: float = 0.2) -> None:
    """Wait until all bounded (availableNow) queries have ended by themselves.

    Whichever query fails first stops the others and its error is raised at
    once. With ``timeout_s``, queries still running then are stopped and
    ``TimeoutError`` is raised: a half-filled sink is never a result."""
    running = list(queries)
    end = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while running:
            for qy in list(running):
                if qy.awaitTermination(poll_s):          # raises if the query failed
                    running.remove(qy)
            if running and end is not None and time.monotonic() > end:
                raise TimeoutError(f"{len(running)} streaming queries were still running after {timeout_s} s")
    finally:
        for qy in running:
            qy.stop()
