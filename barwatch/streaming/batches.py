"""Sinks that write each micro-batch to a folder of its own.

``<path>/batch=<id>`` is overwritten when Spark runs a batch again after a
failure, so its rows are there exactly once, whatever the batch did before it
failed. Scoring that must see newly published parameters or models, splitting a
batch over several sinks, and update-mode output all build on it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from barwatch.operators.report import dedupe_first
from barwatch.session import path_exists
from barwatch.sources import store
from barwatch.sources.kline import decode_candles

AVAILABLE_NOW = {"availableNow": True}


def land(batch: DataFrame, path: str, batch_id: int) -> None:
    """One batch's rows into its folder."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows that batches left under ``path``; none before the first batch."""
    if not any(n.startswith("batch=") for n in store.names_in(spark, path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch=*").select(*schema.names)


def start_batches(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None], mode: str = "append",
                  trigger: dict | None = None) -> StreamingQuery:
    """Run ``work(batch, batch_id)`` on every micro-batch; it must bear repetition."""
    return (stream.writeStream.outputMode(mode).foreachBatch(work).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW)).start())


def start_scored_sink(stream: DataFrame, path: str, checkpoint: str, score: Callable[[DataFrame], DataFrame],
                      trigger: dict | None = None) -> StreamingQuery:
    """Score every micro-batch with what is published when it runs: ``score`` is called
    for each batch, so it reads parameters and models anew."""
    return start_batches(stream, checkpoint, lambda batch, i: land(score(batch), path, i), trigger=trigger)


def start_candles_with_dead_letter(messages: DataFrame, good: str, dead: str, checkpoint: str, trigger: dict | None = None,
                                   value_col: str = "value") -> StreamingQuery:
    """A5 with a dead letter: decoded candles go to ``good``, messages that are no
    candle to ``dead`` as their raw text and why. Every message of a batch is in one
    of the two, also after a batch that ran twice."""
    def work(batch: DataFrame, i: int) -> None:
        decoded = decode_candles(batch, value_col, keep_invalid=True).persist()
        try:
            land(decoded.filter("_valid").drop("_valid", "_raw"), good, i)
            why = F.when(F.col("_raw").isNull(), "empty").when(F.try_parse_json("_raw").isNull(), "no JSON") \
                   .when(F.col("symbol").isNull(), "no symbol").otherwise("no close time")
            land(decoded.filter(~F.col("_valid")).select(F.col("_raw").alias("raw"), why.alias("reason")), dead, i)
        finally:
            decoded.unpersist()
    return start_batches(messages, checkpoint, work, trigger=trigger)


# --- update mode: snapshot and change log ------------------------------------------

COMPACT_EVERY = 10               # batches between snapshots


def _number(name: str) -> int:
    return int(name.split("=")[1])


def _snapshots(spark: SparkSession, path: str) -> list[int]:
    """Batch ids up to which a whole snapshot exists; one that was not finished has no success mark."""
    return sorted(_number(n) for n in store.names_in(spark, f"{path}/snapshots")
                  if path_exists(spark, f"{path}/snapshots/{n}/_SUCCESS"))


def _deltas(spark: SparkSession, path: str, after: int) -> list[int]:
    return sorted(i for i in (_number(n) for n in store.names_in(spark, f"{path}/deltas")) if i > after)


def latest(spark: SparkSession, path: str, keys: list[str], schema: StructType, upto: int | None = None) -> DataFrame:
    """Current row of every key: the newest snapshot and the batches after it, the newest batch last."""
    snapshots = _snapshots(spark, path)
    base = snapshots[-1] if snapshots else -1
    tail = [i for i in _deltas(spark, path, base) if upto is None or i <= upto]
    parts = [spark.read.schema(schema).parquet(f"{path}/snapshots/upto={base}").withColumn("_batch", F.lit(base))] if snapshots else []
    parts += [spark.read.schema(schema).parquet(f"{path}/deltas/batch={i}").withColumn("_batch", F.lit(i)) for i in tail]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return dedupe_first(rows, keys, [F.col("_batch").desc()]).drop("_batch")


def compact(spark: SparkSession, path: str, keys: list[str], schema: StructType, upto: int) -> None:
    """Write the rows current at batch ``upto`` as a snapshot. It counts from the moment
    its success mark is there; only then what it replaces goes: older snapshots but
    one, and batches that the older one holds, so a reader that listed before stays whole."""
    if upto in _snapshots(spark, path):
        return
    latest(spark, path, keys, schema, upto).write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")
    kept = _snapshots(spark, path)[-2:]
    for n in store.names_in(spark, f"{path}/snapshots"):
        if _number(n) < kept[0]:
            store.remove(spark, f"{path}/snapshots/{n}")
    if len(kept) > 1:
        for n in store.names_in(spark, f"{path}/deltas"):
            if _number(n) <= kept[0]:
                store.remove(spark, f"{path}/deltas/{n}")


def start_update_log(stream: DataFrame, path: str, checkpoint: str, keys: list[str], trigger: dict | None = None,
                     compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Update-mode output as a change log that is compacted every so many batches;
    read it with :func:`latest`. What it holds is bounded by the current rows and
    the changes of 2 * ``compact_every`` batches. A batch that runs again writes the
    same folder, and one that a snapshot holds already is not read again."""
    spark, schema = stream.sparkSession, stream.schema

    def work(batch: DataFrame, i: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/deltas/batch={i}")
        if (i + 1) % compact_every == 0:
            compact(spark, path, keys, schema, i)

    return start_batches(stream, checkpoint, work, mode="update", trigger=trigger)
