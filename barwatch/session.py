"""Session helpers: one place that decides Spark settings and shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every barwatch job relies on. UTC keeps batch, stream and the
# DuckDB oracle on the same clock; AQE lets the runtime pick broadcast vs
# sort-merge joins from measured sizes and split skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Stream state on the executors' disks instead of their heap; a batch uploads the
# changes of its keys, not the whole state.
ROCKSDB_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
STATE_STORES = {"memory": {}, "rocksdb": ROCKSDB_CONF}


def use_state_store(spark: SparkSession, kind: str) -> None:
    """Where streams that start from now on keep state: ``memory`` or ``rocksdb``. A
    stream goes on with the kind that its checkpoint was begun with."""
    for key, value in ROCKSDB_CONF.items():
        if kind == "rocksdb":
            spark.conf.set(key, value)
        elif kind == "memory":
            spark.conf.unset(key)
        else:
            raise ValueError(f"state store must be one of {sorted(STATE_STORES)}, not {kind!r}")


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app_name: str = "barwatch",
                  extra: dict | None = None, state_store: str = "memory") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = DEFAULT_CONF | STATE_STORES[state_store]
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and materialised tables.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting a
    local session gets a temporary folder, registered so later calls and
    ``DataFrame.checkpoint()`` agree; any other master is an error, since
    executors would write to disks of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="barwatch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Folders that :func:`scratch_path` names in the block go when it ends, also after
    an error. Write what is to stay to a path named before the block: a frame that
    is still to be computed would miss what it reads."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in made:
            p = hadoop.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Jobs in the block leave no shuffle files behind when they end. For one-off
    writes: a plan that is run twice would have to compute its shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back — a written table that cuts the lineage.

    Used where one intermediate feeds several branches of a plan (a fit and
    its application, several detectors); without it Spark recomputes the
    whole upstream, including the scan of the raw ticks, per branch. One
    write pass (``DataFrame.checkpoint`` on an unpersisted frame computes it
    twice), columnar re-reads with pushdown, and it survives executor loss. The
    write's shuffle files go with it.
    """
    path = scratch_path(df.sparkSession, name)
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, in any file system that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
