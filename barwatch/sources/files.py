"""File sources and sinks for bars, features and detector results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from barwatch.functions.time import str_to_ts

# Raw OHLCV columns (plus our series keys).
OHLCV_SCHEMA = StructType([
    StructField("symbol", StringType()), StructField("interval", StringType()),
    StructField("timestamp", TimestampNTZType()), StructField("open", DoubleType()),
    StructField("high", DoubleType()), StructField("low", DoubleType()), StructField("close", DoubleType()),
    StructField("volume", DoubleType()),
])
FEATURE_SCHEMA = StructType(OHLCV_SCHEMA.fields + [
    StructField("trades", LongType())] + [StructField(f, DoubleType()) for f in
                                          ["return", "log_return", "volatility_24h", "volume_change",
                                           "volume_ratio", "price_range"]])
RESULT_SCHEMA = StructType([
    StructField("symbol", StringType()), StructField("timestamp", TimestampNTZType()),
    StructField("close", DoubleType()), StructField("return", DoubleType()),
    StructField("anomaly", IntegerType()),
])


def read_ohlcv(spark: SparkSession, path: str, schema: StructType = OHLCV_SCHEMA) -> DataFrame:
    """A1: raw OHLCV CSV with a header, explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_features(spark: SparkSession, path: str, schema: StructType = FEATURE_SCHEMA) -> DataFrame:
    """A2: processed features CSV — explicit schema instead of ``inferSchema``."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_results(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A3: a detector's output directory (parquet by default, CSV for exports)."""
    if fmt == "csv":
        r = spark.read.option("header", True)
        return (r.schema(schema) if schema else r.option("inferSchema", True)).csv(path)
    return spark.read.parquet(path)


def write_results(df: DataFrame, path: str, fmt: str = "parquet", partition_by=("symbol",),
                  single_file: bool = False, replace: str = "dynamic") -> None:
    """Overwrite a result directory, partitioned by symbol (partition
    pruning for per-symbol reads). By default only the partitions that ``df`` has
    rows for are replaced, so a run for one symbol leaves the others' results;
    ``replace="static"`` clears the directory first. ``single_file`` is an opt-in
    export for small results only: it funnels the rows through one task."""
    if replace not in ("dynamic", "static"):
        raise ValueError(f"replace must be dynamic or static, not {replace!r}")
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite").option("partitionOverwriteMode", replace if partition_by else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def newest_files(spark: SparkSession, path: str, n_files: int, pattern: str = "part-*.csv") -> list[str]:
    """Paths of the newest non-empty files of a directory, by modification time
    then name. The listing reads no file content. A directory that does not
    exist is an error (``PATH_NOT_FOUND``), whatever its file system."""
    rows = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
            .select("path", "modificationTime", "length").filter("length > 0")
            .orderBy(F.col("modificationTime").desc(), F.col("path").desc()).limit(n_files).collect())   # <= n_files rows
    return [r["path"] for r in rows]


def latest_output(spark: SparkSession, path: str, schema: StructType, n_files: int = 50, n_rows: int = 200,
                  ts_col: str = "timestamp", ties: list[str] = ("symbol",)) -> DataFrame:
    """Rows of the newest ``n_files`` CSV part files, bad lines dropped,
    the last ``n_rows`` by time (ties by ``ties``) in ascending order.

    Files are ranked by a listing, so files that hold only a header count; only
    the chosen files are read. Rows are read PERMISSIVE with a corrupt-record
    column so a line with extra fields is dropped while short lines keep NULLs;
    rows whose time does not parse are dropped. An existing directory without
    files gives no rows; a missing one raises.
    """
    files = newest_files(spark, path, n_files)
    if not files:
        return spark.createDataFrame([], schema)
    text_schema = StructType([StructField(f.name, StringType()) for f in schema.fields]
                             + [StructField("_corrupt", StringType())])
    rows = (spark.read.schema(text_schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt").csv(files))
    n_fields = len(schema.fields)
    too_long = F.col("_corrupt").isNotNull() & (F.size(F.split(F.col("_corrupt"), ",")) > n_fields)
    rows = rows.filter(~too_long)
    typed = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampNTZType):
            typed.append(str_to_ts(c).cast("timestamp_ntz").alias(f.name))
        else:
            typed.append(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name))
    rows = rows.select(*typed).filter(F.col(ts_col).isNotNull())
    last = rows.orderBy(F.col(ts_col).desc(), *ties).limit(n_rows)
    return last.orderBy(ts_col, *ties)
