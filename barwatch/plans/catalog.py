"""Registry of named queries: Spark plan + optional DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the given tables. The
oracle is an ANSI SQL string over the same tables; both sides alias every
computed column to the same name and round doubles to 9 digits, so the
comparison is exact on values and insensitive to summation order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from barwatch.session import table_path

ORACLE_DIGITS = 9


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def rounded(df: DataFrame, digits: int = ORACLE_DIGITS) -> DataFrame:
    """Round every floating column (output shaping for the oracle compare)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def r9(expr: str, alias: str | None = None) -> str:
    """SQL side of :func:`rounded`."""
    a = alias or expr
    return f"round({expr}, {ORACLE_DIGITS}) AS \"{a}\""
