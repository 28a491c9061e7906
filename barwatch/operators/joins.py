"""Joins on the natural bar key (symbol, interval, bar_ts) and lookups.

The reference joins detector outputs on ``monotonically_increasing_id``
values, which are only stable for single-partition inputs. Every join here
uses the natural key, NULL-safe, and leaves the physical strategy to
Catalyst/AQE: small lookup sides (per-symbol parameters, centroids) become
broadcast hash joins when their *measured* size is under
``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides shuffle on the
key once and stay co-partitioned for the following joins.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BAR_KEY = ["symbol", "interval", "bar_ts"]


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL-safe equality; one copy of each key column."""
    keys = list(keys)
    if not keys:
        raise ValueError("keyed_join needs at least one key; use scalar subqueries for global values")
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = functools.reduce(operator.and_, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    out = left.join(r, cond, how)
    if how in ("right", "full", "outer", "full_outer", "right_outer"):
        for k in keys:
            out = out.withColumn(k, F.coalesce(F.col(k), F.col(f"_r_{k}")))
    return out.drop(*[f"_r_{k}" for k in keys])


def join_pseudo_labels(features: DataFrame, flags: DataFrame, flag_col: str = "anomaly_kmeans",
                       keys=BAR_KEY) -> DataFrame:
    """Features joined with a detector's flag as a double ``label`` (inner)."""
    labels = flags.select(*keys, F.col(flag_col).cast("double").alias("label"))
    return keyed_join(features, labels, list(keys), "inner")


def join_methods(base: DataFrame, others: list[tuple[DataFrame, str]], keys=BAR_KEY) -> DataFrame:
    """Chain inner joins of detector outputs on the same key.

    All inputs share the key, so after the first exchange the later joins
    reuse the same hash layout (one shuffle per input, none repeated).
    """
    out = base
    for df, col in others:
        out = keyed_join(out, df.select(*keys, col), list(keys), "inner")
    return out
