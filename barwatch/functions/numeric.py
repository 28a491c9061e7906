"""NULL-safe arithmetic used by every feature.

Spark 4 runs with ANSI mode on, so ``x / 0`` raises instead of returning
NULL. Every ratio in barwatch goes through :func:`safe_div`; logarithms of
non-positive numbers become NULL; NaN and +/-inf are normalised to NULL so a
single bad bar cannot flag itself (``abs(NaN) > 3`` is true in Spark).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """NULL for NaN and +/-inf, the value otherwise."""
    c = col_(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None).cast(DoubleType())).otherwise(c)


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never an error, never inf)."""
    return F.try_divide(col_(num), col_(den))


def safe_ln(c) -> Column:
    """Natural log, NULL for values <= 0."""
    c = col_(c)
    return F.when(c > 0, F.ln(c))


def pct_change(cur, prev) -> Column:
    """(cur - prev) / prev * 100, NULL when prev is 0 or NULL."""
    return safe_div(col_(cur) - col_(prev), col_(prev)) * 100.0


def round_to(c, digits: int) -> Column:
    return F.round(col_(c), digits)


def hash_bucket(key_cols: list, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of the key.

    Independent of partitioning and row order (unlike ``randomSplit``), and
    reproducible in DuckDB as ``('0x'||substr(md5(key),1,8))::bigint % n``.
    """
    key = F.concat_ws("|", *[col_(k).cast("string") for k in key_cols])
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(buckets))
