"""Time conversions: epoch milliseconds, ISO strings, interval labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barwatch.functions.numeric import col_


def interval_label(interval: str) -> str:
    """'1 hour' -> '1h', '10 minutes' -> '10m', '1 day' -> '1d', '5 seconds' -> '5s'."""
    n, unit = interval.split()
    return f"{n}{unit[0] if unit.startswith(('h', 'd', 's')) else 'm'}"


# Epoch milliseconds of the years 1 to 9999.
FIRST_MS, LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def ms_to_ts(c) -> Column:
    """Epoch milliseconds (long) -> TIMESTAMP; NULL outside the years 1 to 9999."""
    ms = col_(c).cast("long")
    return F.when(ms.between(FIRST_MS, LAST_MS), F.timestamp_millis(ms))


def ms_to_ts_ntz(c) -> Column:
    return ms_to_ts(c).cast("timestamp_ntz")


def ts_to_ms(c) -> Column:
    return F.unix_millis(col_(c).cast("timestamp"))


def str_to_ts(c, fmt: str | None = None) -> Column:
    """String -> TIMESTAMP; NULL (not an error) when it does not parse."""
    return F.try_to_timestamp(col_(c), F.lit(fmt)) if fmt else F.try_to_timestamp(col_(c))


def ms_to_iso(c) -> Column:
    """Epoch ms -> ISO-8601 text, UTC, millisecond precision."""
    return F.date_format(ms_to_ts(c), "yyyy-MM-dd'T'HH:mm:ss.SSS")
