"""Per-bar (intrabar) feature expressions — pure Column builders.

These need no neighbouring rows, so they run unchanged in batch and in
Structured Streaming. Features that need history live in
``barwatch.operators.features``.
"""

from __future__ import annotations

from pyspark.sql import Column

from barwatch.functions.numeric import col_, safe_div, safe_ln


def return_intrabar(open_="open", close="close") -> Column:
    """(close - open) / open * 100 — the stream's ``return``."""
    return safe_div(col_(close) - col_(open_), col_(open_)) * 100.0


def price_range_low(high="high", low="low") -> Column:
    """(high - low) / low * 100 — the stream's ``price_range``."""
    return safe_div(col_(high) - col_(low), col_(low)) * 100.0


def price_range_close(high="high", low="low", close="close") -> Column:
    """(high - low) / close * 100 — the batch ``price_range``."""
    return safe_div(col_(high) - col_(low), col_(close)) * 100.0


def price_range(high="high", low="low", close="close", denominator: str = "close") -> Column:
    """Batch divides by close, the stream by low; ``denominator`` picks."""
    if denominator == "low":
        return price_range_low(high, low)
    return price_range_close(high, low, close)


def log_return_intrabar(open_="open", close="close") -> Column:
    """ln(close / open) * 100, NULL when the ratio is not positive."""
    return safe_ln(safe_div(col_(close), col_(open_))) * 100.0
