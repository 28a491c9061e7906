"""Flag, vote and label expressions shared by every detector."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

from barwatch.functions.numeric import col_

# Fixed values that must match the reference's outputs.
ANOMALY_LABEL = "ANOMALY"
NORMAL_LABEL = "Normal"
REASON_SEPARATOR = " | "
CONFIDENCE_BANDS = ((3, "HIGH"), (2, "MEDIUM"), (1, "LOW"))
CONFIDENCE_NONE = "NONE"
STATUS_VOLATILE = "VOLATILE"
STATUS_STABLE = "STABLE"
STATUS_ANOMALY = "ANOMALY ACTIVE"
STATUS_NORMAL = "MARKET NORMAL"


def flag_abs_gt(c, threshold) -> Column:
    """1 when |c| > threshold (strict), else 0; NULL counts as 0."""
    return F.when(F.abs(col_(c)) > threshold, F.lit(1)).otherwise(F.lit(0))


def flag_gt(c, threshold) -> Column:
    return F.when(col_(c) > threshold, F.lit(1)).otherwise(F.lit(0))


def flag_lt(c, threshold) -> Column:
    return F.when(col_(c) < threshold, F.lit(1)).otherwise(F.lit(0))


def any_condition(conditions: list[Column]) -> Column:
    """OR-fold of boolean conditions as a 0/1 flag (NULL conditions count as false)."""
    cond = functools.reduce(operator.or_, [F.coalesce(c, F.lit(False)) for c in conditions])
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def votes(flags: list) -> Column:
    """Sum of 0/1 flag columns."""
    return functools.reduce(operator.add, [col_(f) for f in flags])


def min_votes(votes_col, k: int = 2) -> Column:
    return F.coalesce(col_(votes_col) >= k, F.lit(False))


def confidence(votes_col) -> Column:
    v = col_(votes_col)
    expr = None
    for i, (limit, name) in enumerate(CONFIDENCE_BANDS):
        cond = v >= limit if i == 0 else v == limit
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(CONFIDENCE_NONE)


def reasons(named_flags: list[tuple[str, str]], compat: bool = False) -> Column:
    """Join the names of raised flags with " | ".

    Default: absent flags give NULL, which ``concat_ws`` skips, so no empty
    slots. ``compat=True`` keeps the reference text with empty slots.
    """
    parts = []
    for name, flag in named_flags:
        p = F.when(col_(flag) == 1, F.lit(name))
        parts.append(p.otherwise(F.lit("")) if compat else p)
    return F.concat_ws(REASON_SEPARATOR, *parts)


def final_label(votes_col, k: int = 2) -> Column:
    return F.when(col_(votes_col) >= k, F.lit(ANOMALY_LABEL)).otherwise(F.lit(NORMAL_LABEL))


def volatility_status(is_anomaly) -> Column:
    return F.when(F.coalesce(col_(is_anomaly), F.lit(False)), F.lit(STATUS_VOLATILE)).otherwise(F.lit(STATUS_STABLE))


def market_status(n_anomalies) -> Column:
    return F.when(col_(n_anomalies) > 0, F.lit(STATUS_ANOMALY)).otherwise(F.lit(STATUS_NORMAL))
