"""Ratios by integer arithmetic: half-up, and equal in every SQL engine.

Numerators and denominators are SQL expressions (most often column names).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: str, den: str, digits: int = 1, scale: int = 1, zero_den: float | None = None) -> Column:
    """``scale * num / den`` rounded half-up to ``digits``; ``zero_den`` (NULL) on a zero denominator."""
    power = 10**digits
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    value = f"CAST(({2 * scale * power}L * {n} + {d}) div nullif(2L * {d}, 0L) AS DOUBLE) / {power}D"
    return F.expr(value if zero_den is None else f"CASE WHEN {d} = 0 THEN {float(zero_den)}D ELSE {value} END")


def pct(num: str, den: str, digits: int = 1, zero_den: float | None = None) -> Column:
    return ratio(num, den, digits, 100, zero_den)


def whole(num: str, den: str) -> Column:
    """Rounded to a whole number, as bigint."""
    return ratio(num, den, 0).cast("bigint")
