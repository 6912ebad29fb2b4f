"""Ordered numbering inside a key, every key split by time.

A plain window over a key sends the whole key to one task. Here every key is laid out in (key, time bucket)
groups, whatever its size: the window runs inside a bucket, and one summary row per bucket carries the result
from bucket to bucket of the key. The summaries of a key are bounded by the minutes it spans, not by its rows.

``bucket_minutes`` sets the width. A minute is the smallest; rows of one key that share a minute stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.temporal import minute_number_sql

BUCKET_MINUTES = 1
_B, _IN, _CARRY = "__bucket", "__in", "__carry"
# Before the bucket of any time.
_NO_TIME = -(1 << 40)


def all_set(keys: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in keys)


def bucket_sql(ts: str, minutes: int) -> str:
    return f"{minute_number_sql(ts)} div {int(minutes)}L"


def _laid_out(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str], ordered: str, bucket: str) -> DataFrame:
    """Adds the bucket; rows outside the order are spread by the whole hash of key, time and ``tiebreak``."""
    salt = f"xxhash64({', '.join([*keys, ts, *tiebreak])})"
    return df.withColumn(_B, F.expr(f"CASE WHEN {ordered} THEN {bucket} ELSE {salt} END"))


def next_event(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    name: str,
    tiebreak: Sequence[str] = (),
    bucket_minutes: int = BUCKET_MINUTES,
) -> DataFrame:
    """Adds the time of the key's next row in (ts, tiebreak) order; NULL for the last one.

    Rows without a key or without a time have no next row.
    """
    ordered = f"{all_set(keys)} AND {ts} IS NOT NULL"
    src = _laid_out(df, keys, ts, tiebreak, ordered, bucket_sql(ts, bucket_minutes))
    inside = W.partitionBy(*keys, _B).orderBy(F.asc(ts), *[F.asc(c) for c in tiebreak])
    main = src.withColumn(_IN, F.lead(ts).over(inside))
    across = W.partitionBy(*keys).orderBy(_B)
    carry = (
        src.filter(ordered)
        .groupBy(*keys, _B)
        .agg(F.min(ts).alias("__first"))
        .select(*keys, _B, F.lead("__first").over(across).alias(_CARRY))
    )
    return (
        main.join(carry, [*keys, _B], "left")
        .withColumn(name, F.expr(f"CASE WHEN {ordered} THEN coalesce({_IN}, {_CARRY}) END"))
        .select(*df.columns, name)
    )


def running_number(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    name: str,
    tiebreak: Sequence[str] = (),
    bucket_minutes: int = BUCKET_MINUTES,
) -> DataFrame:
    """Adds the 1-based position of each row inside its key (rows without a time first).

    Rows without a key have no position.
    """
    ordered = all_set(keys)
    src = _laid_out(df, keys, ts, tiebreak, ordered, f"coalesce({bucket_sql(ts, bucket_minutes)}, {_NO_TIME}L)")
    inside = W.partitionBy(*keys, _B).orderBy(F.asc_nulls_first(ts), *[F.asc_nulls_last(c) for c in tiebreak])
    main = src.withColumn(_IN, F.row_number().over(inside))
    before = W.partitionBy(*keys).orderBy(_B).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        src.filter(ordered)
        .groupBy(*keys, _B)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*keys, _B, F.sum("__n").over(before).alias(_CARRY))
    )
    return (
        main.join(carry, [*keys, _B], "left")
        .withColumn(name, F.expr(f"CASE WHEN {ordered} THEN {_IN} + coalesce({_CARRY}, 0L) END"))
        .select(*df.columns, name)
    )


def previous_value(df: DataFrame, keys: Sequence[str], order: str, col: str, name: str, default=None) -> DataFrame:
    """Value of the previous *present* row. For already aggregated rows (one per key and day)."""
    w = W.partitionBy(*keys).orderBy(order)
    return df.withColumn(name, F.lag(col, 1, default).over(w))
