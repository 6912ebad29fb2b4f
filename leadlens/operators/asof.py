"""Forward as-of join: the first right row at or after a time.

A range condition on top of an equi join compares every pair inside a key, which
is quadratic for a hot key. Here left and right rows are laid out together in
time order and the answer is the next right row seen, so the work is linear in
the rows. Every key is cut into time buckets, and a per-bucket summary carries
the first right row back to the earlier buckets of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.temporal import shift_sql
from .ordered import BUCKET_MINUTES, all_set, bucket_sql

_B, _T, _KIND, _L, _R = "__bucket", "__time", "__kind", "__left", "__right"
_NULL_BUCKETS = 1 << 40
_NEVER = 1 << 40


def first_at_or_after(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    payload: Sequence[str],
    tiebreak: Sequence[str] = (),
    strict: bool = False,
    bucket_minutes: int = BUCKET_MINUTES,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """All left rows; ``payload`` columns of the earliest right row at/after (``strict``: after) ``left_time``.

    Right rows are ordered by time, then ``tiebreak``, then the payload itself, so the pick is total.
    ``row_id`` names columns that spread left rows without a usable key or time.
    """
    on = list(on)
    time_type = left.selectExpr(f"{left_time} AS {_T}").schema[_T].dataType
    body = [c for c in left.columns if c not in on]
    has_key = all_set(on)
    lrows = left.selectExpr("*", f"{left_time} AS {_T}").selectExpr(
        *on,
        _T,
        f"0 AS {_KIND}",
        # Spreads the left rows that can never match (no key or no time).
        f"pmod(xxhash64({', '.join(row_id or left.columns)}), {_NULL_BUCKETS}L) AS __salt",
        f"struct({', '.join(['1 AS __present', *body])}) AS {_L}",
    )
    fields = [_T, *[f"{c} AS __t{i}" for i, c in enumerate(tiebreak)], *[f"{c} AS __p{i}" for i, c in enumerate(payload)]]
    rrows = right.filter(f"{has_key} AND {right_time} IS NOT NULL").withColumn(_T, F.col(right_time).cast(time_type))
    rrows = rrows.selectExpr(
        *on,
        _T,
        # At equal times a right row is seen by the left row, unless strict.
        f"{-1 if strict else 1} AS {_KIND}",
        f"struct({', '.join(fields)}) AS {_R}",
    )
    usable = f"{has_key} AND {_T} IS NOT NULL"
    both = lrows.unionByName(rrows, allowMissingColumns=True).withColumn(
        _B,
        F.expr(
            f"CASE WHEN {usable} THEN {bucket_sql(_T, bucket_minutes)} ELSE {_NEVER}L + __salt END"
        ),
    )

    backwards = (
        W.partitionBy(*on, _B)
        .orderBy(F.desc(_T), F.desc(_KIND), F.desc_nulls_last(_R))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    main = both.withColumn("__in", F.last(_R, ignorenulls=True).over(backwards)).filter(F.col(_L).isNotNull())

    later = W.partitionBy(*on).orderBy(F.desc(_B)).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        both.filter(usable)
        .groupBy(*on, _B)
        .agg(F.min(_R).alias("__first"))
        .select(*on, _B, F.last("__first", ignorenulls=True).over(later).alias("__carry"))
    )
    picked = [f"coalesce(__in, __carry).__p{i} AS {c}" for i, c in enumerate(payload)]
    out = main.join(carry, [*on, _B], "left").selectExpr(*on, *[f"{_L}.{c} AS {c}" for c in body], *picked)
    return out.select(*left.columns, *payload)


def attribute_first(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    payload: Sequence[str],
    before_minutes: int,
    after_minutes: int,
    next_ts: str | None = None,
    tiebreak: Sequence[str] = (),
    bucket_minutes: int = BUCKET_MINUTES,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Earliest right row in [left_ts - before, left_ts + after] and strictly before ``next_ts``.

    The earliest row at/after the lower bound either meets the upper bounds or no row does,
    so one as-of look-up answers the interval join. Unmatched left rows keep NULL payload.
    """
    src = left.selectExpr(
        "*",
        f"{shift_sql(left_ts, after_minutes)} AS __hi",
        f"{next_ts if next_ts is not None else 'CAST(NULL AS TIMESTAMP_NTZ)'} AS __next",
    )
    hits = first_at_or_after(
        src,
        right.withColumn("__rts", F.col(right_ts)),
        on,
        shift_sql(left_ts, -before_minutes),
        "__rts",
        [*payload, "__rts"],
        tiebreak,
        bucket_minutes=bucket_minutes,
        row_id=row_id,
    )
    ok = "__rts <= __hi AND (__next IS NULL OR __rts < __next)"
    return hits.selectExpr(*left.columns, *[f"CASE WHEN {ok} THEN {c} END AS {c}" for c in payload])


def first_after(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    name: str,
    bucket_minutes: int = BUCKET_MINUTES,
) -> DataFrame:
    """Adds the first right time strictly after ``left_ts`` (NULL when there is none)."""
    right = right.withColumn(name, F.col(right_ts))
    return first_at_or_after(
        left, right, on, left_ts, name, [name], strict=True, bucket_minutes=bucket_minutes
    )
