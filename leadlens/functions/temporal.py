"""Time arithmetic on zone-less timestamps, and the PRE/POST periods.

Arguments that name a time or a day are SQL expressions (most often a column name).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_sql(day: dt.date) -> str:
    return f"DATE'{day}'"


def instant_sql(day: dt.date) -> str:
    """Midnight of a day, comparable with zone-less timestamps (keeps filters pushable)."""
    return f"TIMESTAMP_NTZ'{day} 00:00:00'"


def shift_sql(ts: str, minutes: int) -> str:
    return f"(({ts}) + INTERVAL '{int(minutes)}' MINUTE)"


def shift_minutes(ts: str, minutes: int) -> Column:
    return F.expr(shift_sql(ts, minutes))


def local_time(ts: str, offset_minutes: int) -> Column:
    """UTC -> local wall clock by a fixed offset (negate the offset for the way back)."""
    return shift_minutes(ts, offset_minutes)


def minute_number_sql(ts: str) -> str:
    """Whole minutes since 1970; built from date and clock fields, so no time zone is involved."""
    return f"(CAST(unix_date(to_date({ts})) AS BIGINT) * 1440 + hour({ts}) * 60 + minute({ts}))"


def minute_diff_sql(start: str, end: str) -> str:
    return f"({minute_number_sql(end)} - {minute_number_sql(start)})"


def minute_diff(start: str, end: str) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (00:00:59 -> 00:01:00 is 1)."""
    return F.expr(minute_diff_sql(start, end))


def second_diff(start: str, end: str) -> Column:
    return F.expr(f"{minute_diff_sql(start, end)} * 60 + (second({end}) - second({start}))")


def tat_minutes(start: str, end: str, *, clamp: bool = False, hi: int | None = None) -> Column:
    """Duration in minutes, NULL when an end is missing or the value is negative.

    ``clamp`` turns negative values into 0 instead; ``hi`` also drops values above it.
    """
    diff = minute_diff_sql(start, end)
    if clamp:
        # ``greatest`` skips NULL, so a missing end is guarded first.
        return F.expr(f"CASE WHEN {diff} IS NOT NULL THEN greatest({diff}, 0L) END")
    keep = f"{diff} >= 0" if hi is None else f"{diff} BETWEEN 0 AND {int(hi)}"
    return F.expr(f"CASE WHEN {keep} THEN {diff} END")


def within_minutes(start: str, end: str, lo: int = 0, hi: int = 2880) -> Column:
    """1 when ``end`` exists and lies within [lo, hi] minutes after ``start``, else 0."""
    return F.expr(f"CASE WHEN {minute_diff_sql(start, end)} BETWEEN {int(lo)} AND {int(hi)} THEN 1 ELSE 0 END")


def between_dates(day: str, first: dt.date, last: dt.date) -> Column:
    return F.expr(f"{day} BETWEEN {date_sql(first)} AND {date_sql(last)}")


def period_fixed(day: str, pre: tuple[dt.date, dt.date], post: tuple[dt.date, dt.date]) -> Column:
    return F.when(between_dates(day, *pre), "PRE").when(between_dates(day, *post), "POST")


def live_days(anchor: str, as_of: dt.date) -> Column:
    return F.expr(f"datediff({date_sql(as_of)}, {anchor}) + 1")


def period_anchored(day: str, anchor: str, as_of: dt.date) -> Column:
    """POST = [anchor, as_of]; PRE = the same number of days just before the anchor."""
    last = date_sql(as_of)
    return F.expr(
        f"""CASE WHEN {day} BETWEEN {anchor} AND {last} THEN 'POST'
        WHEN {day} BETWEEN date_sub({anchor}, datediff({last}, {anchor}) + 1) AND date_sub({anchor}, 1) THEN 'PRE' END"""
    )


NIGHT = "night"


def hour_bucket(ts: str, bucket: int | str) -> Column:
    """``hour = h``, or the night bucket 00:00-07:59."""
    return F.expr(f"hour({ts}) <= 7" if bucket == NIGHT else f"hour({ts}) = {int(bucket)}")


def time_bucket(ts: str, minutes: int) -> Column:
    return F.expr(f"{minute_number_sql(ts)} div {int(minutes)}L")
