"""Predicates over map<name, struct<count, first_seen>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_count_with_prefix(events, prefix: str) -> Column:
    """1 when some key with the prefix has a non-zero count."""
    entries = F.map_entries(F.col(events) if isinstance(events, str) else events)
    hit = F.exists(
        entries, lambda e: e["key"].startswith(prefix) & (F.coalesce(e["value"]["count"], F.lit(0)) != 0)
    )
    return F.when(hit, 1).otherwise(0)


def min_first_seen(events, prefix: str) -> Column:
    """Smallest non-zero ``first_seen`` among the keys with the prefix."""
    matching = F.map_filter(
        F.col(events) if isinstance(events, str) else events, lambda k, _: k.startswith(prefix)
    )
    seen = F.transform(F.map_values(matching), lambda v: F.nullif(v["first_seen"], F.lit(0).cast("bigint")))
    return F.array_min(seen)
