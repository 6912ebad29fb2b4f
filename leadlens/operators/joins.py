"""Joins with explicit NULL and skew behaviour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = "__spread"


def _all_set(on: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in on)


def unique_side(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Marks the look-up side; group by ``[*on, SPREAD]`` to aggregate and join on one shuffle."""
    return df.withColumn(SPREAD, F.expr(f"CASE WHEN {_all_set(on)} THEN 0L END"))


def _spread_side(df: DataFrame, on: Sequence[str], row_id: Sequence[str]) -> DataFrame:
    salt = f"xxhash64({', '.join(row_id or df.columns)}) | 1L"  # the whole hash, never 0
    return df.withColumn(SPREAD, F.expr(f"CASE WHEN {_all_set(on)} THEN 0L ELSE {salt} END"))


def lookup(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", row_id: Sequence[str] = ()
) -> DataFrame:
    """Join to a side that is unique on ``on``, keeping left rows with NULL keys spread out.

    A plain outer join hashes all NULL keys to one task; rows that cannot match get a
    salt instead. Hot non-NULL keys are split by adaptive skew join (the look-up side
    has one row per key). ``row_id`` names the columns the salt is hashed from (all by
    default; name a few so that the others can still be pruned).
    """
    if SPREAD not in right.columns:
        right = unique_side(right, on)
    joined = _spread_side(left, on, row_id).join(right, [*on, SPREAD], how)
    tail = [c for c in right.columns if c not in (*on, SPREAD)] if how not in ("left_anti", "left_semi") else []
    return joined.select(*left.columns, *tail)


def semi(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), list(on), "left_semi")


def anti_keep_null(
    left: DataFrame, right: DataFrame, on: Sequence[str], row_id: Sequence[str] = ()
) -> DataFrame:
    """Drop rows whose key is listed on the right; NULL keys stay, NULLs on the right are ignored."""
    keys = right.select(*on).filter(_all_set(on)).distinct()
    return lookup(left, keys, on, "left_anti", row_id)


def attach_roster(
    df: DataFrame, roster: DataFrame, entity: str, how: str = "left", row_id: Sequence[str] = ()
) -> DataFrame:
    """Roster attributes by entity id compared as text; adds ``pid`` and the roster columns."""
    keyed = roster.withColumn("__pid", F.col("pid").cast("string"))
    out = lookup(df.withColumn("__pid", F.col(entity).cast("string")), keyed, ["__pid"], how, row_id)
    return out.drop("__pid")


def zero_fill(roster: DataFrame, measures: DataFrame, key: str, zero: Sequence[str]) -> DataFrame:
    """Every rostered key once; missing counts become 0, other measures stay NULL."""
    out = roster.join(measures, [key], "left")
    return out.fillna(0, subset=list(zero))


def resolve_identity(
    users: DataFrame, entities: DataFrame, roles: Sequence[str], integer_ids: bool = False
) -> DataFrame:
    """identity -> entity through active users of current entities; the smallest entity wins."""
    active = users.filter(F.col("role").isin(list(roles)) & (F.col("status") == "ACTIVE")).select("id", "csp_id")
    current = entities.filter(F.col("etl_current")).select("csp_id", F.col("partner_id").cast("string").alias("pid"))
    ident = F.col("id").try_cast("bigint") if integer_ids else F.col("id").cast("string")
    pairs = active.distinct().join(current.distinct(), ["csp_id"]).select(ident.alias("identity"), "pid")
    return pairs.filter(F.col("identity").isNotNull()).groupBy("identity").agg(F.min("pid").alias("pid"))
