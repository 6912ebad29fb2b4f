"""One row per key.

``row_number() = 1`` lets Spark put a ``WindowGroupLimit`` in front of the
shuffle, so every map task sends at most one row per key: a key that holds a
third of the table costs one row per task, not one giant task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RN = "__rn"


def top_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_by(
    df: DataFrame, keys: Sequence[str], ts: str, nulls: str = "last", tiebreak: Sequence[str] = ()
) -> DataFrame:
    first = F.desc_nulls_last(ts) if nulls == "last" else F.desc_nulls_first(ts)
    return top_one(df, keys, [first, *[F.desc_nulls_last(c) for c in tiebreak]])


def earliest_by(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    return top_one(df, keys, [F.asc_nulls_last(ts), *[F.asc_nulls_last(c) for c in tiebreak]])


def one_per(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Any row per key; fixed as the smallest one."""
    cols = order or [c for c in df.columns if c not in keys]
    return top_one(df, keys, [F.asc_nulls_last(c) for c in cols])


def dedup_events(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_one(df, keys, [F.asc_nulls_last(c) for c in order])


def distinct_keys(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    return df.select(*cols).distinct()


def order_key(ts: str, nulls: str = "last", tiebreak: Sequence[str] = (), where: str | None = None) -> Column:
    """Sort struct for ``max_by``: NULL times lose (``last``) or win (``first``); rows outside ``where`` are ignored."""
    wins = f"{ts} IS NOT NULL" if nulls == "last" else f"{ts} IS NULL"
    key = f"struct({', '.join([f'{wins} AS w', f'{ts} AS ts', *tiebreak])})"
    return F.expr(key if where is None else f"CASE WHEN {where} THEN {key} END")


def any_flag_then_latest(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, str],
    ts: str,
    nulls: str = "last",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The latest row per key, plus flags that are 1 when *any* row of the key matches.

    One map-side-combined aggregation instead of a whole-partition window.
    """
    rest = [c for c in df.columns if c not in keys]
    agg = [
        F.max_by(F.struct(*rest), order_key(ts, nulls, tiebreak)).alias("__row"),
        *[F.expr(f"max(CASE WHEN {cond} THEN 1 ELSE 0 END)").alias(name) for name, cond in flags.items()],
    ]
    return df.groupBy(*keys).agg(*agg).select(*keys, "__row.*", *flags)


def latest_valid(
    df: DataFrame, key: str, ts: str, code: str, valid: Sequence[str], default: str | None = None
) -> DataFrame:
    """Last recognised code per key; unrecognised codes are skipped. Equal times: largest code.

    With ``default``, keys that only have unrecognised codes are kept and get it.
    """
    ok = F.col(code).isin(list(valid))
    src = df if default is not None else df.filter(ok)
    last = F.max(F.when(ok, F.struct(F.col(ts).alias("ts"), F.col(code).alias("code"))))["code"]
    value = last if default is None else F.coalesce(last, F.lit(default))
    return src.groupBy(key).agg(value.alias(code))
