"""Conditional counts, exact medians, and multi-dimension cuts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Conditions and values are SQL expressions.
Counts = Mapping[str, str]
Medians = Mapping[str, tuple[str, str]]


def count_if(cond: str) -> Column:
    """Matching rows; 0, not NULL, when none match."""
    return F.expr(f"coalesce(sum(CASE WHEN {cond} THEN 1L ELSE 0L END), 0L)")


def count_if_all(conds: Counts) -> list[Column]:
    return [count_if(cond).alias(name) for name, cond in conds.items()]


def first_time_when(conds: Mapping[str, str], ts: str) -> list[Column]:
    return [F.expr(f"min(CASE WHEN {cond} THEN {ts} END)").alias(name) for name, cond in conds.items()]


def median_round(cond: str, value: str) -> Column:
    """Interpolated median of the matching values, rounded to a whole number (double)."""
    return F.expr(f"round(median(CASE WHEN {cond} THEN {value} END))")


def nearest_rank(value: str, p: float) -> Column:
    """``sorted(values)[int(n * p)]`` for p below 1, n * p taken exactly: a discrete percentile counted from the top.

    1 - p is a decimal, less a hair, so that n * (1 - p) never rounds up past a whole number (for n below 10 ** 9).
    """
    from_top = max(Decimal(1) - Decimal(str(p)) - Decimal("1e-11"), Decimal(0))
    return F.expr(f"percentile_disc({from_top:f}D) WITHIN GROUP (ORDER BY {value} DESC)")


def group_funnel(df: DataFrame, keys: Sequence[str], counts: Counts, medians: Medians) -> DataFrame:
    """Counts and rounded medians per key. Median state is one counter per distinct whole minute."""
    return df.groupBy(*keys).agg(
        *count_if_all(counts), *[median_round(c, v).alias(n) for n, (c, v) in medians.items()]
    )


_M, _V, _FREQ = "__measure", "__minute", "__freq"


def funnel_cells(df: DataFrame, keys: Sequence[str], counts: Counts, medians: Medians) -> DataFrame:
    """Facts reduced to (all keys, measure, value): counts plus a frequency table per median, fractions kept.

    One narrow hash aggregation with map-side combine. Cuts are then built from these
    cells, so grouping sets multiply a small table instead of the facts.
    """
    # Measure -1 stands for the row itself and carries the counts.
    observed = [(-1, "CAST(NULL AS DOUBLE)")]
    observed += [
        (i, f"CAST(CASE WHEN {cond} THEN {value} END AS DOUBLE)") for i, (cond, value) in enumerate(medians.values())
    ]
    structs = ", ".join(f"named_struct('{_M}', {i}, '{_V}', {value})" for i, value in observed)
    flat = df.selectExpr(
        *keys,
        *[f"CASE WHEN {cond} THEN 1L ELSE 0L END AS {name}" for name, cond in counts.items()],
        f"inline(array({structs}))",
    ).filter(f"{_M} = -1 OR {_V} IS NOT NULL")
    return flat.groupBy(*keys, _M, _V).agg(
        *[F.expr(f"sum(CASE WHEN {_M} = -1 THEN {name} ELSE 0L END)").alias(name) for name in counts],
        F.expr("count(1)").alias(_FREQ),
    )


def _cell_aggs(counts: Sequence[str], medians: Sequence[str]) -> list[Column]:
    out = [F.expr(f"sum({name})").alias(name) for name in counts]
    for i, name in enumerate(medians):
        out.append(F.expr(f"round(percentile(CASE WHEN {_M} = {i} THEN {_V} END, 0.5D, {_FREQ}))").alias(name))
    return out


def cut_by(
    df: DataFrame, fixed: Sequence[str], dims: Sequence[str], counts: Counts, medians: Medians
) -> DataFrame:
    """One grouping set (fixed..., dim) per dimension, with a ``g_<dim>`` grouping flag each."""
    cells = funnel_cells(df, [*fixed, *dims], counts, medians)
    sets = [[*fixed, d] for d in dims]
    flags = [F.grouping(d).cast("int").alias(f"g_{d}") for d in dims]
    return cells.groupingSets(sets, *fixed, *dims).agg(*flags, *_cell_aggs(list(counts), list(medians)))


def pick_cut(cuts: DataFrame, fixed: Sequence[str], dims: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Long form (fixed..., dim, key, measures); rows whose key is truly NULL are dropped."""
    dim = " ".join(f"WHEN g_{d} = 0 THEN '{d}'" for d in dims)
    key = " ".join(f"WHEN g_{d} = 0 THEN CAST({d} AS STRING)" for d in dims)
    out = cuts.selectExpr(*fixed, f"CASE {dim} END AS dim", f"CASE {key} END AS key", *measures)
    return out.filter("key IS NOT NULL")


def entity_days(roster: DataFrame, by: Sequence[str], days: str = "days") -> DataFrame:
    """Live days and entities per group; entities not live for a full day are left out."""
    return roster.filter(F.col(days) >= 1).groupBy(*by).agg(
        F.expr(f"CAST(sum({days}) AS BIGINT)").alias("entity_days"), F.expr("count(1)").alias("entities")
    )


def complement_count(df: DataFrame, entity: str, city: str, pattern: str, roster: DataFrame) -> DataFrame:
    """Distinct entities in matching cities that are not rostered (one row)."""
    ids = df.filter(F.col(city).ilike(pattern) & F.col(entity).isNotNull()).select(
        F.col(entity).cast("string").alias("pid")
    ).distinct()
    return ids.join(roster.select("pid"), ["pid"], "left_anti").agg(F.count(F.lit(1)).alias("entities"))
