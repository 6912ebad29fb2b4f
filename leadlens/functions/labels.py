"""Stage ladders, look-up labels and display text. Arguments are SQL expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_sql(value: str | int | None) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_sql(expr: str, values: Sequence[str]) -> str:
    return f"{expr} IN ({', '.join(text_sql(v) for v in values)})"


def stage_depth(rules: Sequence[tuple[str, int | str]], default: int | str) -> Column:
    """First matching rung wins."""
    rungs = " ".join(f"WHEN {cond} THEN {text_sql(depth)}" for cond, depth in rules)
    return F.expr(f"CASE {rungs} ELSE {text_sql(default)} END")


def _lookup_sql(expr: str, mapping: Mapping) -> str:
    table = ", ".join(f"{text_sql(k)}, {text_sql(v)}" for k, v in mapping.items())
    return f"try_element_at(map({table}), {expr})"


def rank_of(state: str, mapping: Mapping[str, int], default: int = 0) -> Column:
    return F.expr(f"coalesce({_lookup_sql(state, mapping)}, {int(default)})")


def depth_of_rank(rank: str, steps: Sequence[tuple[int, int]], default: int = 2) -> Column:
    return stage_depth([(f"{rank} >= {lo}", depth) for lo, depth in steps], default)


def cohort_label(roster_id: str, entity_id: str) -> Column:
    """E when rostered, N when the entity is known, else NULL."""
    return F.expr(f"CASE WHEN {roster_id} IS NOT NULL THEN 'E' WHEN {entity_id} IS NOT NULL THEN 'N' END")


def role_group(role: str, mapping: Mapping[str, str]) -> Column:
    return F.expr(_lookup_sql(f"upper({role})", mapping))


def label_of(code: str, mapping: Mapping[str, str]) -> Column:
    """Display label; the code itself when it has none."""
    return F.expr(f"coalesce({_lookup_sql(code, mapping)}, {code})")


def mask_key(key: str) -> Column:
    """First two characters, XXXXX, last three."""
    return F.expr(f"concat(left({key}, 2), 'XXXXX', right({key}, 3))")


def reason_text(reason: str, fallback: str, sub: str) -> Column:
    """``reason or fallback or ''`` followed by ``' / sub'``; empty text counts as missing."""
    head = f"coalesce(nullif({reason}, ''), nullif({fallback}, ''), '')"
    return F.expr(f"concat({head}, coalesce(concat(' / ', nullif({sub}, '')), ''))")


def display_ts(ts: str) -> Column:
    return F.expr(f"date_format({ts}, 'MM/dd HH:mm')")
