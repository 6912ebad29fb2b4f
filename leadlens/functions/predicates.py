"""Row filters whose NULL handling matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIVE_MODES = {
    "strict": "NOT {0}",
    "lenient": "NOT coalesce({0}, false)",
    "current": "{0}",
}


def live_sql(flag: str, mode: str = "strict") -> str:
    """``strict``: deleted = FALSE; ``lenient``: FALSE or NULL; ``current``: active = TRUE."""
    return LIVE_MODES[mode].format(flag)


def live(df: DataFrame, flag: str, mode: str = "strict") -> DataFrame:
    return df.filter(live_sql(flag, mode))


def exclude_values(df: DataFrame, col: str, values: Sequence, keep_null: bool = True) -> DataFrame:
    cond = ~F.col(col).isin(list(values))
    return df.filter(cond | F.col(col).isNull() if keep_null else cond)


def iff(cond: str | Column, yes, no) -> Column:
    """NULL conditions take the else branch."""
    return F.when(F.expr(cond) if isinstance(cond, str) else cond, yes).otherwise(no)


def flag(cond: str | Column) -> Column:
    return iff(cond, 1, 0)
