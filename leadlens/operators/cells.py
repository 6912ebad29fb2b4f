"""Several tagged aggregations over one base in a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_cells(base: DataFrame, tags: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """``(k, d, hr, n)`` for each ``(tag, date, hour, condition)``, all SQL expressions.

    Equals a UNION ALL of one aggregation per tag, but reads the base once: each row
    is expanded to the tags it satisfies and counted with map-side combine.
    """
    entries = ", ".join(
        f"CASE WHEN {cond} THEN named_struct('k', '{tag}', 'd', CAST({day} AS DATE), 'hr', CAST({hour} AS INT)) END"
        for tag, day, hour, cond in tags
    )
    rows = base.selectExpr(f"inline(array_compact(array({entries})))")
    return rows.groupBy("k", "d", "hr").agg(F.count(F.lit(1)).alias("n"))
