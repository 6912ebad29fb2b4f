"""Guarded JSON sink: a document of panels becomes visible as a whole or not at all."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "version string, failed array<string>"


class EmptyPanel(RuntimeError):
    """A required panel has no rows; nothing was published."""


def publish_json(
    panels: Mapping[str, DataFrame | Callable[[], DataFrame]],
    path: str,
    require: Sequence[str] = (),
    order: Mapping[str, Sequence[str | Column]] | None = None,
    as_text: Sequence[str] = (),
) -> list[str]:
    """Write one folder of JSON lines per panel to a fresh version below ``path``, then name the version.

    Each panel is computed once, and what was written is checked. A required panel that is empty or fails raises, and readers
    go on seeing the version before. Another panel that fails in Spark is left out; its name and error are noted with the
    version. Versions follow the writer's clock. Panels in ``as_text`` have one string column, which is written as it is. Returns
    the folders of the panels.
    """
    unknown = set(require).difference(panels)
    if unknown:
        raise KeyError(f"required panels that are not there: {sorted(unknown)}")
    spark = SparkSession.active()
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    written, failed = [], []
    for name in sorted(panels, key=lambda n: n not in require):  # the required ones first
        target, by = f"{path}/{version}/{name}", (order or {}).get(name)
        try:
            panel = panels[name]() if callable(panels[name]) else panels[name]
            writer = (panel.orderBy(*by) if by else panel).write
            writer.text(target) if name in as_text else writer.json(target)
        except PySparkException as error:
            if name in require:
                raise
            failed.append(f"{name}: {type(error).__name__}: {str(error)[:300]}")
            continue
        if name in require and spark.read.text(target).isEmpty():
            raise EmptyPanel(f"panel {name!r} is empty; nothing was published")
        written.append(target)
    # One row in one file, appended last: readers see all panels of a version or none.
    spark.createDataFrame([(version, failed)], VERSIONS).coalesce(1).write.mode("append").json(f"{path}/versions")
    return written


def published(spark: SparkSession, path: str) -> str | None:
    """The folder of the newest published version, or None."""
    try:
        newest = spark.read.schema(VERSIONS).json(f"{path}/versions").agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return newest and f"{path}/{newest}"
