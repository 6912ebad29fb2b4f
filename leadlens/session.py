"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: The folder of the staging block that is open, if any.
_BLOCK: ContextVar[str | None] = ContextVar("leadlens_staging", default=None)


def build_session(app: str = "leadlens", master: str | None = None, **conf) -> SparkSession:
    """A session with UTC time and adaptive skew handling; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Skips the per-call stack capture of Column functions: plans are built much faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # A document compiles several hundred stages; the default cache of 100 recompiles them on each refresh.
        .config("spark.sql.codegen.cache.maxEntries", "4000")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in a local session without any (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="leadlens-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_BLOCK.get() or f'{shared_dir(spark)}/leadlens'}/{uuid.uuid4().hex}/{name}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Tables staged inside the block share one folder, which is removed when the block ends, also by an error.

    Use their results inside the block, or publish them there. What is staged outside any block stays until the caller clears the
    shared folder.
    """
    folder = f"{_BLOCK.get() or f'{shared_dir(spark)}/leadlens'}/block-{uuid.uuid4().hex}"
    outer = _BLOCK.set(folder)
    try:
        yield folder
    finally:
        _BLOCK.reset(outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several panels: the copy is columnar (each panel
    reads only its columns), survives lost executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*makes: Callable) -> list:
    """The results of independent steps. Their jobs run at the same time, so that the tail of one does not idle the cluster.

    All steps end before an error of one is raised.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(makes)) as pool:
        futures = [pool.submit(copy_context().run, inherit(make)) for make in makes]
    return [f.result() for f in futures]
