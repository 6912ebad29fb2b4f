"""Streaming forms of the event dedup and the hour-by-day counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path


def exactly(path: str) -> str:
    """A file pattern that matches this path alone, whatever characters it has.

    Streams take a plain path for a folder; a pattern may also name a single file.
    """
    plain = path.rstrip("/") or "/"
    escaped = [f"\\{c}" if c in "{}[]*?\\," else c for c in plain]
    if plain == escaped[-1] or len(escaped[-1]) > 1 or plain[-1] == "/":
        return "".join(escaped)
    return f"{''.join(escaped[:-1])}[{plain[-1]}]"


def read_event_stream(spark: SparkSession, path: str, files_per_trigger: int = 64, schema: T.StructType | str | None = None) -> DataFrame:
    """File stream over a parquet folder or a single parquet file.

    A folder that has no file yet needs ``schema``; otherwise the files' own is taken.
    """
    pattern = exactly(path)
    if schema is None:
        schema = spark.read.parquet(pattern).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(pattern)


def _event_time(sdf: DataFrame, ts: str) -> DataFrame:
    """Watermarks need an instant; zone-less UTC times are cast (session time zone UTC)."""
    return sdf.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedup(sdf: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First arrival of each key; state is dropped once the watermark passes."""
    return _event_time(sdf, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys])


def stream_hourly_cells(sdf: DataFrame, ts: str, by: Sequence[str], delay: str) -> DataFrame:
    """Events per hour and group; rows later than the watermark are dropped."""
    counted = _event_time(sdf, ts).withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w"), *by).count()
    start = F.col("w.start").cast("timestamp_ntz")
    return counted.select(
        F.to_date(start).alias("d"), F.hour(start).alias("hr"), *by, F.col("count").alias("n")
    )


def run_available(sdf: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything that is available now into the shared folder and read the result.

    ``update`` results are upserted by batch: the caller picks the newest row per key from ``batch``. Without input there
    are no rows.
    """
    spark = sdf.sparkSession
    out, ckpt = fresh_path(spark, f"{name}/data"), fresh_path(spark, f"{name}/checkpoint")
    if mode == "append":
        writer = sdf.writeStream.format("parquet").outputMode("append").option("path", out)
    else:

        def write(batch: DataFrame, batch_id: int) -> None:
            # The batch id is part of the path, so a repeated batch overwrites itself.
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        writer = sdf.writeStream.outputMode(mode).foreachBatch(write)
    query = writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    schema = sdf.schema if mode == "append" else T.StructType([*sdf.schema, T.StructField("batch", T.IntegerType())])
    try:
        return spark.read.schema(schema).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # no batch was written
            raise
        return spark.createDataFrame([], schema)
