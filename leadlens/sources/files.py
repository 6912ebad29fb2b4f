"""Readers for the input relations and the JSON inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SCREEN_FIELDS


def scan(
    spark: SparkSession,
    source: str,
    cols: Sequence[str | Column] | None = None,
    where: Column | None = None,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A parquet path, a catalog table, or (with ``jdbc`` options) a database relation.

    Filter and projection are part of the plan, so they reach the parquet scan / the database.
    """
    if jdbc is not None:
        df = spark.read.format("jdbc").options(dbtable=source, **jdbc).load()
    elif "/" in source:
        df = spark.read.parquet(source)
    else:
        df = spark.table(source)
    if where is not None:
        df = df.filter(where)
    return df.select(*cols) if cols else df


def read_cohorts(
    spark: SparkSession, path: str, flows: Sequence[str] = ("flow1", "flow2"), lines: bool = False
) -> DataFrame:
    """``{flow1: [id], flow2: [id]}`` documents -> (entity, flow) rows.

    One document per file, or (``lines``) one per line, which splits over tasks.
    """
    schema = T.StructType([T.StructField(f, T.ArrayType(T.StringType())) for f in flows])
    docs = spark.read.schema(schema).json(path, multiLine=not lines)

    def tagged(flow: str) -> Column:
        ids = F.coalesce(F.col(flow), F.array().cast("array<string>"))
        return F.transform(ids, lambda e: F.struct(e.alias("pid"), F.lit(flow).alias("flow")))

    pairs = F.flatten(F.array(*[tagged(f) for f in flows]))
    return docs.select(F.inline(pairs)).distinct()


PROFILE_EVENTS = T.MapType(
    T.StringType(),
    T.StructType([T.StructField("count", T.LongType()), T.StructField("first_seen", T.LongType())]),
)


def profile_schema(screen_fields: Sequence[str]) -> T.StructType:
    data = T.StructType([T.StructField(f, T.StringType()) for f in screen_fields])
    record = T.StructType([T.StructField("profileData", data), T.StructField("events", PROFILE_EVENTS)])
    return T.StructType([T.StructField("identity", T.StringType()), T.StructField("record", record)])


def read_profiles(spark: SparkSession, path: str, screen_fields: Sequence[str] = SCREEN_FIELDS) -> DataFrame:
    """JSON lines of profiles -> identity, screen (first non-empty field), events map.

    Identities without a record are dropped, as a failed look-up is.
    """
    raw = spark.read.schema(profile_schema(screen_fields)).json(path).filter(F.col("record").isNotNull())
    empty = F.lit("")
    screen = F.coalesce(*[F.nullif(F.col(f"record.profileData.{f}"), empty) for f in screen_fields], empty)
    return raw.select("identity", screen.alias("screen"), F.col("record.events").alias("events"))


def read_hourly(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays (JSON lines) -> one row per hour; missing rain and cloud count as 0."""
    hourly = T.StructType(
        [
            T.StructField("time", T.ArrayType(T.StringType())),
            T.StructField("precipitation", T.ArrayType(T.DoubleType())),
            T.StructField("cloud_cover", T.ArrayType(T.DoubleType())),
        ]
    )
    schema = T.StructType([*[T.StructField(k, T.StringType()) for k in keys], T.StructField("hourly", hourly)])
    zipped = F.arrays_zip("hourly.time", "hourly.precipitation", "hourly.cloud_cover")
    rows = spark.read.schema(schema).json(path).select(*keys, F.inline(zipped))
    return rows.select(
        *keys,
        F.to_timestamp_ntz("time", F.lit("yyyy-MM-dd'T'HH:mm")).alias("ts"),
        F.coalesce("precipitation", F.lit(0.0)).alias("precip"),
        F.coalesce("cloud_cover", F.lit(0.0)).alias("cloud"),
    )
