"""Small expressions shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The column with null read as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once a row, inside one expression."""
    return F.transform(F.array(value), body)[0]


def packed(df: DataFrame) -> DataFrame:
    """The rows as one struct ``row``, so that no input column can clash with a computed one."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_free(df: DataFrame, name: str) -> DataFrame:
    """``stage``, and the shuffle files of the write are removed when it ends: what is read later is the written table."""
    conf, setting = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(setting, None)
    conf.set(setting, "true")
    try:
        return stage(df, name)
    finally:
        conf.unset(setting) if before is None else conf.set(setting, before)
