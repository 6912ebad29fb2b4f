"""Guarantee class of each rostered entity, to date and projected to the month's end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CLASS_LABELS, FunnelConfig
from ..operators.aggregates import count_if
from ..operators.joins import zero_fill


def entity_measures(entity_base: DataFrame) -> DataFrame:
    """Received, confirmed, installed per enrolled entity in POST. Confirmation also accepts "reached"."""
    post = entity_base.filter((F.col("coh") == "E") & (F.col("period") == "POST") & F.col("mgpid").isNotNull())
    return post.groupBy(F.col("mgpid").alias("pid")).agg(
        count_if("cur_depth >= 2").alias("received"),
        count_if("cur_depth >= 4 AND 1 IN (conf48, asgn48, reached48, inst48)").alias("confirmed"),
        count_if("cur_depth >= 7 AND inst48 = 1").alias("installed"),
    )


def classify_entities(entity_base: DataFrame, roster: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """pid, days, received, confirmed, installed, mg (actual), mgp (projected).

    Entities without leads count with zeros; entities not live for a full day are left out.
    All comparisons are exact integer cross-products.
    """
    live = roster.filter(F.col("days") >= 1).select("pid", "days")
    rows = zero_fill(live, entity_measures(entity_base), "pid", ["received", "confirmed", "installed"])
    gate = f"confirmed > 0 AND installed * 100 >= confirmed * {cfg.gate_percent}"
    projected = f"confirmed * (days + {cfg.month_remaining}) < days * {cfg.min_confirmed}"
    return rows.selectExpr(
        "*",
        f"CASE WHEN confirmed < {cfg.min_confirmed} THEN 'mg_lo' WHEN {gate} THEN 'mg_hi' ELSE 'no_mg' END AS mg",
        f"""CASE WHEN days < {cfg.early_days} THEN 'too_early' WHEN {projected} THEN 'mg_lo'
            WHEN {gate} THEN 'mg_hi' ELSE 'no_mg' END AS mgp""",
    )


def class_counts(classes: DataFrame, label: str) -> DataFrame:
    """Entities of each class, 0 for classes without any; only the projected label has ``too_early``."""
    keys = [k for k in CLASS_LABELS if label == "mgp" or k != "too_early"]
    found = classes.groupBy(F.col(label).alias("key")).agg(F.count(F.lit(1)).alias("entities"))
    every = classes.sparkSession.createDataFrame([(k,) for k in keys], "key string")
    return every.join(found, "key", "left").select("key", F.coalesce("entities", F.lit(0).cast("bigint")).alias("entities"))


def projection_totals(classes: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Bookings and installs projected to the month's end; early entities held at their actuals."""
    days = F.col("days")
    factor = F.when(days < cfg.early_days, F.lit(1.0)).otherwise((days + cfg.month_remaining) / days)
    per_day = classes.groupBy("days").agg(F.sum("received").alias("r"), F.sum("installed").alias("i"))
    return per_day.agg(
        F.round(F.sum(F.col("r") * factor)).cast("bigint").alias("bookings"),
        F.round(F.sum(F.col("i") * factor)).cast("bigint").alias("installs"),
    )

