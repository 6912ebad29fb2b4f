"""Decline rate, installs per day and hour, day/hour cells."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..functions.predicates import live
from ..functions.rates import pct
from ..functions.temporal import date_sql, instant_sql, local_time, period_fixed
from ..operators.aggregates import count_if
from ..operators.cells import tagged_cells
from ..operators.dedup import earliest_by
from ..operators.joins import lookup
from .base import entity_lookup
from .tables import Tables


def _entity_cohort(t: Tables, roster_ids: DataFrame) -> DataFrame:
    """csp_id -> enrolled flag; an entity without a known partner counts as not enrolled."""
    ids = roster_ids.select(F.col("pid").alias("partner_id"), F.lit(1).alias("enr"))
    return entity_lookup(t).join(ids, ["partner_id"], "left").select("csp_id", F.coalesce("enr", F.lit(0)).alias("enr"))


def decline_rate(t: Tables, roster_ids: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Of the leads offered (every current candidate), how many were declined; by UTC creation date.

    Offers are counted per entity and day before the entity look-up.
    """
    day = F.to_date("created_at")
    period = period_fixed("day", (cfg.pre_start, cfg.pre_end), (cfg.launch, cfg.as_of))
    offers = (
        live(t.candidates, "etl_current", "current")
        .filter(
            # Bounds on the raw column, so that they reach the scan.
            f"created_at >= {instant_sql(cfg.pre_start)} AND created_at < {instant_sql(cfg.today)}"
        )
        .groupBy("csp_id", day.alias("day"))
        .agg(F.count(F.lit(1)).alias("offers"), count_if("current_state = 'DECLINED'").alias("declined"))
    )
    rows = offers.join(_entity_cohort(t, roster_ids), ["csp_id"]).withColumn("period", period)
    out = rows.filter(F.col("period").isNotNull()).groupBy(
        "period", F.when(F.col("enr") == 1, "E").otherwise("N").alias("coh")
    ).agg(F.sum("offers").alias("offers"), F.sum("declined").alias("declined"))
    return out.withColumn("decline_pct", pct("declined", "offers", zero_den=0.0))


def with_declines(block: DataFrame, declines: DataFrame) -> DataFrame:
    """PRE/POST blocks with the declines of the same period and cohort; NULL where no lead was offered."""
    found = declines.select("period", "coh", F.col("offers").alias("decline_offers"), F.col("declined").alias("decline_count"), "decline_pct")
    return block.join(found, ["period", "coh"], "left")


def _first_installs(t: Tables, cfg: FunnelConfig, date_from: dt.date) -> DataFrame:
    """First completion per connection, in local time, from ``date_from`` on."""
    done = live(t.candidates, "etl_current", "current").filter(F.col("installation_completed_at").isNotNull())
    first = earliest_by(
        done.select("connection_id", "csp_id", "installation_completed_at", "execution_candidate_id"),
        ["connection_id"],
        "installation_completed_at",
        ["execution_candidate_id"],
    )
    local = local_time("installation_completed_at", cfg.offset_minutes)
    return first.select("csp_id", F.to_date(local).alias("d"), F.hour(local).alias("hr")).filter(
        F.col("d") >= F.lit(date_from)
    )


def _counted(t: Tables, roster_ids: DataFrame, installs: DataFrame, keys: list[str]) -> DataFrame:
    per_entity = installs.groupBy("csp_id", *keys).agg(F.count(F.lit(1)).alias("n"))
    rows = per_entity.join(_entity_cohort(t, roster_ids), ["csp_id"])
    return rows.groupBy(*keys).agg(
        F.sum(F.col("n") * F.col("enr")).alias("enr"), F.sum("n").alias("allc")
    )


def installs_daily(t: Tables, roster_ids: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Installs per local day since launch, up to the last complete day."""
    rows = _first_installs(t, cfg, cfg.launch).filter(F.col("d") <= F.lit(cfg.as_of))
    return _counted(t, roster_ids, rows, ["d"])


def installs_hourly(t: Tables, roster_ids: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Installs per local day and hour of the current month."""
    return _counted(t, roster_ids, _first_installs(t, cfg, cfg.month_start), ["d", "hr"])


def cells(base: DataFrame, date_from: dt.date) -> DataFrame:
    """B bookings, I / J installs of enrolled / other entities, K bookings that got installed; one pass."""
    recent = f"to_date(inst_ts) >= {date_sql(date_from)}"
    book = ("booking_date", "bhr")
    inst = ("to_date(inst_ts)", "hour(inst_ts)")
    return tagged_cells(
        base,
        [
            ("B", *book, "coh = 'E' AND cur_depth >= 2"),
            ("I", *inst, f"coh = 'E' AND {recent}"),
            ("J", *inst, f"coh = 'N' AND {recent}"),
            ("K", *book, "coh = 'E' AND cur_depth >= 7"),
        ],
    )


def daily_panel(cell_rows: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """b, i, j per complete day; days without one of them show 0."""
    rows = cell_rows.filter((F.col("k") != "K") & (F.col("d") <= F.lit(cfg.as_of)))

    def total(tag: str) -> Column:
        return F.sum(F.when(F.col("k") == tag, F.col("n")).otherwise(0)).cast("bigint")

    return rows.groupBy("d").agg(total("B").alias("b"), total("I").alias("i"), total("J").alias("j"))


def hourly_panel(cell_rows: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Heat-map cells of B, I and K up to and including today."""
    return cell_rows.filter(F.col("k").isin("B", "I", "K") & (F.col("d") <= F.lit(cfg.today)))
