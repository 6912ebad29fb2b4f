"""App opens by role, and the time from a banner view to the first action."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACTION_STATES, ROLE_GROUP, FunnelConfig
from ..functions.labels import in_sql, role_group
from ..functions.predicates import live
from ..functions.rates import pct, whole
from ..functions.temporal import instant_sql, period_anchored, second_diff
from ..operators.aggregates import count_if, nearest_rank
from ..operators.asof import first_after
from ..operators.dedup import one_per
from ..operators.joins import lookup
from ..session import stage
from .base import entity_lookup
from .tables import Tables

LAUNCH_EVENT = "App Launched"


def device_days(t: Tables, date_from: dt.date) -> DataFrame:
    """Opens per device and day, each (device, time, name) counted once.

    The entity and role of an open depend on its device only, so the duplicate removal and
    the daily count come before the joins: a device holding a third of the events reaches the
    join as one row per day.
    """
    ts = F.try_to_timestamp("ts_text")
    events = live(t.app_events, "deleted", "lenient").filter(
        (F.col("event_name") == LAUNCH_EVENT) & (ts >= F.lit(date_from).cast("timestamp"))
    )
    once = events.select("device_id", "ts_text", "event_name").distinct()
    return once.groupBy("device_id", F.to_date(ts).alias("dt")).agg(F.count(F.lit(1)).alias("n"))


def device_owner(t: Tables, roster: DataFrame) -> DataFrame:
    """device -> (pid, role group): one rostered entity per device, the smallest."""
    ids = roster.select("pid")
    entity = live(t.entities, "active", "current").select("csp_id", F.col("partner_id").cast("string").alias("pid"))
    entity = entity.distinct().join(ids, ["pid"], "left_semi")
    profiles = live(t.app_profiles, "deleted", "lenient").select(
        "device_id", "csp_id", role_group("role", ROLE_GROUP).alias("rg")
    )
    pairs = profiles.distinct().join(entity, ["csp_id"]).select("device_id", "pid", "rg")
    return one_per(pairs, ["device_id"], ["pid", "rg"])


def open_rates(t: Tables, roster: DataFrame, cfg: FunnelConfig, date_from: dt.date) -> DataFrame:
    """Per period and role: opens, distinct active entity-days, opens per day (all rostered entities)."""
    owners = device_owner(t, roster).filter(F.col("rg").isNotNull())
    opens = device_days(t, date_from).join(owners, ["device_id"])
    opens = opens.groupBy("pid", "rg", "dt").agg(F.sum("n").alias("n"))
    rows = opens.join(roster.select("pid", "ad"), ["pid"])
    rows = rows.withColumn("period", period_anchored("dt", "ad", cfg.as_of)).filter(F.col("period").isNotNull())
    # (pid, dt) is unique inside (period, rg), so counting rows counts distinct active days.
    per_role = rows.groupBy("period", "rg").agg(
        F.sum("n").cast("bigint").alias("opens"), F.count(F.lit(1)).alias("active_days")
    )
    live_roster = roster.filter(F.col("days") >= 1)
    rated = per_role.withColumn("entities", live_roster.select(F.count(F.lit(1))).scalar()).withColumn(
        "entity_days", live_roster.select(F.sum("days")).scalar()
    )
    return rated.withColumn("opens_d", whole("opens * entities", "entity_days")).select(
        "period", "rg", "opens", "active_days", "opens_d"
    )


def open_totals(rates: DataFrame) -> DataFrame:
    """Total opens per day over the roles, a row for either period; NULL without roles or when every role rounds to zero."""
    found = rates.groupBy("period").agg(F.nullif(F.sum("opens_d"), F.lit(0).cast("bigint")).alias("total_d"))
    return rates.sparkSession.createDataFrame([("PRE",), ("POST",)], "period string").join(found, "period", "left")


def viewers(roster: DataFrame) -> DataFrame:
    """Live entities that viewed the banner, with the first view as a UTC time."""
    seen = roster.filter((F.col("days") >= 1) & (F.coalesce("view_fs", F.lit(0)) != 0))
    return seen.select("pid", F.timestamp_seconds("view_fs").cast("timestamp_ntz").alias("view_ts"))


def view_actions(
    views: DataFrame, t: Tables, cfg: FunnelConfig, states: Sequence[str] = ACTION_STATES
) -> DataFrame:
    """pid, view_ts, first action strictly after the view, minutes between them.

    Both sides are read twice by the as-of look-up (layout, carry), so each is written once.
    """
    views = stage(views, "views")
    actions = t.history.filter(
        f"created_at >= {instant_sql(cfg.launch)} AND {in_sql('current_state', states)}"
    ).select("csp_id", F.col("updated_at").alias("a_ts"))
    entity = entity_lookup(t).join(
        views.select(F.col("pid").alias("partner_id")).distinct(), ["partner_id"], "left_semi"
    )
    # Only actions of viewers are shuffled for their copies, and these collapse in the map tasks first.
    by_entity = actions.join(entity, ["csp_id"]).select(F.col("partner_id").alias("pid"), "a_ts").distinct()
    hits = first_after(views, stage(by_entity, "actions"), ["pid"], "view_ts", "a_ts", "action_ts")
    minutes = F.round(second_diff("view_ts", "action_ts") / F.lit(60.0)).cast("bigint")
    return hits.withColumn("mins", minutes)


def view_to_action(rows: DataFrame) -> DataFrame:
    """One row: viewers, acted, share, nearest-rank median and 75th percentile, share within 24 hours."""
    mins = F.when(F.col("mins") >= 0, F.col("mins"))
    src = rows.select(mins.alias("value"))
    agg = src.agg(
        F.count(F.lit(1)).alias("n_viewed"),
        F.count("value").alias("acted"),
        nearest_rank("value", 0.5).cast("bigint").alias("median_min"),
        nearest_rank("value", 0.75).cast("bigint").alias("p75_min"),
        count_if("value <= 1440").alias("within24h"),
    )
    return agg.select(
        "n_viewed",
        "acted",
        pct("acted", "n_viewed").alias("acted_pct"),
        "median_min",
        "p75_min",
        F.when(F.col("acted") > 0, pct("within24h", "n_viewed")).alias("within24h_pct"),
    )
