"""Who is enrolled, since when, and with which attributes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ANSWER_CODES, EVENT_PREFIXES, NOT_ANSWERED, OWNER_ROLES, SCREENS, FunnelConfig
from ..functions.labels import in_sql
from ..functions.maps import any_count_with_prefix, min_first_seen
from ..functions.temporal import live_days, local_time
from ..operators.dedup import latest_valid
from ..operators.joins import resolve_identity, semi
from ..session import stage
from .tables import Tables

ENGAGEMENT_FLAGS = ["viewed", "scrolled", "tapped", "ticket"]


def opted(optins: DataFrame, program: str) -> DataFrame:
    """First opt-in per entity for the programme (duplicates: earliest)."""
    return (
        optins.filter((F.col("program") == program) & F.col("first_opted_at").isNotNull())
        .groupBy(F.col("partner_id").cast("string").alias("pid"))
        .agg(F.min("first_opted_at").alias("first_opted_at"))
    )


def enrolled(t: Tables, cfg: FunnelConfig) -> DataFrame:
    """(opted in and flow 1) or (opted in, flow 2 and campaign scan complete)."""
    done = t.campaign.filter(
        (F.col("campaign_id") == cfg.campaign) & F.col("scan_complete_at").isNotNull()
    ).select(F.col("partner_id").cast("string").alias("pid"))
    flow1 = t.cohorts.filter(F.col("flow") == "flow1").select("pid")
    flow2 = semi(t.cohorts.filter(F.col("flow") == "flow2").select("pid"), done, ["pid"])
    return semi(opted(t.optins, cfg.program).select("pid"), flow1.union(flow2), ["pid"])


def anchors(ids: DataFrame, optins: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Enrolled entity -> local date of its first opt-in, not before launch; launch when unknown."""
    launch = F.lit(cfg.launch)
    day = F.to_date(local_time("first_opted_at", cfg.offset_minutes))
    first = opted(optins, cfg.program).select("pid", F.greatest(day, launch).alias("ad"))
    return ids.select("pid").join(first, ["pid"], "left").select("pid", F.coalesce("ad", launch).alias("ad"))


def feedback(
    t: Tables, cfg: FunnelConfig, valid: Sequence[str] = ANSWER_CODES, entity_dim: DataFrame | None = None
) -> DataFrame:
    """Entity -> latest recognised answer of one of its owners."""
    log = t.screen_log.filter(
        "flow = '3' AND pid NOT LIKE 'RAW%' AND (screen LIKE 'f3a_%' OR screen LIKE 'f3b_%')"
    ).selectExpr("try_cast(pid AS BIGINT) AS identity", "substring(screen, 5) AS cat", "ts")
    log = log.filter(F.col("identity").isNotNull() & ~F.col("identity").isin(list(cfg.test_identities)))
    # Latest answer per identity first, so a busy identity is one row before the join.
    last = log.filter(in_sql("cat", valid)).groupBy("identity").agg(F.max(F.struct("ts", "cat")).alias("last"))
    owners = resolve_identity(t.users, t.entity_dim if entity_dim is None else entity_dim, OWNER_ROLES, integer_ids=True)
    answers = last.select("identity", "last.ts", "last.cat").join(owners, ["identity"])
    return latest_valid(answers, "pid", "ts", "cat", valid)


def profile_flags(profiles: DataFrame, prefixes: dict[str, str] = EVENT_PREFIXES) -> DataFrame:
    """identity, screen, one 0/1 flag per event prefix, first view time (epoch seconds)."""
    return profiles.select(
        "identity",
        "screen",
        *[any_count_with_prefix("events", prefix).alias(name) for name, prefix in prefixes.items()],
        min_first_seen("events", prefixes["viewed"]).alias("view_fs"),
    )


def merge_identities(flags: DataFrame, key: str, names: Sequence[str] = ENGAGEMENT_FLAGS) -> DataFrame:
    """Per entity: any-of flags, first non-empty screen (smallest identity), earliest view."""
    screen = F.min(F.when(F.col("screen") != "", F.struct("identity", "screen")))["screen"]
    return flags.groupBy(key).agg(
        F.coalesce(screen, F.lit("")).alias("screen"),
        *[F.max(n).alias(n) for n in names],
        F.min("view_fs").alias("view_fs"),
    )


def engagement(
    t: Tables, entity_dim: DataFrame | None = None, prefixes: dict[str, str] = EVENT_PREFIXES
) -> DataFrame:
    owners = resolve_identity(t.users, t.entity_dim if entity_dim is None else entity_dim, OWNER_ROLES)
    return merge_identities(profile_flags(t.profiles, prefixes).join(owners, ["identity"]), "pid")


def build_roster(
    anchor: DataFrame,
    cats: DataFrame,
    engaged: DataFrame,
    f2: DataFrame,
    as_of: dt.date,
    mg: DataFrame | None = None,
    screens: Sequence[str] = SCREENS,
) -> DataFrame:
    """pid, ad, cat, screen, viewed, scrolled, tapped, ticket, flow, mg, days, view_fs.

    Engagement columns are NULL unless the screen is a targeted one; ``days`` are the
    complete live days of the entity (below 1 when it enrolled after ``as_of``).
    """
    is_f2 = f2.select("pid").distinct().withColumn("__f2", F.lit(True))
    out = (
        anchor.join(cats.select("pid", "cat"), ["pid"], "left")
        .join(engaged, ["pid"], "left")
        .join(is_f2, ["pid"], "left")
    )
    out = out.join(mg.select("pid", "mg"), ["pid"], "left") if mg is not None else out.withColumn(
        "mg", F.lit(None).cast("string")
    )
    targeted = F.col("screen").isin(list(screens))
    return out.select(
        "pid",
        "ad",
        F.coalesce("cat", F.lit(NOT_ANSWERED)).alias("cat"),
        F.when(targeted, F.col("screen")).alias("screen"),
        *[F.when(targeted, F.coalesce(F.col(n), F.lit(0))).alias(n) for n in ENGAGEMENT_FLAGS],
        F.when(F.col("__f2"), "f2").otherwise("f1").alias("flow"),
        "mg",
        live_days("ad", as_of).alias("days"),
        F.when(F.coalesce(F.col("viewed"), F.lit(0)) == 1, F.col("view_fs")).alias("view_fs"),
    )


def owner_scope(t: Tables, ids: DataFrame) -> DataFrame:
    """The entity dimension of the enrolled entities: only their owners are looked up."""
    key = F.col("partner_id").cast("string")
    return t.entity_dim.withColumn("pid", key).join(ids.select("pid"), ["pid"], "left_semi").drop("pid")


def roster(t: Tables, cfg: FunnelConfig, mg: DataFrame | None = None) -> DataFrame:
    """The enrolled entities with anchor, answer, engagement and flow.

    The enrolment set (one id per entity) feeds three branches, so it is written once.
    """
    ids = stage(enrolled(t, cfg), "enrolled")
    scope = owner_scope(t, ids)
    f2 = t.cohorts.filter(F.col("flow") == "flow2")
    return build_roster(
        anchors(ids, t.optins, cfg),
        feedback(t, cfg, entity_dim=scope),
        engagement(t, entity_dim=scope, prefixes=cfg.event_prefixes),
        f2,
        cfg.as_of,
        mg,
        cfg.screens,
    )


def with_class(roster_df: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """Late join of a class column onto the roster as ``mg``."""
    labelled = classes.select("pid", F.col(label).alias("mg"))
    return roster_df.drop("mg").join(labelled, ["pid"], "left")


def longest_live_days(roster_df: DataFrame) -> int | None:
    """One-row aggregate that fixes the scan start (a literal, so that it is pushed to the scan)."""
    return roster_df.filter(F.col("days") >= 1).agg(F.max("days")).first()[0]


def windows(roster_df: DataFrame, cfg: FunnelConfig) -> dict[str, dt.date | int]:
    n_max = longest_live_days(roster_df)
    return {
        "as_of": cfg.as_of,
        "n_days": cfg.n_days,
        "n_max": n_max or 1,
        "pre_start": cfg.pre_start,
        "pre_end": cfg.pre_end,
        "scan_from": cfg.scan_from(n_max),
        "month_remaining": cfg.month_remaining,
    }
