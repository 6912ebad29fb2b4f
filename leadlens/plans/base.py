"""The two shared base tables: one row per booking, and one per booking and entity it reached."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ASSIGNED_OR_LATER, RANK_DEPTH, REACHED_STATES, STAGE_RANKS, STATE_RANK, FunnelConfig
from ..functions.labels import cohort_label, depth_of_rank, in_sql, rank_of, stage_depth
from ..functions.predicates import live
from ..functions.temporal import (
    date_sql,
    instant_sql,
    local_time,
    minute_diff,
    period_anchored,
    shift_minutes,
    shift_sql,
    tat_minutes,
    within_minutes,
)
from ..operators.aggregates import first_time_when
from ..operators.asof import attribute_first
from ..operators.dedup import distinct_keys, earliest_by, latest_by, one_per, order_key
from ..operators.joins import anti_keep_null, attach_roster, lookup
from ..session import stage, together
from .tables import Tables

BOOKING_KEY = ["mobile", "booking_date"]


def clean_bookings(t: Tables, booking_filter: Column) -> DataFrame:
    """One booking per subject and day with the subject's latest live account; test accounts removed.

    Both sides are reduced to one row per key before they meet, so the join never fans out.
    """
    days = earliest_by(t.bookings.filter(booking_filter), BOOKING_KEY, "bt", ["nb"])
    account = latest_by(
        live(t.accounts, "deleted").select("mobile", "account_id", "lco_account_id", "added_time", "group_name"),
        ["mobile"],
        "added_time",
        tiebreak=["account_id", "lco_account_id", "group_name"],
    ).select("mobile", "lco_account_id", F.col("group_name").alias("bflow"))
    joined = lookup(days, account, ["mobile"], row_id=BOOKING_KEY)
    return anti_keep_null(joined, t.test_accounts, ["lco_account_id"], row_id=BOOKING_KEY)


def requests_by_subject(
    t: Tables,
    min_subject: str | None,
    subjects: DataFrame | None = None,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Connection requests with the subject they belong to: event -> connection -> account -> subject.

    Equi joins only; the time window of a booking is applied afterwards by the attribution. ``since`` and ``until`` are
    literal times that bound all windows, so that they reach the scan. With ``subjects`` the events are reduced to
    the connections of these before anything is shuffled for their copies.
    """
    accounts = t.all_accounts.filter(F.col("account_id").isNotNull())
    if min_subject is not None:
        accounts = accounts.filter(F.col("mobile") > min_subject)  # text order
    if subjects is not None:
        accounts = accounts.join(subjects, ["mobile"], "left_semi")
    pairs = distinct_keys(accounts, ["mobile", F.col("account_id").cast("string").alias("account_id")])
    conns = live(t.connections, "active", "current").select(
        "connection_id", F.col("customer_id").cast("string").alias("account_id")
    )
    owned = conns.join(pairs, ["account_id"]).select("mobile", "connection_id")
    events = live(t.event_history, "deleted").filter(F.col("event_type") == "CONNECTION_REQUEST")
    if since is not None:
        events = events.filter(f"event_timestamp >= {since}")
    if until is not None:
        events = events.filter(f"event_timestamp <= {until}")
    if subjects is not None:
        events = events.join(owned.select("connection_id").distinct(), ["connection_id"], "left_semi")
    # Copies of a request collapse in the map tasks.
    events = events.select("connection_id", F.col("event_timestamp").alias("request_ts")).distinct()
    return events.join(owned, ["connection_id"]).select("mobile", "request_ts", "connection_id")


def request_bounds(cfg: FunnelConfig, first_day: dt.date | None, last_day: dt.date | None) -> dict[str, str]:
    """``since`` and ``until``: the times of requests that bookings of these local days can meet."""
    out = {}
    if first_day is not None:
        out["since"] = shift_sql(instant_sql(first_day), -cfg.offset_minutes - 60 * cfg.before_hours)
    if last_day is not None:
        day_end = instant_sql(last_day + dt.timedelta(days=1))
        out["until"] = shift_sql(day_end, 1440 * cfg.after_days - cfg.offset_minutes)
    return out


def attributed_bookings(
    t: Tables,
    cfg: FunnelConfig,
    booking_filter: Column,
    bookings: DataFrame | None = None,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
    **request_scope,
) -> DataFrame:
    """Clean bookings with the connection of their first request (``connection_id`` NULL when none).

    ``first_day`` and ``last_day`` repeat what ``booking_filter`` says of ``booking_date``, the local day of ``bt``.
    Both sides come out of joins and are read twice by the attribution (layout, carry), so each
    is written once.
    """
    if bookings is None:
        bookings = clean_bookings(t, booking_filter)
    scope = {"min_subject": cfg.min_subject, **request_bounds(cfg, first_day, last_day), **request_scope}
    requests = requests_by_subject(t, **scope)
    utc = -cfg.offset_minutes
    bookings, requests = together(lambda: stage(bookings, "bookings"), lambda: stage(requests, "requests"))
    return attribute_first(
        bookings,
        requests,
        ["mobile"],
        shift_sql("bt", utc),
        "request_ts",
        ["connection_id"],
        before_minutes=60 * cfg.before_hours,
        after_minutes=1440 * cfg.after_days,
        next_ts=shift_sql("nb", utc),
        tiebreak=["connection_id"],
        row_id=BOOKING_KEY,
    )


def attributed_since(t: Tables, cfg: FunnelConfig, date_from: dt.date) -> DataFrame:
    """Attributed bookings from ``date_from`` on: the common input of every base."""
    return attributed_bookings(t, cfg, F.col("booking_date") >= F.lit(date_from), first_day=date_from)


def connections_of(rows: DataFrame) -> DataFrame:
    """The connections that attributed bookings met, each once."""
    return rows.filter(F.col("connection_id").isNotNull()).select("connection_id").distinct()


def _only(df: DataFrame, connections: DataFrame | None) -> DataFrame:
    return df if connections is None else df.join(connections, ["connection_id"], "left_semi")


def first_event(t: Tables, event_type: str, name: str, connections: DataFrame | None = None) -> DataFrame:
    events = live(t.event_history, "deleted").filter(F.col("event_type") == event_type)
    return _only(events, connections).groupBy("connection_id").agg(F.min("event_timestamp").alias(name))


ANY_INSTALL = "(coalesce(otp_verified, false) OR installation_completed_at IS NOT NULL OR coalesce(completed_step >= 7, false))"


LATEST = [
    "current_state",
    "csp_id",
    "created_at",
    "proposed_slot_date",
    "confirmed_slot_at",
    "installation_completed_at",
    "executor_id",
]


def candidate_facts(
    t: Tables, date_from: dt.date, cfg: FunnelConfig, connections: DataFrame | None = None
) -> DataFrame:
    """One row per connection (of ``connections``, where given) from one pass over the candidates.

    Latest current row, any-install flag and first creation over the current rows, and the
    first assignment over all rows (history included) created since shortly before the scan start.
    """
    current = "coalesce(etl_current, false)"
    # A missing update time sorts first here.
    order = order_key("updated_at", "first", ["execution_candidate_id"], where=current)
    since = instant_sql(date_from - dt.timedelta(days=cfg.assigned_lookback_days))
    assigned = f"current_state = 'TECHNICIAN_ASSIGNED' AND created_at >= {since}"
    # Grouped by the connection alone: the join with the bookings then has its own exchange, which adaptive execution can split.
    facts = _only(t.candidates, connections).groupBy("connection_id").agg(
        F.max_by(F.struct(*LATEST), order).alias("latest"),
        F.expr(f"max(CASE WHEN {current} THEN 1 END)").alias("has_candidate"),
        F.expr(f"max(CASE WHEN {current} AND {ANY_INSTALL} THEN 1 ELSE 0 END)").alias("inst_any"),
        *first_time_when({"tcreated": current}, "created_at"),
        *first_time_when({"t_assign": assigned}, "updated_at"),
    )
    return facts.selectExpr(
        "connection_id",
        "latest.current_state AS cs",
        "latest.csp_id AS csp_id",
        "latest.created_at AS cur_created",
        "latest.proposed_slot_date AS psd",
        "latest.confirmed_slot_at AS csa",
        "latest.executor_id AS exid",
        "CASE WHEN inst_any = 1 THEN latest.installation_completed_at END AS done_at",
        "has_candidate",
        "inst_any",
        "tcreated",
        "t_assign",
    )


def entity_lookup(t: Tables) -> DataFrame:
    """csp_id -> partner_id, the smallest when an entity has several rows."""
    active = live(t.entities, "active", "current").select("csp_id", F.col("partner_id").cast("string").alias("partner_id"))
    return one_per(active, ["csp_id"], ["partner_id"])


def ladder6() -> Column:
    return stage_depth(
        [
            ("inst_any = 1", 6),
            (f"exid IS NOT NULL OR {in_sql('cs', ASSIGNED_OR_LATER)}", 5),
            ("csa IS NOT NULL OR cs = 'AWAITING_TECHNICIAN_ASSIGNMENT'", 4),
            ("psd IS NOT NULL OR cs = 'AWAITING_CUSTOMER_SLOT_CONFIRMATION'", 3),
            ("has_candidate = 1", 2),
        ],
        1,
    )


def ladder7() -> Column:
    return stage_depth(
        [
            ("inst_any = 1", 7),
            (in_sql("cs", REACHED_STATES), 6),
            ("exid IS NOT NULL OR cs = 'TECHNICIAN_ASSIGNED'", 5),
            ("csa IS NOT NULL OR cs = 'AWAITING_TECHNICIAN_ASSIGNMENT'", 4),
            ("psd IS NOT NULL OR cs = 'AWAITING_CUSTOMER_SLOT_CONFIRMATION'", 3),
            ("has_candidate = 1", 2),
        ],
        1,
    )


def _attributed(t: Tables, cfg: FunnelConfig, date_from: dt.date, attributed: DataFrame | None) -> DataFrame:
    """The attributed bookings as given, or written once: they are read for their connections and for their rows."""
    return stage(attributed_since(t, cfg, date_from), "attributed") if attributed is None else attributed


def _booking_rows(t: Tables, cfg: FunnelConfig, date_from: dt.date, attributed: DataFrame | None) -> DataFrame:
    rows = _attributed(t, cfg, date_from, attributed)
    met = connections_of(rows)
    per_connection = candidate_facts(t, date_from, cfg, met).join(
        first_event(t, "ALLOCATION_ACCEPTED", "accepted_at", met), ["connection_id"], "full"
    )
    rows = lookup(rows, per_connection, ["connection_id"], row_id=BOOKING_KEY)
    return lookup(rows, entity_lookup(t), ["csp_id"], row_id=BOOKING_KEY).withColumn(
        "start_utc", shift_minutes("bt", -cfg.offset_minutes)
    )


def booking_base_v1(
    t: Tables, cfg: FunnelConfig, roster_ids: DataFrame, date_from: dt.date, attributed: DataFrame | None = None
) -> DataFrame:
    """Booking grain, six levels, durations measured from the booking."""
    rows = _booking_rows(t, cfg, date_from, attributed)
    rows = attach_roster(rows, roster_ids.select("pid"), "partner_id", row_id=BOOKING_KEY)
    return rows.select(
        "mobile",
        "booking_date",
        cohort_label("pid", "partner_id").alias("coh"),
        ladder6().alias("cur_depth"),
        tat_minutes("start_utc", "accepted_at").alias("tat_slot_m"),
        tat_minutes("start_utc", "csa").alias("tat_conf_m"),
        tat_minutes("start_utc", "done_at").alias("tat_inst_m"),
        minute_diff("tcreated", "accepted_at").alias("tat_ta"),
        tat_minutes("accepted_at", "csa").alias("tat_sc_m"),
        tat_minutes("csa", "t_assign").alias("tat_ca_m"),
        tat_minutes("t_assign", "done_at").alias("tat_ai_m"),
        F.expr("CASE WHEN cs = 'DECLINED' THEN 1 ELSE 0 END").alias("declined"),
    )


ROSTER_COLUMNS = ["cat", "screen", "viewed", "scrolled", "tapped", "ticket", "flow", "mg"]


def _period_columns(cfg: FunnelConfig) -> list[Column]:
    anchor = f"coalesce(ad, {date_sql(cfg.launch)})"
    return [F.expr(anchor).alias("ad"), period_anchored("booking_date", anchor, cfg.as_of).alias("period")]


def booking_base(
    t: Tables, cfg: FunnelConfig, roster: DataFrame, date_from: dt.date, attributed: DataFrame | None = None
) -> DataFrame:
    """Booking grain, seven levels, per-entity anchored periods and 48-hour flags."""
    rows = _booking_rows(t, cfg, date_from, attributed)
    rows = attach_roster(rows, roster.select("pid", "ad", *ROSTER_COLUMNS), "partner_id", row_id=BOOKING_KEY)
    mature = cfg.mature_minutes
    return rows.select(
        "mobile",
        "booking_date",
        F.hour("bt").alias("bhr"),
        "bflow",
        F.col("pid").alias("mgpid"),
        cohort_label("pid", "partner_id").alias("coh"),
        *ROSTER_COLUMNS,
        *_period_columns(cfg),
        ladder7().alias("cur_depth"),
        within_minutes("start_utc", "accepted_at", 0, mature).alias("acc48"),
        within_minutes("start_utc", "csa", 0, mature).alias("conf48"),
        within_minutes("start_utc", "t_assign", 0, mature).alias("asgn48"),
        within_minutes("start_utc", "done_at", 0, mature).alias("inst48"),
        tat_minutes("cur_created", "accepted_at", clamp=True).alias("tat_ta"),
        tat_minutes("accepted_at", "csa").alias("tat_sc_m"),
        tat_minutes("csa", "t_assign").alias("tat_ca_m"),
        tat_minutes("t_assign", "done_at").alias("tat_ai_m"),
        local_time("done_at", cfg.offset_minutes).alias("inst_ts"),
    )


def entity_stages(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (connection, entity): received time, furthest rank, first time at or past each rank."""
    ranked = history.select(
        *keys, "created_at", "updated_at", rank_of("current_state", STATE_RANK).alias("__rank")
    )
    return ranked.groupBy(*keys).agg(
        F.min("created_at").alias("recv"),
        *first_time_when({f"{name}_ts": f"__rank >= {lo}" for name, lo in STAGE_RANKS.items()}, "updated_at"),
        F.max("__rank").alias("maxrank"),
    )


def latest_allocations(t: Tables, connections: DataFrame | None = None) -> DataFrame:
    accepted = live(t.allocations, "active", "current").filter(F.col("acceptance_timestamp").isNotNull())
    return latest_by(
        _only(accepted, connections).select("connection_id", "assigned_at", "acceptance_timestamp"),
        ["connection_id"],
        "assigned_at",
        tiebreak=["acceptance_timestamp"],
    )


def entity_base(
    t: Tables, cfg: FunnelConfig, roster: DataFrame, date_from: dt.date, attributed: DataFrame | None = None
) -> DataFrame:
    """Entity grain: a booking sent to n entities counts n times, each with its own stage.

    History and allocations are reduced to the connections that were met. The history is aggregated before it meets
    the bookings: map tasks combine the states of a (connection, entity), so a busy connection reaches the join as one
    row per entity.
    """
    rows = _attributed(t, cfg, date_from, attributed)
    rows = rows.filter(F.col("connection_id").isNotNull()).select(*BOOKING_KEY, "bt", "bflow", "connection_id")
    met = connections_of(rows)
    stages = entity_stages(_only(t.history, met), ["connection_id", "csp_id"])
    rows = lookup(rows, latest_allocations(t, met), ["connection_id"], row_id=BOOKING_KEY)
    rows = rows.join(stages, ["connection_id"])
    row_id = [*BOOKING_KEY, "csp_id"]
    rows = lookup(rows, entity_lookup(t), ["csp_id"], row_id=BOOKING_KEY)
    rows = attach_roster(rows, roster.select("pid", "ad", *ROSTER_COLUMNS), "partner_id", row_id=row_id)
    mature = cfg.mature_minutes
    accept = tat_minutes("assigned_at", "acceptance_timestamp", hi=mature)
    return rows.select(
        "mobile",
        "booking_date",
        F.hour("bt").alias("bhr"),
        "bflow",
        "csp_id",
        F.col("pid").alias("mgpid"),
        cohort_label("pid", "partner_id").alias("coh"),
        *ROSTER_COLUMNS,
        *_period_columns(cfg),
        depth_of_rank("maxrank", RANK_DEPTH).alias("cur_depth"),
        *[
            within_minutes("recv", f"{name}_ts", 0, mature).alias(f"{name}48")
            for name in ("slot", "conf", "asgn", "reached", "inst")
        ],
        F.when(F.col("maxrank") >= 2, accept).alias("tat_ta"),
        tat_minutes("slot_ts", "conf_ts").alias("tat_sc_m"),
        tat_minutes("conf_ts", "asgn_ts").alias("tat_ca_m"),
        tat_minutes("asgn_ts", "inst_ts").alias("tat_ai_m"),
    )
