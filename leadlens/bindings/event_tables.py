"""The role tables derived from the supplied ``events`` (and ``customer``/``nation``) tables.

signup = booking, view = connection request, click = acceptance, and every event but a
signup is a candidate row whose state follows from its ``k``. A connection is a subject's
four-day block; a candidate's entity is the subject number plus 0, 1 or 2.
Every row of ``events`` is used; nothing is sampled.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FunnelConfig
from ..operators.ordered import next_event
from ..session import stage
from ..sources.files import scan

CONFIG = FunnelConfig(
    launch=dt.date(2024, 1, 16),
    as_of=dt.date(2024, 1, 27),
    campaign="C1",
    test_identities=(7, 11),
    # The derived profiles name their fields and events in their own way.
    screen_fields=("screen_real", "screen"),
    event_prefixes={"viewed": "View_", "scrolled": "Scroll_", "tapped": "TapGuarantee_", "ticket": "Ticket_"},
)
# No entity can be live for longer than since launch, so this bound needs no look at the roster.
DATE_FROM = CONFIG.scan_from(CONFIG.n_days)
DRILL_DAY = dt.date(2024, 1, 20)

# Upper limits of k per state.
STATE_OF_K = [
    (7, "AWAITING_SLOT_PROPOSAL"),
    (14, "SLOT_SELECTED"),
    (21, "AWAITING_CUSTOMER_SLOT_CONFIRMATION"),
    (28, "SLOT_CONFIRMED_BY_CUSTOMER"),
    (35, "SLOT_AUTO_CONFIRMED"),
    (42, "AWAITING_TECHNICIAN_ASSIGNMENT"),
    (49, "TECHNICIAN_ASSIGNED"),
    (56, "ARRIVED_AT_SITE"),
    (63, "INSTALLATION_IN_PROGRESS_PRE_FEE"),
    (70, "FEE_COLLECTION_PENDING"),
    (76, "INSTALLATION_IN_PROGRESS_POST_FEE"),
    (82, "AWAITING_CUSTOMER_OTP"),
    (88, "CONNECTION_ACTIVE"),
    (93, "RATING_PENDING"),
]
FIRST_MOBILE = 5999999997


def ladder(expr: str, steps, default: str | None) -> str:
    """SQL: the first upper limit above the value wins."""
    rungs = " ".join(f"WHEN {expr} < {hi} THEN '{value}'" for hi, value in steps)
    return f"CASE {rungs} ELSE {'NULL' if default is None else repr(default)} END"


MOBILE = f"CAST(user_id + {FIRST_MOBILE} AS STRING)"
CONNECTION = "concat(user_id, '/', datediff(to_date(ts), DATE'2024-01-01') div 4)"
ACCOUNT = "concat(user_id, '-', k div 50)"
NUMBER = "(user_id + k div 34)"
CSP = f"concat('e', {NUMBER})"
PARTNER = f"CAST({NUMBER} + 1000 AS STRING)"
LCO = "concat('L', user_id, '-', k div 10)"
STATE = ladder("k", STATE_OF_K, "DECLINED")
UPDATED = "ts + make_dt_interval(0, 0, k * 10)"


def by_type(default: str, **names: str) -> str:
    rungs = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in names.items())
    return f"CASE event_type {rungs} ELSE '{default}' END"


class EventRoles:
    """Role tables over one data folder; each attribute has the name and columns of a ``Tables`` field."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str, *cols) -> DataFrame:
        return scan(self.spark, f"{self.dir}/{name}.parquet", cols or None)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id", "ts", "user_id", "event_type", "value", "CAST(get_json_object(props, '$.k') AS INT) AS k"
        )

    def parsed(self) -> EventRoles:
        """The same roles over events whose ``k`` is taken from the JSON once: a section of the document reads them some twenty times."""
        out = EventRoles(self.spark, self.dir)
        out.events = stage(self.events, "events")
        return out

    def of(self, *types: str) -> DataFrame:
        return self.events.filter(F.col("event_type").isin(list(types)))

    # ---- facts -----------------------------------------------------------------------------

    @cached_property
    def bookings(self) -> DataFrame:
        signups = self.of("signup").selectExpr("user_id", "event_id", f"{MOBILE} AS mobile", "ts")
        local = "ts + INTERVAL '330' MINUTE"
        return next_event(signups, ["user_id"], "ts", "next_ts", ["event_id"]).selectExpr(
            "mobile", f"to_date({local}) AS booking_date", f"{local} AS bt", "next_ts + INTERVAL '330' MINUTE AS nb"
        )

    @cached_property
    def accounts(self) -> DataFrame:
        return self.of("signup").selectExpr(
            f"{MOBILE} AS mobile",
            f"{ACCOUNT} AS account_id",
            f"CASE WHEN k < 90 THEN {LCO} END AS lco_account_id",
            "CASE WHEN value > 5 THEN ts END AS added_time",
            ladder("k", [(15, "A"), (30, "B"), (45, "G"), (60, "H"), (80, "C")], None) + " AS group_name",
            "value > 100 AS deleted",
        )

    @cached_property
    def test_accounts(self) -> DataFrame:
        return self.of("error").filter("value > 100").selectExpr(f"CASE WHEN k < 95 THEN {LCO} END AS lco_account_id")

    @cached_property
    def all_accounts(self) -> DataFrame:
        return self.of("signup").selectExpr(
            f"{MOBILE} AS mobile", f"CASE WHEN value >= 1 THEN {ACCOUNT} END AS account_id"
        )

    @cached_property
    def event_history(self) -> DataFrame:
        return self.events.selectExpr(
            f"{CONNECTION} AS connection_id",
            by_type("OTHER", view="CONNECTION_REQUEST", click="ALLOCATION_ACCEPTED") + " AS event_type",
            "ts AS event_timestamp",
            "value > 150 AS deleted",
        )

    @cached_property
    def connections(self) -> DataFrame:
        grouped = self.of("view").groupBy(F.expr(CONNECTION).alias("connection_id"), "user_id")
        return grouped.agg(F.min("k").alias("k"), F.max("value").alias("v")).selectExpr(
            "connection_id", f"{ACCOUNT} AS customer_id", "v > 5 AS active"
        )

    @cached_property
    def candidates(self) -> DataFrame:
        return self.events.filter("event_type <> 'signup'").selectExpr(
            f"{CONNECTION} AS connection_id",
            "CAST(event_id AS STRING) AS execution_candidate_id",
            f"{CSP} AS csp_id",
            f"{STATE} AS current_state",
            "ts AS created_at",
            f"{UPDATED} AS updated_at",
            "CASE WHEN event_type = 'view' THEN date_add(to_date(ts), 1) END AS proposed_slot_date",
            "CASE WHEN event_type = 'click' AND value > 20 THEN ts + INTERVAL '2' HOUR END AS confirmed_slot_at",
            "CASE WHEN event_type = 'purchase' AND value > 60 THEN ts + INTERVAL '6' HOUR END AS installation_completed_at",
            "CASE WHEN event_type = 'error' AND value > 20 THEN concat('x', k) END AS executor_id",
            "CASE WHEN event_type <> 'view' THEN event_type = 'purchase' AND value > 90 END AS otp_verified",
            "CASE WHEN event_type <> 'error' THEN CAST(k div 13 AS INT) END AS completed_step",
            "value > 4 AS etl_current",
            "CASE WHEN k >= 93 AND value > 30 THEN 'busy' WHEN k >= 93 AND value > 20 THEN '' END AS failure_reason",
            "CASE WHEN k >= 97 THEN 'far' WHEN k >= 95 THEN '' END AS failure_subreason_code",
            "CASE WHEN k >= 93 THEN concat('r', k) END AS reason_code",
        )

    @cached_property
    def history(self) -> DataFrame:
        """Two states per purchase candidate (the second one six hours later), one for the others."""
        own = f"named_struct('current_state', {STATE}, 'updated_at', {UPDATED})"
        later = "named_struct('current_state', 'CONNECTION_ACTIVE', 'updated_at', ts + INTERVAL '6' HOUR)"
        return self.events.filter("event_type <> 'signup'").selectExpr(
            f"{CONNECTION} AS connection_id",
            f"{CSP} AS csp_id",
            "CAST(event_id AS STRING) AS execution_candidate_id",
            "ts AS created_at",
            f"inline(CASE WHEN event_type = 'purchase' THEN array({own}, {later}) ELSE array({own}) END)",
        )

    @cached_property
    def allocations(self) -> DataFrame:
        return self.of("click").selectExpr(
            f"{CONNECTION} AS connection_id",
            "CASE WHEN value > 10 THEN ts - INTERVAL '30' MINUTE END AS assigned_at",
            "CASE WHEN value < 120 THEN ts + make_dt_interval(0, 0, k) END AS acceptance_timestamp",
            "value > 3 AS active",
        )

    # ---- entities and people ---------------------------------------------------------------

    @cached_property
    def entities(self) -> DataFrame:
        return self.of("click").filter("value > 100").selectExpr(
            f"{CSP} AS csp_id",
            f"CASE WHEN value < 250 THEN {PARTNER} END AS partner_id",
            f"concat('Entity ', {NUMBER}, '-', k) AS name",
            "value < 300 AS active",
        )

    @cached_property
    def entity_dim(self) -> DataFrame:
        return self.of("click").filter("value > 60").selectExpr(
            f"{CSP} AS csp_id", f"{PARTNER} AS partner_id", "value < 200 AS etl_current"
        ).distinct()

    @cached_property
    def users(self) -> DataFrame:
        return self.events.selectExpr(
            "CASE WHEN k >= 95 THEN concat('x', user_id) ELSE CAST(user_id AS STRING) END AS id",
            f"{CSP} AS csp_id",
            by_type("TECHNICIAN", click="OWNER", view="MANAGER", purchase="MANAGER_PLUS") + " AS role",
            "CASE WHEN value > 30 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status",
        ).distinct()

    @cached_property
    def optins(self) -> DataFrame:
        return self.of("purchase").filter("value > 90").selectExpr(
            f"{PARTNER} AS partner_id",
            "CASE WHEN k < 80 THEN 'MG' ELSE 'OTHER' END AS program",
            "CASE WHEN value <= 200 THEN ts END AS first_opted_at",
        )

    @cached_property
    def campaign(self) -> DataFrame:
        return self.of("click").filter("value > 90").selectExpr(
            "CASE WHEN k < 90 THEN 'C1' ELSE 'C2' END AS campaign_id",
            f"{PARTNER} AS partner_id",
            "CASE WHEN k >= 20 THEN ts END AS scan_complete_at",
        )

    @cached_property
    def cohorts(self) -> DataFrame:
        rows = self.events.filter("(event_type = 'error' AND value > 140) OR (event_type = 'view' AND value > 113)")
        return rows.selectExpr(f"{PARTNER} AS pid", by_type("flow2", error="flow1") + " AS flow").distinct()

    @cached_property
    def screen_log(self) -> DataFrame:
        code = ladder("k", [(20, "excited"), (40, "dontknow"), (60, "dontcare"), (80, "questions")], "bogus")
        return self.of("view").selectExpr(
            """CASE WHEN k >= 98 THEN concat('RAW', user_id) WHEN k >= 96 THEN concat('x', user_id)
               ELSE CAST(user_id AS STRING) END AS pid""",
            f"concat(IF(k < 50, 'f3a', 'f3b'), IF(value < 10, 'X', '_'), {code}) AS screen",
            "IF(value > 130, '2', '3') AS flow",
            "ts",
        )

    @cached_property
    def profile_documents(self) -> DataFrame:
        """identity, record{profileData, events}: the layout of the exported profile JSON."""
        name = by_type(
            "Launch", view="View_home", click="Scroll_home", purchase="TapGuarantee_home", error="Ticket_home"
        )
        # Per subject and event type first: at most five map entries per subject.
        per_type = self.events.groupBy("user_id", F.expr(name).alias("name")).agg(
            F.expr("count_if(value > 113)").alias("count"),
            F.expr("min(CASE WHEN value > 113 THEN unix_seconds(CAST(ts AS TIMESTAMP)) END)").alias("first_seen"),
            F.expr("max(struct(ts, k))").alias("last"),
            F.expr("min(struct(ts, k))").alias("first"),
        )
        per_user = per_type.groupBy("user_id").agg(
            F.expr("map_from_entries(collect_list(struct(name, struct(count, first_seen))))").alias("events"),
            F.expr("max(last).k").alias("k_last"),
            F.expr("min(first).k").alias("k_first"),
        )
        real = ladder(
            "k_last", [(20, "keepgoing"), (40, "almost"), (60, "secured"), (75, "noleads"), (85, "other")], ""
        )
        data = f"struct({real} AS screen_real, CASE WHEN k_first < 50 THEN 'keepgoing' END AS screen)"
        return per_user.selectExpr(
            "CAST(user_id AS STRING) AS identity", f"struct({data} AS profileData, events AS events) AS record"
        )

    @cached_property
    def profiles(self) -> DataFrame:
        """The documents in the shape ``read_profiles`` returns."""
        data = "record.profileData"
        return self.profile_documents.selectExpr(
            "identity",
            f"coalesce(nullif({data}.screen_real, ''), nullif({data}.screen, ''), '') AS screen",
            "record.events AS events",
        )

    @cached_property
    def app_events(self) -> DataFrame:
        """Clicks are opens; small ones arrive twice with different sync times."""
        copies = "explode(IF(value < 20, array(1, 2), array(1))) AS copy"
        rows = self.of("click", "signup").selectExpr("*", copies)
        return rows.selectExpr(
            "CAST(user_id AS STRING) AS device_id",
            "IF(value > 200, 'n/a', date_format(ts, 'yyyy-MM-dd HH:mm:ss')) AS ts_text",
            by_type("Other", click="App Launched") + " AS event_name",
            "CASE WHEN value >= 50 THEN value > 150 END AS deleted",
            "ts + make_dt_interval(0, copy) AS synced",
        )

    @cached_property
    def app_profiles(self) -> DataFrame:
        role = "element_at(array('owner', 'Manager', 'MANAGER_PLUS', 'Technician', 'guest'), CAST(user_id % 5 + 1 AS INT))"
        return self.events.selectExpr(
            "CAST(user_id AS STRING) AS device_id",
            f"{CSP} AS csp_id",
            f"{role} AS role",
            "CASE WHEN value < 200 THEN value > 180 END AS deleted",
        )

    @cached_property
    def hourly(self) -> DataFrame:
        """Values of an hour as its rain, the mean k as its cloud; each subject is a site."""
        hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
        return self.events.groupBy(F.col("user_id").alias("site"), hour.alias("ts")).agg(
            (F.sum(F.floor("value")) / F.lit(16.0)).alias("precip"), (F.sum("k") / F.count(F.lit(1))).alias("cloud")
        )

    @cached_property
    def cities(self) -> DataFrame:
        nation = self.table("nation", F.col("n_nationkey").alias("c_nationkey"), "n_name")
        customer = self.table("customer", "c_custkey", "c_nationkey")
        return customer.join(nation, ["c_nationkey"]).selectExpr(
            "CAST(c_custkey + 1000 AS STRING) AS partner_id", "n_name AS partner_city"
        )
