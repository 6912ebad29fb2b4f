"""The registered queries: every operator bound to the supplied tables, next to its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ANSWER_CODES, ANSWER_LABELS, CLASS_LABELS, OWNER_ROLES, RANK_DEPTH, ROLE_GROUP, STATE_RANK
from ..functions import labels as L
from ..functions import predicates as X
from ..functions import temporal as T
from ..functions.rates import pct as pct_col
from ..functions.rates import ratio, whole
from ..operators import aggregates as A
from ..operators import dedup as D
from ..operators import joins as J
from ..operators.asof import attribute_first, first_after
from ..operators.ordered import next_event, running_number
from ..plans import base as B
from ..plans import classes as C
from ..plans import document as DOC
from ..plans import engagement as E
from ..plans import funnel as P
from ..plans import installs as I
from ..plans import journey as JO
from ..plans import payload as PY
from ..plans import roster as R
from ..plans.weather import daily_weather
from ..session import fresh_path, stage, together
from ..sources import publish_json, published, read_cohorts, read_hourly, read_profiles
from ..streaming import events as S
from . import oracles as O
from .event_tables import CONFIG, DATE_FROM, DRILL_DAY, PARTNER, EventRoles

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def add(fn: Callable[[EventRoles], DataFrame]):
        REGISTRY[name] = Query(lambda spark, sf_dir: fn(EventRoles(spark, sf_dir)), O.statement(sql) if sql else None)
        return fn

    return add


# ======================================================================================
# one row per key
# ======================================================================================

_LINE = ["l_orderkey", "l_shipdate", "l_suppkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]
_LINE_TIE = ["l_suppkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"]
_LINE_SQL = ", ".join(_LINE)


def _line_sql(order: str) -> str:
    return f"""SELECT {_LINE_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS rn
FROM lineitem) WHERE rn = 1"""


@register("latest_per_key", _line_sql("l_shipdate DESC, " + ", ".join(f"{c} DESC" for c in _LINE_TIE)))
def _(r):
    return D.latest_by(r.table("lineitem", *_LINE), ["l_orderkey"], "l_shipdate", tiebreak=_LINE_TIE)


@register("earliest_per_key", _line_sql("l_shipdate, " + ", ".join(_LINE_TIE)))
def _(r):
    return D.earliest_by(r.table("lineitem", *_LINE), ["l_orderkey"], "l_shipdate", _LINE_TIE)


@register(
    "one_per_key",
    "SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1",
)
def _(r):
    return D.one_per(r.table("lineitem", "l_orderkey", "l_suppkey"), ["l_orderkey"])


@register(
    "event_dedup",
    """SELECT device_id, ts_text, event_name, min(synced) AS synced FROM app_events GROUP BY 1, 2, 3""",
)
def _(r):
    keys = ["device_id", "ts_text", "event_name"]
    return D.dedup_events(r.app_events.select(*keys, "synced"), keys, ["synced"])


@register(
    "any_flag_then_latest",
    f"""SELECT {_LINE_SQL}, returned FROM (SELECT *,
  max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS returned,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, {", ".join(f"{c} DESC" for c in _LINE_TIE)}) AS rn
FROM lineitem) WHERE rn = 1""",
)
def _(r):
    return D.any_flag_then_latest(
        r.table("lineitem", *_LINE),
        ["l_orderkey"],
        {"returned": "l_returnflag = 'R'"},
        "l_shipdate",
        tiebreak=_LINE_TIE,
    )


@register(
    "latest_valid_answer",
    """SELECT user_id, coalesce(arg_max(event_type, ts) FILTER (WHERE event_type <> 'error'), 'none') AS event_type
FROM ev GROUP BY 1""",
)
def _(r):
    valid = ["click", "purchase", "signup", "view"]
    return D.latest_valid(r.events, "user_id", "ts", "event_type", valid, default="none")


@register("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def _(r):
    return D.distinct_keys(r.events, ["user_id", "event_type"])


@register(
    "next_event_time",
    "SELECT event_id, user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events",
)
def _(r):
    return next_event(r.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", "next_ts", ["event_id"])


@register(
    "event_position",
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events",
)
def _(r):
    rows = running_number(r.events.select("event_id", "user_id", "ts"), ["user_id"], "ts", "n", ["event_id"])
    return rows.drop("ts")


# ======================================================================================
# joins
# ======================================================================================


@register(
    "attributed_first_request",
    """SELECT s.event_id, s.user_id, s.ts, v.event_id AS request_id, v.ts AS request_ts
FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nb FROM ev WHERE event_type = 'signup') s
LEFT JOIN ev v ON v.user_id = s.user_id AND v.event_type = 'view'
  AND v.ts BETWEEN s.ts - INTERVAL 2 HOUR AND s.ts + INTERVAL 14 DAY AND (s.nb IS NULL OR v.ts < s.nb)
QUALIFY row_number() OVER (PARTITION BY s.event_id ORDER BY v.ts NULLS LAST, v.event_id) = 1""",
)
def _(r):
    cols = ["event_id", "user_id", "ts"]
    signups = next_event(r.of("signup").select(*cols), ["user_id"], "ts", "nb", ["event_id"])
    views = r.of("view").select("user_id", F.col("ts").alias("request_ts"), F.col("event_id").alias("request_id"))
    hits = attribute_first(
        signups,
        views,
        ["user_id"],
        "ts",
        "request_ts",
        ["request_id", "request_ts"],
        before_minutes=120,
        after_minutes=14 * 1440,
        next_ts="nb",
        tiebreak=["request_id"],
        row_id=["event_id"],
    )
    return hits.drop("nb")


@register(
    "first_purchase_after",
    """SELECT e.event_id, e.user_id, e.ts, (SELECT min(p.ts) FROM ev p WHERE p.user_id = e.user_id
  AND p.event_type = 'purchase' AND p.ts > e.ts) AS purchase_ts FROM ev e WHERE e.event_type <> 'purchase'""",
)
def _(r):
    left = r.events.filter(F.col("event_type") != "purchase").select("event_id", "user_id", "ts")
    buys = r.of("purchase").select("user_id", F.col("ts").alias("buy_ts"))
    return first_after(left, buys, ["user_id"], "ts", "buy_ts", "purchase_ts")


@register(
    "first_action_after_view",
    "SELECT pid, view_ts, action_ts, mins FROM acted",
)
def _(r):
    t = r
    return E.view_actions(E.viewers(R.roster(t, CONFIG)), t, CONFIG)


@register(
    "anti_keep_null",
    """SELECT mobile, account_id, lco_account_id, added_time FROM accounts WHERE lco_account_id IS NULL
OR lco_account_id NOT IN (SELECT lco_account_id FROM test_accounts WHERE lco_account_id IS NOT NULL)""",
)
def _(r):
    rows = r.accounts.select("mobile", "account_id", "lco_account_id", "added_time")
    return J.anti_keep_null(rows, r.test_accounts, ["lco_account_id"], row_id=["mobile", "added_time"])


@register(
    "semi_reduce",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(r):
    urgent = r.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    return J.semi(r.table("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), urgent, ["l_orderkey"])


@register(
    "roster_zero_fill",
    """SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, last_order FROM customer LEFT JOIN (
  SELECT o_custkey AS c_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1) o
USING (c_custkey)""",
)
def _(r):
    measures = r.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    return J.zero_fill(r.table("customer", "c_custkey"), measures, "c_custkey", ["n_orders"])


@register(
    "left_join_chain",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority, c_mktsegment, s_name FROM lineitem
LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN supplier ON s_suppkey = l_suppkey""",
)
def _(r):
    lines = r.table("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = r.table("orders", F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    customers = r.table("customer", F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    suppliers = r.table("supplier", F.col("s_suppkey").alias("l_suppkey"), "s_name")
    row_id = ["l_orderkey", "l_linenumber"]
    out = J.lookup(lines, orders, ["l_orderkey"], row_id=row_id)
    out = J.lookup(out, customers, ["o_custkey"], row_id=row_id)
    return J.lookup(out, suppliers, ["l_suppkey"], row_id=row_id).drop("o_custkey")


@register(
    "identity_resolution",
    """SELECT CAST(try_cast(u.id AS BIGINT) AS BIGINT) AS identity, min(d.partner_id) AS pid
FROM users u JOIN entity_dim d USING (csp_id)
WHERE u.role IN ('OWNER', 'MANAGER', 'MANAGER_PLUS') AND u.status = 'ACTIVE' AND d.etl_current
  AND try_cast(u.id AS BIGINT) IS NOT NULL GROUP BY 1""",
)
def _(r):
    return J.resolve_identity(r.users, r.entity_dim, OWNER_ROLES, integer_ids=True)


@register(
    "roster_complement_count",
    """SELECT count(DISTINCT CAST(c_custkey + 1000 AS VARCHAR)) AS entities FROM customer
JOIN nation ON n_nationkey = c_nationkey
WHERE n_name ILIKE '%nation_1%' AND CAST(c_custkey + 1000 AS VARCHAR) NOT IN (SELECT pid FROM enrolled)""",
)
def _(r):
    t = r
    return A.complement_count(t.cities, "partner_id", "partner_city", "%nation_1%", R.enrolled(t, CONFIG))


# ======================================================================================
# predicates, labels, scalar functions
# ======================================================================================


@register(
    "live_filters",
    """SELECT 'strict' AS mode, count(*) AS n FROM app_profiles WHERE NOT deleted
UNION ALL SELECT 'lenient', count(*) FROM app_profiles WHERE NOT coalesce(deleted, false)
UNION ALL SELECT 'current', count(*) FROM app_profiles WHERE deleted""",
)
def _(r):
    rows = r.app_profiles
    # One pass: each row is counted for every mode it satisfies.
    modes = ", ".join(f"CASE WHEN {X.live_sql('deleted', m)} THEN '{m}' END" for m in X.LIVE_MODES)
    return rows.selectExpr(f"explode(array_compact(array({modes}))) AS mode").groupBy("mode").agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "exclude_flows",
    "SELECT mobile, account_id, group_name, added_time FROM accounts WHERE group_name IS NULL OR group_name NOT IN ('G', 'H')",
)
def _(r):
    rows = r.accounts.select("mobile", "account_id", "group_name", "added_time")
    return X.exclude_values(rows, "group_name", CONFIG.excluded_flows)


@register(
    "text_predicates",
    """SELECT pid, screen, ts, CASE WHEN screen LIKE 'f3a_%' THEN 1 ELSE 0 END AS is_a,
  CASE WHEN pid NOT LIKE 'RAW%' THEN 1 ELSE 0 END AS not_raw, CASE WHEN screen ILIKE '%DONT%' THEN 1 ELSE 0 END AS dont,
  CASE WHEN pid > '50' THEN 1 ELSE 0 END AS above FROM screen_log""",
)
def _(r):
    return r.screen_log.select(
        "pid",
        "screen",
        "ts",
        X.flag("screen LIKE 'f3a_%'").alias("is_a"),
        X.flag("pid NOT LIKE 'RAW%'").alias("not_raw"),
        X.flag("screen ILIKE '%DONT%'").alias("dont"),
        X.flag("pid > '50'").alias("above"),
    )


@register(
    "display_fields",
    """SELECT execution_candidate_id, left(key, 2) || 'XXXXX' || right(key, 3) AS masked, strftime(updated_at, '%m/%d %H:%M') AS shown,
  coalesce(nullif(failure_reason, ''), nullif(reason_code, ''), '') || coalesce(' / ' || nullif(failure_subreason_code, ''), '')
    AS reason FROM (SELECT *, connection_id || '-' || execution_candidate_id AS key FROM candidates)""",
)
def _(r):
    rows = r.candidates.withColumn("key", F.concat_ws("-", "connection_id", "execution_candidate_id"))
    return rows.select(
        "execution_candidate_id",
        L.mask_key("key").alias("masked"),
        L.display_ts("updated_at").alias("shown"),
        L.reason_text("failure_reason", "reason_code", "failure_subreason_code").alias("reason"),
    )


@register(
    "role_groups",
    """SELECT device_id, csp_id, role, CASE upper(role) WHEN 'OWNER' THEN 'owner' WHEN 'MANAGER' THEN 'mgr'
  WHEN 'MANAGER_PLUS' THEN 'mgr' WHEN 'TECHNICIAN' THEN 'tech' END AS rg FROM app_profiles""",
)
def _(r):
    return r.app_profiles.select("device_id", "csp_id", "role", L.role_group("role", ROLE_GROUP).alias("rg"))


@register(
    "category_labels",
    """SELECT substr(screen, 5) AS code, CASE substr(screen, 5) WHEN 'excited' THEN 'Excited' WHEN 'questions' THEN 'Has Questions'
  WHEN 'dontcare' THEN 'Indifferent' WHEN 'dontknow' THEN 'Unaware' ELSE substr(screen, 5) END AS label, count(*) AS n
FROM screen_log GROUP BY 1, 2""",
)
def _(r):
    code = F.substring("screen", 5, 1 << 30).alias("code")
    counted = r.screen_log.groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("label", L.label_of("code", ANSWER_LABELS))


@register(
    "hour_buckets",
    """SELECT CAST(ts AS DATE) AS d, CAST(sum(CASE WHEN hour(ts) <= 7 THEN 1 ELSE 0 END) AS BIGINT) AS night,
  CAST(sum(CASE WHEN hour(ts) = 12 THEN 1 ELSE 0 END) AS BIGINT) AS noon FROM events GROUP BY 1""",
)
def _(r):
    flags = r.events.select(
        F.to_date("ts").alias("d"),
        T.hour_bucket("ts", T.NIGHT).alias("night"),
        T.hour_bucket("ts", 12).alias("noon"),
    )
    return flags.groupBy("d").agg(*A.count_if_all({"night": "night", "noon": "noon"}))


@register(
    "state_rank_depth",
    f"""SELECT execution_candidate_id, current_state, updated_at, rk AS rank, CASE WHEN rk >= 8 THEN 7 WHEN rk >= 5 THEN 6
  WHEN rk >= 4 THEN 5 WHEN rk >= 3 THEN 4 WHEN rk >= 2 THEN 3 ELSE 2 END AS depth
FROM (SELECT *, {O.RANK_CASE} AS rk FROM history)""",
)
def _(r):
    ranked = r.history.withColumn("rank", L.rank_of("current_state", STATE_RANK))
    return ranked.select(
        "execution_candidate_id", "current_state", "updated_at", "rank", L.depth_of_rank("rank", RANK_DEPTH).alias("depth")
    )


@register(
    "stage_ladder",
    """SELECT connection_id, CASE WHEN inst_any = 1 THEN 6
    WHEN exid IS NOT NULL OR cs IN ('TECHNICIAN_ASSIGNED', 'ARRIVED_AT_SITE', 'INSTALLATION_IN_PROGRESS_POST_FEE',
      'AWAITING_CUSTOMER_OTP', 'FEE_COLLECTION_PENDING') THEN 5
    WHEN csa IS NOT NULL OR cs = 'AWAITING_TECHNICIAN_ASSIGNMENT' THEN 4
    WHEN psd IS NOT NULL OR cs = 'AWAITING_CUSTOMER_SLOT_CONFIRMATION' THEN 3 ELSE 2 END AS depth6,
  CASE WHEN inst_any = 1 THEN 7
    WHEN cs IN ('ARRIVED_AT_SITE', 'INSTALLATION_IN_PROGRESS_PRE_FEE', 'INSTALLATION_IN_PROGRESS_POST_FEE',
      'AWAITING_CUSTOMER_OTP', 'FEE_COLLECTION_PENDING') THEN 6
    WHEN exid IS NOT NULL OR cs = 'TECHNICIAN_ASSIGNED' THEN 5
    WHEN csa IS NOT NULL OR cs = 'AWAITING_TECHNICIAN_ASSIGNMENT' THEN 4
    WHEN psd IS NOT NULL OR cs = 'AWAITING_CUSTOMER_SLOT_CONFIRMATION' THEN 3 ELSE 2 END AS depth7 FROM latest_cand""",
)
def _(r):
    facts = B.candidate_facts(r, DATE_FROM, CONFIG).filter(F.col("has_candidate") == 1)
    return facts.select("connection_id", B.ladder6().alias("depth6"), B.ladder7().alias("depth7"))


@register(
    "first_time_per_stage",
    "SELECT connection_id, csp_id, recv, slot_ts, conf_ts, asgn_ts, reached_ts, inst_ts, maxrank FROM stages",
)
def _(r):
    return B.entity_stages(r.history, ["connection_id", "csp_id"])


@register(
    "cohort_period_fixed",
    f"""SELECT mobile, bt, {O.fixed_period('booking_date')} AS period FROM bookings""",
)
def _(r):
    period = T.period_fixed("booking_date", (CONFIG.pre_start, CONFIG.pre_end), (CONFIG.launch, CONFIG.as_of))
    return r.bookings.select("mobile", "bt", period.alias("period"))


@register(
    "cohort_period_anchored",
    f"""SELECT pid, partner_ts, ad, {O.PERIOD.replace('booking_date', 'CAST(partner_ts AS DATE)')} AS period
FROM (SELECT CAST(num + 1000 AS VARCHAR) AS pid, ts AS partner_ts FROM ev) JOIN anchored USING (pid)""",
)
def _(r):
    t = r
    anchor = R.anchors(R.enrolled(t, CONFIG), t.optins, CONFIG)
    rows = r.events.selectExpr(f"{PARTNER} AS pid", "ts AS partner_ts").join(anchor, ["pid"])
    return rows.withColumn("period", T.period_anchored("to_date(partner_ts)", "ad", CONFIG.as_of))


_PAIR_SQL = """(SELECT execution_candidate_id, created_at AS a, confirmed_slot_at AS c, installation_completed_at AS i,
  updated_at AS u FROM candidates)"""


@register(
    "maturity_flags",
    f"""SELECT execution_candidate_id, {O.in48('a', 'u')} AS upd48, {O.in48('a', 'c')} AS conf48, {O.in48('u', 'i')} AS inst48,
  CASE WHEN {O.diff('a', 'u')} BETWEEN 60 AND 480 THEN 1 ELSE 0 END AS same_shift FROM {_PAIR_SQL}""",
)
def _(r):
    return r.candidates.select(
        "execution_candidate_id",
        T.within_minutes("created_at", "updated_at").alias("upd48"),
        T.within_minutes("created_at", "confirmed_slot_at").alias("conf48"),
        T.within_minutes("updated_at", "installation_completed_at").alias("inst48"),
        T.within_minutes("created_at", "updated_at", 60, 480).alias("same_shift"),
    )


@register(
    "stage_durations",
    f"""SELECT execution_candidate_id, {O.nonneg('u', 'i')} AS ui, {O.diff('u', 'i')} AS raw,
  CASE WHEN i IS NOT NULL THEN greatest({O.diff('u', 'i')}, 0) END AS clamped,
  CASE WHEN {O.diff('a', 'u')} BETWEEN 0 AND 480 THEN {O.diff('a', 'u')} END AS bounded,
  date_diff('second', u, i) AS secs FROM {_PAIR_SQL}""",
)
def _(r):
    u, i = "updated_at", "installation_completed_at"
    return r.candidates.select(
        "execution_candidate_id",
        T.tat_minutes(u, i).alias("ui"),
        T.minute_diff(u, i).alias("raw"),
        T.tat_minutes(u, i, clamp=True).alias("clamped"),
        T.tat_minutes("created_at", u, hi=480).alias("bounded"),
        T.second_diff(u, i).alias("secs"),
    )


@register(
    "profile_map_predicates",
    "SELECT identity, screen, viewed, scrolled, tapped, ticket, view_fs FROM flags",
)
def _(r):
    return R.profile_flags(r.profiles, CONFIG.event_prefixes)


@register(
    "rates",
    f"""SELECT user_id, {O.pct("count(*) FILTER (WHERE event_type = 'purchase')", "count(*) FILTER (WHERE event_type = 'view')")} AS buy_pct,
  {O.half_up("count(*)", "count(DISTINCT CAST(ts AS DATE))", 2)} AS per_day,
  CAST({O.half_up("count(*)", "count(DISTINCT event_type)", 0)} AS BIGINT) AS per_type FROM events GROUP BY 1""",
)
def _(r):
    per_user = r.events.groupBy("user_id").agg(
        A.count_if("event_type = 'purchase'").alias("p"),
        A.count_if("event_type = 'view'").alias("v"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(F.to_date("ts")).alias("days"),
        F.count_distinct("event_type").alias("types"),
    )
    return per_user.select(
        "user_id",
        pct_col("p", "v").alias("buy_pct"),
        ratio("n", "days", 2).alias("per_day"),
        whole("n", "types").alias("per_type"),
    )


@register(
    "nearest_rank",
    """SELECT l_returnflag, list_sort(list(l_quantity))[CAST(floor(count(*) * 0.5) AS BIGINT) + 1] AS p50,
  list_sort(list(l_quantity))[CAST(floor(count(*) * 0.7) AS BIGINT) + 1] AS p70,
  list_sort(list(l_quantity))[CAST(floor(count(*) * 0.75) AS BIGINT) + 1] AS p75,
  list_sort(list(l_quantity))[CAST(floor(count(*) * 0.9) AS BIGINT) + 1] AS p90 FROM lineitem GROUP BY 1""",
)
def _(r):
    lines = r.table("lineitem", "l_returnflag", "l_quantity")
    return lines.groupBy("l_returnflag").agg(
        *[A.nearest_rank("l_quantity", p).alias(f"p{round(100 * p)}") for p in (0.5, 0.7, 0.75, 0.9)]
    )


@register(
    "conditional_aggregates",
    """SELECT user_id, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
  min(ts) FILTER (WHERE event_type = 'purchase') AS first_buy,
  round(median(CAST(k AS DOUBLE)) FILTER (WHERE event_type = 'view')) AS view_k,
  count(DISTINCT event_type || '|' || CAST(ts AS DATE)) AS type_days FROM ev GROUP BY 1""",
)
def _(r):
    return r.events.groupBy("user_id").agg(
        *A.count_if_all({"clicks": "event_type = 'click'"}),
        *A.first_time_when({"first_buy": "event_type = 'purchase'"}, "ts"),
        A.median_round("event_type = 'view'", "k").alias("view_k"),
        F.count_distinct("event_type", F.to_date("ts")).alias("type_days"),
    )


# ======================================================================================
# people
# ======================================================================================


def _based(t):
    people, rows = _people_and_rows(t)
    return people, DATE_FROM, rows


def _people_and_rows(t):
    """Roster and attributed bookings, which need nothing of each other."""
    return together(
        lambda: stage(R.roster(t, CONFIG), "roster"),
        lambda: stage(B.attributed_since(t, CONFIG, DATE_FROM), "attributed"),
    )


@register("enrolled_set", "SELECT pid FROM enrolled")
def _(r):
    return R.enrolled(r, CONFIG)


@register("entity_anchors", "SELECT pid, ad FROM anchored")
def _(r):
    t = r
    return R.anchors(R.enrolled(t, CONFIG), t.optins, CONFIG)


@register("feedback_category", "SELECT pid, cat FROM cats")
def _(r):
    t = r
    return R.feedback(t, CONFIG, ANSWER_CODES, R.owner_scope(t, R.enrolled(t, CONFIG)))


@register(
    "engagement_rollup", "SELECT pid, screen, viewed, scrolled, tapped, ticket, view_fs FROM engaged"
)
def _(r):
    t = r
    return R.engagement(t, R.owner_scope(t, R.enrolled(t, CONFIG)), CONFIG.event_prefixes)


@register(
    "identity_merge",
    """SELECT pid, coalesce(arg_min(screen, identity) FILTER (WHERE screen <> ''), '') AS screen, max(viewed) AS viewed,
  max(scrolled) AS scrolled, max(tapped) AS tapped, max(ticket) AS ticket, min(view_fs) AS view_fs
FROM flags JOIN (SELECT u.id AS identity, min(d.partner_id) AS pid FROM users u JOIN entity_dim d USING (csp_id)
  WHERE u.role IN ('OWNER', 'MANAGER', 'MANAGER_PLUS') AND u.status = 'ACTIVE' AND d.etl_current GROUP BY 1) USING (identity)
GROUP BY 1""",
)
def _(r):
    return R.engagement(r, prefixes=CONFIG.event_prefixes)


_ROSTER_SQL = "pid, ad, cat, screen, viewed, scrolled, tapped, ticket, flow, CAST(days AS INTEGER) AS days, view_fs"


@register("roster", f"SELECT {_ROSTER_SQL} FROM roster")
def _(r):
    return R.roster(r, CONFIG).drop("mg")


@register(
    "roster_with_class",
    "SELECT pid, ad, cat, screen, flow, mg FROM rosterm",
)
def _(r):
    t = r
    people, rows = _people_and_rows(t)
    found = C.classify_entities(B.entity_base(t, CONFIG, people, DATE_FROM, rows), people, CONFIG)
    return R.with_class(people, found, "mg").select("pid", "ad", "cat", "screen", "flow", "mg")


@register(
    "analysis_window",
    f"""SELECT DATE '{CONFIG.as_of}' AS as_of, DATE '{CONFIG.pre_start}' AS pre_start, DATE '{CONFIG.pre_end}' AS pre_end,
  DATE '{CONFIG.launch}' - (CAST(coalesce(max(days), 1) AS INTEGER) + 1) AS scan_from,
  CAST(coalesce(max(days), 1) AS INTEGER) AS n_max FROM roster WHERE days >= 1""",
)
def _(r):
    found = R.windows(R.roster(r, CONFIG), CONFIG)
    names = ("as_of", "pre_start", "pre_end", "scan_from", "n_max")
    return r.spark.range(1).select(*[F.lit(found[name]).alias(name) for name in names])


@register(
    "entity_days",
    """SELECT cat, flow, CAST(sum(days) AS BIGINT) AS entity_days, count(*) AS entities FROM roster WHERE days >= 1 GROUP BY 1, 2""",
)
def _(r):
    return A.entity_days(R.roster(r, CONFIG), ["cat", "flow"])


# ======================================================================================
# bases and panels
# ======================================================================================


@register(
    "booking_base_v1",
    """SELECT mobile, booking_date, coh, cur_depth, tat_slot_m, tat_conf_m, tat_inst_m, tat_ta, tat_sc_m, tat_ca_m, tat_ai_m,
  declined FROM base1""",
)
def _(r):
    t = r
    return B.booking_base_v1(t, CONFIG, R.enrolled(t, CONFIG), CONFIG.pre_start)


_BASE_SQL = f"""mobile, booking_date, bhr, bflow, mgpid, coh, {O.ROSTER_COLS}, ad, period, cur_depth"""


@register(
    "booking_base_v2",
    f"SELECT {_BASE_SQL}, acc48, conf48, asgn48, inst48, tat_ta, tat_sc_m, tat_ca_m, tat_ai_m, inst_ts FROM base2",
)
def _(r):
    return B.booking_base(r, CONFIG, *_based(r)).drop("mg")


@register(
    "entity_base",
    f"""SELECT {_BASE_SQL}, csp_id, slot48, conf48, asgn48, reached48, inst48, tat_ta, tat_sc_m, tat_ca_m, tat_ai_m FROM ebase""",
)
def _(r):
    return B.entity_base(r, CONFIG, *_based(r)).drop("mg")


_V1 = f"""{O.cnt('cur_depth >= 2', 'received')}, {O.cnt('cur_depth >= 3', 'slot')}, {O.cnt('cur_depth >= 4', 'confirm')},
  {O.cnt('cur_depth >= 6', 'install')}, {O.cnt('cur_depth >= 5', 'assign')}, {O.cnt('declined = 1', 'decline')},
  {O.med('cur_depth >= 3 AND tat_ta >= 0', 'tat_ta', 'tat_accept')}, {O.med('true', 'tat_slot_m', 'tat_slot')},
  {O.med('true', 'tat_conf_m', 'tat_confirm')}, {O.med('true', 'tat_inst_m', 'tat_install')},
  {O.med('true', 'tat_sc_m', 'tat_sc')}, {O.med('true', 'tat_ca_m', 'tat_ca')}, {O.med('true', 'tat_ai_m', 'tat_ai')}"""
_PRE_POST = f"""SELECT * FROM (SELECT {O.fixed_period('booking_date')} AS period, coh, {_V1} FROM base1
WHERE coh IS NOT NULL GROUP BY 1, 2) WHERE period IS NOT NULL"""


@register("funnel_pre_post", _PRE_POST)
def _(r):
    t = r
    return P.funnel_pre_post(B.booking_base_v1(t, CONFIG, R.enrolled(t, CONFIG), CONFIG.pre_start), CONFIG)


def _v1_rates(counts) -> str:
    return ", ".join(f"{O.pct(c, 'received', '0.0')} AS {c}_pct" for c in counts)


_PRE_POST_RATES = f"""SELECT f.*, {", ".join(f"CAST({O.half_up(c, str(CONFIG.n_days), 0)} AS BIGINT) AS {c}_d"
                               for c in ("received", "slot", "confirm", "install", "assign"))},
  {_v1_rates(("slot", "confirm", "assign", "install"))}, {O.pct('install', 'confirm', '0.0')} AS install_ratio,
  {O.half_up('received', f'{CONFIG.n_days} * (SELECT count(*) FROM enrolled)', 2)} AS per_entity_d
FROM ({_PRE_POST}) f"""


@register("funnel_pre_post_rates", _PRE_POST_RATES)
def _(r):
    t = r
    ids = stage(R.enrolled(t, CONFIG), "enrolled")
    block = P.funnel_pre_post(B.booking_base_v1(t, CONFIG, ids, CONFIG.pre_start), CONFIG)
    return P.rates_v1(block, CONFIG.n_days, ids.agg(F.count(F.lit(1)).alias("entities")))


_DECLINES = f"""SELECT period, coh, count(*) AS offers, {O.cnt("current_state = 'DECLINED'", 'declined')},
  {O.pct("count(*) FILTER (WHERE current_state = 'DECLINED')", 'count(*)', '0.0')} AS decline_pct
FROM (SELECT {O.fixed_period('CAST(c.created_at AS DATE)')} AS period, c.current_state,
    CASE WHEN csp.partner_id IN (SELECT pid FROM enrolled) THEN 'E' ELSE 'N' END AS coh
  FROM candidates c JOIN csp USING (csp_id) WHERE c.etl_current) WHERE period IS NOT NULL GROUP BY 1, 2"""


@register("decline_rate", _DECLINES)
def _(r):
    t = r
    return I.decline_rate(t, R.enrolled(t, CONFIG), CONFIG)


_ENR = "CAST(sum(CASE WHEN partner_id IN (SELECT pid FROM enrolled) THEN 1 ELSE 0 END) AS BIGINT) AS enr, count(*) AS allc"


@register(
    "installs_daily",
    f"""SELECT CAST(lt AS DATE) AS d, {_ENR} FROM installs
WHERE CAST(lt AS DATE) BETWEEN DATE '{CONFIG.launch}' AND DATE '{CONFIG.as_of}' GROUP BY 1""",
)
def _(r):
    t = r
    return I.installs_daily(t, R.enrolled(t, CONFIG), CONFIG)


@register(
    "installs_hourly",
    f"""SELECT CAST(lt AS DATE) AS d, CAST(hour(lt) AS INTEGER) AS hr, {_ENR} FROM installs
WHERE CAST(lt AS DATE) >= DATE '{CONFIG.month_start}' GROUP BY 1, 2""",
)
def _(r):
    t = r
    return I.installs_hourly(t, R.enrolled(t, CONFIG), CONFIG)


def _daily(r):
    t = r
    return P.daily_funnel(B.booking_base_v1(t, CONFIG, R.enrolled(t, CONFIG), CONFIG.daily_from), CONFIG)


@register("daily_funnel", "SELECT * FROM daily1")
def _(r):
    return _daily(r)


@register(
    "daily_trend_enrolled",
    f"SELECT * FROM daily1 WHERE coh = 'E' AND booking_date BETWEEN DATE '{CONFIG.launch}' AND DATE '{CONFIG.as_of}'",
)
def _(r):
    return P.trend(_daily(r), CONFIG, "E")


@register(
    "bookings_daily",
    f"""SELECT booking_date AS d, received AS r FROM daily1
WHERE coh = 'E' AND booking_date BETWEEN DATE '{CONFIG.launch}' AND DATE '{CONFIG.as_of}'""",
)
def _(r):
    return P.bookings_daily(_daily(r), CONFIG)


@register(
    "lag_cohorts",
    f"""SELECT lag, booking_date, received, slot, confirm, assign, install,
  {_v1_rates(("slot", "confirm", "assign", "install"))},
  {O.half_up('received', '(SELECT count(*) FROM enrolled)', 2)} AS per_entity
FROM daily1 JOIN (VALUES (1), (2), (3), (7), (14)) AS l(lag) ON booking_date = DATE '{CONFIG.today}' - lag WHERE coh = 'E'""",
)
def _(r):
    t = r
    size = R.enrolled(t, CONFIG).agg(F.count(F.lit(1)).alias("entities"))
    return P.lag_cohorts(_daily(r), CONFIG, size)


# The class is computed from the entity base and then cuts both bases, so the shared
# inputs are written once.


def _with_classes(r, flows_out: bool = False):
    t = r.parsed()
    people, rows = _people_and_rows(t)
    entity = stage(B.entity_base(t, CONFIG, people, DATE_FROM, rows), "entity_base")
    if flows_out:
        entity = P.without_flows(entity, CONFIG)
    found = C.classify_entities(entity, people, CONFIG)
    return t, people, rows, entity, found


def _booking(t, people, rows):
    return B.booking_base(t, CONFIG, people, DATE_FROM, rows)


def _booking_cuts(r, flows_out: bool = False):
    t, people, rows, _entity, found = _with_classes(r, flows_out)
    base = _booking(t, people, rows)
    if flows_out:
        base = P.without_flows(base, CONFIG)
    found = stage(found, "classes")
    return P.funnel_cuts(DOC.relabel(base, found), P.RULES_BOOKING), people, found


@register("funnel_cuts", f"SELECT period, dim, key, {O.MEASURES} FROM cut2")
def _(r):
    return _booking_cuts(r)[0]


@register("funnel_cuts_entity", f"SELECT period, dim, key, {O.MEASURES} FROM cuts_e")
def _(r):
    _t, _people, _rows, entity, found = _with_classes(r)
    return P.funnel_cuts(DOC.relabel(entity, found), P.RULES_ENTITY)


@register("funnel_cuts_filtered", f"SELECT * FROM ({O.cuts('base2g', O.RULES_BOOKING, where=O.NO_GH)})")
def _(r):
    return _booking_cuts(r, True)[0]


@register("funnel_cuts_entity_filtered", f"SELECT * FROM ({O.cuts('ebaseg', O.RULES_ENTITY, where=O.NO_GH)})")
def _(r):
    _t, _people, _rows, entity, found = _with_classes(r, True)
    return P.funnel_cuts(DOC.relabel(entity, found), P.RULES_ENTITY)


@register(
    "grouping_flags",
    """SELECT o_orderpriority, o_orderstatus, yr, CAST(grouping(o_orderstatus) AS INTEGER) AS g_o_orderstatus,
  CAST(grouping(yr) AS INTEGER) AS g_yr, CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS big,
  round(median(CASE WHEN o_totalprice > 200000 THEN CAST(o_totalprice AS DOUBLE) END)) AS mid
FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders)
GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderpriority, yr))""",
)
def _(r):
    orders = r.table("orders", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("yr"), "o_totalprice")
    big = "o_totalprice > 200000"
    return A.cut_by(
        orders,
        ["o_orderpriority"],
        ["o_orderstatus", "yr"],
        {"big": big},
        {"mid": (big, "o_totalprice")},
    )


_CLS = "pid, CAST(days AS INTEGER) AS days, received, confirmed, installed"


@register("entity_classes", f"SELECT {_CLS}, mg, mgp FROM cls")
def _(r):
    people, date_from, rows = _based(r)
    return C.classify_entities(B.entity_base(r, CONFIG, people, date_from, rows), people, CONFIG)


@register("entity_classes_filtered", f"SELECT {_CLS}, mg, mgp FROM cls_gh")
def _(r):
    people, date_from, rows = _based(r)
    base = P.without_flows(B.entity_base(r, CONFIG, people, date_from, rows), CONFIG)
    return C.classify_entities(base, people, CONFIG)


@register(
    "entity_class_counts",
    """SELECT 'actual' AS kind, key, count(pid) AS entities
FROM (VALUES ('mg_lo'), ('mg_hi'), ('no_mg')) v(key) LEFT JOIN cls ON mg = key GROUP BY 2
UNION ALL SELECT 'projected', key, count(pid)
FROM (VALUES ('mg_lo'), ('mg_hi'), ('no_mg'), ('too_early')) v(key) LEFT JOIN cls ON mgp = key GROUP BY 2""",
)
def _(r):
    found = stage(_with_classes(r)[4], "classes")
    return C.class_counts(found, "mg").withColumn("kind", F.lit("actual")).unionByName(
        C.class_counts(found, "mgp").withColumn("kind", F.lit("projected"))
    )


_F = f"CASE WHEN days < 7 THEN 1.0 ELSE (days + {CONFIG.month_remaining}) / CAST(days AS DOUBLE) END"


@register(
    "entity_class_projection",
    f"""SELECT CAST(round(sum(received * {_F})) AS BIGINT) AS bookings, CAST(round(sum(installed * {_F})) AS BIGINT) AS installs
FROM cls""",
)
def _(r):
    people, date_from, rows = _based(r)
    return C.projection_totals(C.classify_entities(B.entity_base(r, CONFIG, people, date_from, rows), people, CONFIG), CONFIG)


def _class_sql(base: str, label: str, rules: str, where: str = "") -> str:
    return f"""SELECT period, {label} AS mg, {rules} FROM {base}
WHERE coh = 'E' AND period IS NOT NULL AND {label} IS NOT NULL {where} GROUP BY 1, 2"""


@register("class_cut", _class_sql("base2m", "mgp", O.RULES_BOOKING))
def _(r):
    t, people, rows, _entity, found = _with_classes(r)
    return P.class_cut(_booking(t, people, rows), found, "mgp", P.RULES_BOOKING)


@register("class_cut_entity", _class_sql("ebasem", "mgp", O.RULES_ENTITY))
def _(r):
    _t, _people, _rows, entity, found = _with_classes(r)
    return P.class_cut(entity, found, "mgp", P.RULES_ENTITY)


# ---- assembled panels ----

_DAYS_BY = "SELECT CAST({0} AS VARCHAR) AS key, CAST(sum(days) AS BIGINT) AS entity_days, count(*) AS entities FROM {1} WHERE days >= 1 GROUP BY 1"


def _panel_sql(labels: str, cut: str, days: str, cols: str = "key") -> str:
    return f"""SELECT {cols}, period, coalesce(entity_days, 0) AS entity_days, coalesce(entities, 0) AS entities,
  {O.MEASURES}, {O.RATES}, {O.PER_DAY}
FROM {labels} LEFT JOIN ({days}) dd USING (key) LEFT JOIN ({cut}) cc USING (key)"""


def _cut_of(dim: str, src: str = "cut2") -> str:
    return f"SELECT period, key, {O.MEASURES} FROM {src} WHERE dim = '{dim}'"


@register(
    "rate_panel",
    f"""SELECT key, period, entity_days, entities, {O.MEASURES}, {O.RATES}, {O.PER_DAY},
  CASE WHEN key = 'N' THEN {CONFIG.n_days} END AS non_days
FROM (SELECT period, key, {O.MEASURES} FROM cut2 WHERE dim IN ('coh', 'flow')) LEFT JOIN (
  SELECT 'E' AS key, CAST(sum(days) AS BIGINT) AS entity_days, count(*) AS entities FROM roster WHERE days >= 1
  UNION ALL {_DAYS_BY.format('flow', 'roster')}) dd USING (key)""",
)
def _(r):
    cuts, people, _found = _booking_cuts(r)
    return P.cohort_panel(cuts, people, CONFIG)


_VALUES = "(VALUES {}) AS lab(key)"


@register(
    "category_panel",
    _panel_sql(
        "(VALUES ('excited', 'Excited'), ('questions', 'Has Questions'), ('dontcare', 'Indifferent'),"
        " ('dontknow', 'Unaware'), ('not_answered', 'Not Answered')) AS lab(key, label)",
        _cut_of("cat"),
        _DAYS_BY.format("cat", "roster"),
        "key, label",
    ),
)
def _(r):
    cuts, people, _found = _booking_cuts(r)
    return P.category_panel(cuts, people, ANSWER_LABELS)


@register(
    "screen_panel",
    _panel_sql(
        _VALUES.format("('keepgoing'), ('almost'), ('secured'), ('noleads')"),
        _cut_of("screen"),
        _DAYS_BY.format("screen", "roster"),
    ),
)
def _(r):
    cuts, people, _found = _booking_cuts(r)
    return P.screen_panel(cuts, people, CONFIG.screens)


_ENG_DAYS = "\nUNION ALL\n".join(
    f"""SELECT '{label}' AS key, CAST(coalesce(sum(days), 0) AS BIGINT) AS entity_days, count(*) AS entities FROM roster
WHERE days >= 1 AND {dim} = {want}"""
    for label, dim, want in (("Viewed", "viewed", 1), ("Not viewed", "viewed", 0), ("Scrolled", "scrolled", 1),
                             ("Tapped Guarantee", "tapped", 1), ("Ticket tap", "ticket", 1))
)
_ENG_CUT = f"""SELECT label AS key, period, {O.MEASURES} FROM cut2 JOIN (VALUES ('Viewed', 'viewed', '1'),
  ('Not viewed', 'viewed', '0'), ('Scrolled', 'scrolled', '1'), ('Tapped Guarantee', 'tapped', '1'),
  ('Ticket tap', 'ticket', '1')) AS w(label, wdim, wkey) ON wdim = dim AND wkey = cut2.key"""


@register(
    "engagement_panel",
    _panel_sql(
        _VALUES.format("('Viewed'), ('Not viewed'), ('Scrolled'), ('Tapped Guarantee'), ('Ticket tap')"),
        _ENG_CUT,
        _ENG_DAYS,
    ),
)
def _(r):
    cuts, people, _found = _booking_cuts(r)
    return P.engagement_panel(cuts, people)


_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in CLASS_LABELS.items())


@register(
    "class_panel_projected",
    _panel_sql(
        f"(VALUES {_LABELS}) AS lab(key, label)",
        f"SELECT mg AS key, period, {O.MEASURES} FROM ({_class_sql('base2m', 'mgp', O.RULES_BOOKING)})",
        _DAYS_BY.format("mgp", "cls"),
        "key, label",
    ),
)
def _(r):
    t, people, rows, _entity, found = _with_classes(r)
    found = stage(found, "classes")
    block = P.class_cut(_booking(t, people, rows), found, "mgp", P.RULES_BOOKING)
    return P.class_panel(block, found, "mgp", CLASS_LABELS)


_HOURLY_SQL = """(SELECT user_id AS site, date_trunc('hour', ts) AS ts, sum(floor(value)) / 16.0 AS precip,
  sum(k) / count(*) AS cloud FROM ev GROUP BY 1, 2)"""


# ---- panels of the whole document, each built from its section alone ----


def _section(r, name: str):
    return DOC.sections(r.parsed(), CONFIG, "%nation_1%")[name]()


_DAYS_MG = "SELECT {0} AS key, CAST(sum(days) AS BIGINT) AS entity_days, count(*) AS entities FROM {1} WHERE days >= 1 GROUP BY 1"
_ACTUAL = ", ".join(f"('{k}', '{CLASS_LABELS[k]}')" for k in DOC.ACTUAL)


def _mg_cut(src: str) -> str:
    return f"SELECT key, period, {O.MEASURES} FROM {src} WHERE dim = 'mg'"


def _cohorts_sql(cuts: str, classes: str) -> str:
    return f"""SELECT key, period, entity_days, entities, {O.MEASURES}, {O.RATES}, {O.PER_DAY},
  CASE WHEN key = 'N' THEN {CONFIG.n_days} END AS non_days
FROM (SELECT period, key, {O.MEASURES} FROM {cuts} WHERE dim IN ('coh', 'flow')) LEFT JOIN (
  SELECT 'E' AS key, CAST(sum(days) AS BIGINT) AS entity_days, count(*) AS entities FROM roster WHERE days >= 1
  UNION ALL {_DAYS_BY.format('flow', 'roster')}) dd USING (key)"""


@register(
    "class_panel",
    _panel_sql(f"(VALUES {_ACTUAL}) AS lab(key, label)", _mg_cut("cut2"), _DAYS_MG.format("mg", "cls"), "key, label"),
)
def _(r):
    return _section(r, "booking_classes")


@register(
    "class_panel_entity",
    _panel_sql(f"(VALUES {_ACTUAL}) AS lab(key, label)", _mg_cut("cuts_e"), _DAYS_MG.format("mg", "cls"), "key, label"),
)
def _(r):
    return _section(r, "entity_classes")


@register("rate_panel_entity", _cohorts_sql("cuts_e", "cls"))
def _(r):
    return _section(r, "entity_cohorts")


@register("rate_panel_filtered", _cohorts_sql(f"({O.cuts('base2g', O.RULES_BOOKING, where=O.NO_GH)})", "cls_gh"))
def _(r):
    return _section(r, "booking_cohorts_noflow")


@register(
    "class_panel_entity_filtered",
    _panel_sql(
        f"(VALUES {_ACTUAL}) AS lab(key, label)",
        _mg_cut(f"({O.cuts('ebaseg', O.RULES_ENTITY, where=O.NO_GH)})"),
        _DAYS_MG.format("mg", "cls_gh"),
        "key, label",
    ),
)
def _(r):
    return _section(r, "entity_classes_noflow")


@register(
    "document_summary",
    f"""SELECT CAST(NULL AS TIMESTAMP) AS generated, DATE '{CONFIG.as_of}' AS as_of, DATE '{CONFIG.launch}' AS launch,
  DATE '{CONFIG.launch}' - (CAST(coalesce(max(days), 1) AS INTEGER) + 1) AS date_from, count(*) AS enrolled,
  count(screen) AS targeted, true AS anchored, {CONFIG.gate_percent} AS gate_percent, {CONFIG.early_days} AS early_days,
  {CONFIG.month_remaining} AS month_remaining, {CONFIG.n_days} AS non_days FROM roster WHERE days >= 1""",
)
def _(r):
    return _section(r, "summary")


@register(
    "document_weather",
    f"""SELECT site, day, day_rain, night_rain, day_cloud, CASE WHEN day_rain >= 15 THEN 'storm' WHEN day_rain >= 2.5 THEN 'rain'
  WHEN day_rain >= 0.3 THEN 'showers' WHEN night_rain >= 1 THEN 'wet_night' WHEN day_cloud >= 70 THEN 'cloudy'
  ELSE 'clear' END AS weather
FROM (SELECT site, day, day_rain, coalesce(day_cloud, 0.0) AS day_cloud,
    coalesce(lag(late) OVER (PARTITION BY site ORDER BY day), 0) + early AS night_rain
  FROM (SELECT site, CAST(ts AS DATE) AS day, coalesce(sum(precip) FILTER (WHERE hour(ts) BETWEEN 9 AND 18), 0) AS day_rain,
      coalesce(sum(precip) FILTER (WHERE hour(ts) >= 21), 0) AS late, coalesce(sum(precip) FILTER (WHERE hour(ts) <= 6), 0) AS early,
      round(avg(cloud) FILTER (WHERE hour(ts) BETWEEN 9 AND 18), 6) AS day_cloud FROM {_HOURLY_SQL}
    WHERE CAST(ts AS DATE) BETWEEN (SELECT min(d) FROM days_panel) - 1 AND DATE '{CONFIG.today}' GROUP BY 1, 2))""",
)
def _(r):
    return _section(r, "weather").withColumn("day_cloud", F.round("day_cloud", 6))


@register(
    "fixed_window_summary",
    f"""SELECT {CONFIG.n_days} AS n_days, DATE '{CONFIG.pre_start}' AS pre_start, DATE '{CONFIG.pre_end}' AS pre_end,
  DATE '{CONFIG.launch}' AS post_start, DATE '{CONFIG.as_of}' AS post_end, DATE '{CONFIG.month_start}' AS month_start,
  count(*) AS entities FROM enrolled""",
)
def _(r):
    return DOC.fixed_window_sections(r, CONFIG)["summary"]()


@register("pre_post_block", f"SELECT f.*, offers AS decline_offers, declined AS decline_count, decline_pct FROM ({_PRE_POST_RATES}) f LEFT JOIN ({_DECLINES}) d USING (period, coh)")
def _(r):
    return DOC.fixed_window_sections(r, CONFIG)["pre_post"]()


# ---- the nested payload, read back ----

_WHOLE = ("received", "slot", "confirm", "assign", "reached", "install", "csp_days", "csps")
_BLOCK = ", ".join(f"{name}: {'BIGINT' if name in _WHOLE else 'DOUBLE'}" for name in PY.MEASURE_KEYS)


@register(
    "payload_cohorts",
    f"""SELECT CASE key WHEN 'E' THEN 'enr' WHEN 'N' THEN 'non' WHEN 'f1' THEN 'enr_f1' ELSE 'enr_f2' END AS name, period, {O.MEASURES}, {O.RATES},
  entity_days AS csp_days, entities AS csps, recv_per_entity_d AS recv_per_csp_d, inst_per_entity_d AS inst_per_csp_d
FROM (SELECT key, period, entity_days, entities, {O.MEASURES}, {O.PER_DAY} FROM (SELECT * FROM cut2 WHERE dim IN ('coh', 'flow')) LEFT JOIN (
  SELECT 'E' AS key, CAST(sum(days) AS BIGINT) AS entity_days, count(*) AS entities FROM roster WHERE days >= 1
  UNION ALL {_DAYS_BY.format('flow', 'roster')}) dd USING (key))""",
)
def _(r):
    part = PY.grain_parts(DOC.sections(r.parsed(), CONFIG), CONFIG, "booking", "")["tab1"]()
    blocks = ", ".join(f"{name} MAP<STRING, STRUCT<{_BLOCK}>>" for name in PY.COHORT_KEYS)
    read = part.select(F.from_json("json", f"{blocks}, non_days INT").alias("d"))
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.col(f"d.{name}").alias("periods")) for name in PY.COHORT_KEYS]))
    return read.select(named.alias("b")).select("b.name", F.explode("b.periods").alias("period", "m")).select("name", "period", "m.*")


@register(
    "payload_heat_map",
    f"""SELECT CASE k WHEN 'B' THEN 'hourly_book' WHEN 'I' THEN 'hourly_inst' ELSE 'hourly_binst' END AS name, d, hr, n FROM cells
WHERE k IN ('B', 'I', 'K') AND d <= DATE '{CONFIG.today}'
UNION ALL SELECT 'weather of site 3', min(day), NULL, count(*) FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM {_HOURLY_SQL}
  WHERE site = 3 AND CAST(ts AS DATE) BETWEEN (SELECT min(d) FROM days_panel) - 1 AND DATE '{CONFIG.today}')""",
)
def _(r):
    parts = PY.days_parts(DOC.sections(r.parsed(), CONFIG), "", site=3)
    out = None
    for name in PY.HOUR_LISTS:
        cells = parts[name]().select(F.inline(F.from_json("json", "ARRAY<STRUCT<d: DATE, hr: INT, n: BIGINT>>")))
        rows = cells.select(F.lit(name).alias("name"), "d", "hr", "n")
        out = rows if out is None else out.unionAll(rows)
    days = parts["weather"]().select(F.explode(F.from_json("json", "MAP<STRING, STRING>")).alias("day", "weather"))
    shown = days.agg(F.min("day").cast("date").alias("d"), F.count(F.lit(1)).alias("n"))
    return out.unionAll(shown.select(F.lit("weather of site 3"), "d", F.lit(None).cast("int"), "n"))


# ---- cells ----


def _cells(r):
    return I.cells(B.booking_base(r, CONFIG, *_based(r)), DATE_FROM)


@register("day_hour_cells", "SELECT k, d, hr, n FROM cells")
def _(r):
    return _cells(r)


@register("daily_panel", "SELECT d, b, i, j FROM days_panel")
def _(r):
    return I.daily_panel(_cells(r), CONFIG)


@register(
    "hourly_panel",
    f"SELECT k, d, hr, n FROM cells WHERE k IN ('B', 'I', 'K') AND d <= DATE '{CONFIG.today}'",
)
def _(r):
    return I.hourly_panel(_cells(r), CONFIG)


# ---- engagement ----


@register("open_rates", "SELECT period, rg, opens, active_days, opens_d FROM rates_o")
def _(r):
    t = r
    return E.open_rates(t, stage(R.roster(t, CONFIG), "roster"), CONFIG, DATE_FROM)


@register(
    "open_totals",
    """SELECT v.period, CAST(nullif(sum(opens_d), 0) AS BIGINT) AS total_d
FROM (VALUES ('PRE'), ('POST')) v(period) LEFT JOIN rates_o r ON r.period = v.period GROUP BY 1""",
)
def _(r):
    t = r
    return E.open_totals(E.open_rates(t, stage(R.roster(t, CONFIG), "roster"), CONFIG, DATE_FROM))


@register(
    "view_to_action",
    f"""SELECT n_viewed, acted, {O.pct('acted', 'n_viewed')} AS acted_pct,
  CASE WHEN acted > 0 THEN sorted[acted // 2 + 1] END AS median_min,
  CASE WHEN acted > 0 THEN sorted[CAST(floor(acted * 0.75) AS BIGINT) + 1] END AS p75_min,
  CASE WHEN acted > 0 THEN {O.pct('w24', 'n_viewed')} END AS within24h_pct
FROM (SELECT count(*) AS n_viewed, count(*) FILTER (WHERE mins >= 0) AS acted,
  list_sort(list(mins) FILTER (WHERE mins >= 0)) AS sorted, count(*) FILTER (WHERE mins BETWEEN 0 AND 1440) AS w24
  FROM acted)""",
)
def _(r):
    t = r
    return E.view_to_action(E.view_actions(E.viewers(R.roster(t, CONFIG)), t, CONFIG))


# ---- weather ----



@register(
    "daily_weather_class",
    f"""SELECT site, day, day_rain, night_rain, day_cloud, CASE WHEN day_rain >= 15 THEN 'storm' WHEN day_rain >= 2.5 THEN 'rain'
  WHEN day_rain >= 0.3 THEN 'showers' WHEN night_rain >= 1 THEN 'wet_night' WHEN day_cloud >= 70 THEN 'cloudy'
  ELSE 'clear' END AS weather
FROM (SELECT site, day, day_rain, coalesce(day_cloud, 0.0) AS day_cloud,
    coalesce(lag(late) OVER (PARTITION BY site ORDER BY day), 0) + early AS night_rain
  FROM (SELECT site, CAST(ts AS DATE) AS day, coalesce(sum(precip) FILTER (WHERE hour(ts) BETWEEN 9 AND 18), 0) AS day_rain,
      coalesce(sum(precip) FILTER (WHERE hour(ts) >= 21), 0) AS late, coalesce(sum(precip) FILTER (WHERE hour(ts) <= 6), 0) AS early,
      round(avg(cloud) FILTER (WHERE hour(ts) BETWEEN 9 AND 18), 6) AS day_cloud FROM {_HOURLY_SQL} GROUP BY 1, 2))""",
)
def _(r):
    return daily_weather(r.hourly, ["site"]).withColumn("day_cloud", F.round("day_cloud", 6))


# ---- journeys ----


def _rostered(t):
    """Ids of rostered entities; a journey needs none of their attributes."""
    return stage(R.enrolled(t, CONFIG), "enrolled")



@register("lead_journey_flat", O.journey("hour(d.bt) <= 7"))
def _(r):
    t = r
    return JO.lead_journey(t, CONFIG, _rostered(t), DRILL_DAY, T.NIGHT)


@register("lead_journey_hour", O.journey("hour(d.bt) = 11"))
def _(r):
    t = r
    return JO.lead_journey(t, CONFIG, _rostered(t), DRILL_DAY, 11)


@register(
    "lead_journey_document",
    f"""SELECT mobile, masked, booked, (hop_no - 1) // 2 AS part, count(*) AS n_hops,
  string_agg(concat_ws(':', hop_no, entity, enr, coalesce(sent, ''), coalesce(state, ''), reason), '>' ORDER BY hop_no) AS path
FROM (SELECT *, row_number() OVER (PARTITION BY mobile ORDER BY created_at, execution_candidate_id) AS hop_no
  FROM ({O.journey("hour(d.bt) <= 7")})) GROUP BY 1, 2, 3, 4""",
)
def _(r):
    """The nested journey; two hops a row, so that longer ones go on."""
    nested = JO.journey_document(JO.lead_journey(r, CONFIG, _rostered(r), DRILL_DAY, T.NIGHT), max_hops=2)

    def shown(h):
        return F.concat_ws(":", h["hop_no"], h["entity"], h["enr"], F.coalesce(h["sent"], F.lit("")), F.coalesce(h["state"], F.lit("")), h["reason"])

    return nested.select("mobile", "masked", "booked", "part", "n_hops", F.array_join(F.transform("hops", shown), ">").alias("path"))


@register(
    "lead_drill_summary",
    f"""SELECT DATE '{DRILL_DAY}' AS d, 'night' AS hr, count(DISTINCT mobile) AS leads, count(*) AS hops,
  CAST(coalesce(sum(enr), 0) AS BIGINT) AS enrolled_hops FROM ({O.journey("hour(d.bt) <= 7")})""",
)
def _(r):
    return JO.drill(r, CONFIG, _rostered(r), DRILL_DAY, T.NIGHT)["summary"]


_CONV_DAY = "CAST(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(turn AS INTEGER)) AS TIMESTAMP)"


@register(
    "lead_journey_nested",
    """SELECT conv_id, part, count(*) AS n_hops, string_agg(hop_no || ':' || role || ':' || length(text), '>' ORDER BY hop_no) AS path
FROM (SELECT *, (hop_no - 1) // 3 AS part FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS hop_no FROM conversations)) GROUP BY 1, 2""",
)
def _(r):
    turns = r.table("conversations", "conv_id", "turn", "role", F.length("text").alias("chars"))
    hops = turns.withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins="turn"))
    nested = JO.collect_journey(hops, ["conv_id"], "ts", ["role", "chars"], max_hops=3)
    path = F.array_join(F.transform("hops", lambda h: F.concat_ws(":", h["hop_no"], h["role"], h["chars"])), ">")
    return nested.select("conv_id", "part", "n_hops", path.alias("path"))


# ======================================================================================
# sources, sinks, streams
# ======================================================================================


@register("scan_pushdown", "SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND value > 100")
def _(r):
    since = F.lit(CONFIG.launch).cast("timestamp_ntz")
    return r.table("events").filter((F.col("ts") >= since) & (F.col("value") > 100)).select("event_id", "user_id", "ts")


@register("cohort_file", "SELECT pid, flow FROM cohorts")
def _(r):
    """One small {flow1: [...], flow2: [...]} document per entity, written as JSON lines and read back."""
    path = fresh_path(r.spark, "cohort_files")
    own = [F.expr(f"IF(bool_or(flow = '{f}'), array(pid), array())").alias(f) for f in ("flow1", "flow2")]
    r.cohorts.groupBy("pid").agg(*own).drop("pid").write.json(path)
    return read_cohorts(r.spark, path, lines=True)


@register(
    "profile_file",
    "SELECT identity, screen, viewed, scrolled, tapped, ticket, view_fs FROM flags",
)
def _(r):
    path = fresh_path(r.spark, "profiles")
    r.profile_documents.write.json(path)
    return R.profile_flags(read_profiles(r.spark, path, CONFIG.screen_fields), CONFIG.event_prefixes)


@register(
    "hourly_file",
    f"SELECT CAST(site AS VARCHAR) AS site, ts, precip, round(cloud, 6) AS cloud FROM {_HOURLY_SQL}",
)
def _(r):
    """Parallel arrays per site and day (at most 24 entries each), written as JSON and read back."""
    path = fresh_path(r.spark, "hourly")
    arrays = r.hourly.groupBy("site", F.to_date("ts").alias("day")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "precip", "cloud"))).alias("h")
    )
    hourly = F.struct(
        F.transform("h", lambda x: F.date_format(x["ts"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        F.transform("h", lambda x: x["precip"]).alias("precipitation"),
        F.transform("h", lambda x: x["cloud"]).alias("cloud_cover"),
    )
    arrays.select(F.col("site").cast("string").alias("site"), hourly.alias("hourly")).write.json(path)
    return read_hourly(r.spark, path, ["site"]).withColumn("cloud", F.round("cloud", 6))


@register("publish_guard", "SELECT d, b, i, j FROM days_panel")
def _(r):
    """The daily panel through the guarded sink and back."""
    path = fresh_path(r.spark, "published")
    cells = stage(_cells(r), "cells")
    panels = {"daily": I.daily_panel(cells, CONFIG), "hourly": I.hourly_panel(cells, CONFIG)}
    publish_json(panels, path, require=["daily"], order={"daily": ["d"]})
    return r.spark.read.schema("d date, b bigint, i bigint, j bigint").json(f"{published(r.spark, path)}/daily")


@register("stream_dedup", "SELECT event_id, user_id, ts, event_type FROM events")
def _(r):
    """Every event arrives twice; the stream keeps the first arrival."""
    stream = S.read_event_stream(r.spark, f"{r.dir}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    out = S.run_available(S.stream_dedup(twice, ["user_id", "ts", "event_type"], "ts", "1 hour"), "dedup")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register(
    "stream_hourly_cells",
    """SELECT CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS hr, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3""",
)
def _(r):
    stream = S.read_event_stream(r.spark, f"{r.dir}/events.parquet").select("ts", "event_type")
    out = S.run_available(S.stream_hourly_cells(stream, "ts", ["event_type"], "1 hour"), "cells", "update")
    # Update mode: the newest batch holds the current count of a cell.
    newest = F.max(F.struct("batch", "n"))["n"].alias("n")
    return out.groupBy("d", "hr", "event_type").agg(newest)
