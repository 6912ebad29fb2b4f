"""DuckDB statements that state independently what each registered query must return.

They read the supplied tables only and are written in the plainest form (range joins,
whole-key windows, UNION ALL), not in the form the Spark operators use.
"""

from __future__ import annotations

import re

from .event_tables import CONFIG, DATE_FROM, DRILL_DAY

C = CONFIG
STATE_CASE = """CASE WHEN k < 7 THEN 'AWAITING_SLOT_PROPOSAL' WHEN k < 14 THEN 'SLOT_SELECTED'
  WHEN k < 21 THEN 'AWAITING_CUSTOMER_SLOT_CONFIRMATION' WHEN k < 28 THEN 'SLOT_CONFIRMED_BY_CUSTOMER'
  WHEN k < 35 THEN 'SLOT_AUTO_CONFIRMED' WHEN k < 42 THEN 'AWAITING_TECHNICIAN_ASSIGNMENT'
  WHEN k < 49 THEN 'TECHNICIAN_ASSIGNED' WHEN k < 56 THEN 'ARRIVED_AT_SITE'
  WHEN k < 63 THEN 'INSTALLATION_IN_PROGRESS_PRE_FEE' WHEN k < 70 THEN 'FEE_COLLECTION_PENDING'
  WHEN k < 76 THEN 'INSTALLATION_IN_PROGRESS_POST_FEE' WHEN k < 82 THEN 'AWAITING_CUSTOMER_OTP'
  WHEN k < 88 THEN 'CONNECTION_ACTIVE' WHEN k < 93 THEN 'RATING_PENDING' ELSE 'DECLINED' END"""
RANK_CASE = """CASE
  WHEN current_state = 'AWAITING_SLOT_PROPOSAL' THEN 1
  WHEN current_state IN ('SLOT_SELECTED', 'AWAITING_CUSTOMER_SLOT_CONFIRMATION') THEN 2
  WHEN current_state IN ('SLOT_CONFIRMED_BY_CUSTOMER', 'SLOT_AUTO_CONFIRMED', 'AWAITING_TECHNICIAN_ASSIGNMENT') THEN 3
  WHEN current_state = 'TECHNICIAN_ASSIGNED' THEN 4
  WHEN current_state = 'ARRIVED_AT_SITE' THEN 5
  WHEN current_state IN ('INSTALLATION_IN_PROGRESS_PRE_FEE', 'FEE_COLLECTION_PENDING') THEN 6
  WHEN current_state IN ('INSTALLATION_IN_PROGRESS_POST_FEE', 'AWAITING_CUSTOMER_OTP') THEN 7
  WHEN current_state IN ('CONNECTION_ACTIVE', 'RATING_PENDING') THEN 8 ELSE 0 END"""
ACTIONS = """('SLOT_SELECTED', 'AWAITING_CUSTOMER_SLOT_CONFIRMATION', 'DECLINED', 'TECHNICIAN_ASSIGNED', 'ARRIVED_AT_SITE',
  'INSTALLATION_IN_PROGRESS_PRE_FEE', 'INSTALLATION_IN_PROGRESS_POST_FEE', 'FEE_COLLECTION_PENDING',
  'AWAITING_CUSTOMER_OTP', 'CONNECTION_ACTIVE', 'RATING_PENDING')"""


def diff(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


def nonneg(a: str, b: str) -> str:
    return f"CASE WHEN {diff(a, b)} >= 0 THEN {diff(a, b)} END"


def in48(a: str, b: str) -> str:
    return f"CASE WHEN {diff(a, b)} BETWEEN 0 AND {C.mature_minutes} THEN 1 ELSE 0 END"


def half_up(num: str, den: str, digits: int = 1, scale: int = 1, zero: str = "NULL") -> str:
    p = 10**digits
    return (
        f"CASE WHEN CAST({den} AS BIGINT) = 0 THEN {zero} ELSE "
        f"((CAST({num} AS BIGINT) * {2 * scale * p} + CAST({den} AS BIGINT)) // (2 * CAST({den} AS BIGINT))) / {p}.0 END"
    )


def pct(num: str, den: str, zero: str = "NULL") -> str:
    return half_up(num, den, 1, 100, zero)


def cnt(cond: str, name: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END), 0) AS BIGINT) AS {name}"


def med(cond: str, value: str, name: str) -> str:
    return f"round(median(CASE WHEN {cond} THEN CAST({value} AS DOUBLE) END)) AS {name}"


PERIOD = f"""CASE WHEN booking_date BETWEEN ad AND DATE '{C.as_of}' THEN 'POST'
    WHEN booking_date BETWEEN ad - CAST(date_diff('day', ad, DATE '{C.as_of}') + 1 AS INTEGER) AND ad - 1 THEN 'PRE' END"""


def fixed_period(day: str) -> str:
    return f"""CASE WHEN {day} BETWEEN DATE '{C.pre_start}' AND DATE '{C.pre_end}' THEN 'PRE'
  WHEN {day} BETWEEN DATE '{C.launch}' AND DATE '{C.as_of}' THEN 'POST' END"""


RULES_BOOKING = ",\n  ".join(
    [
        cnt("cur_depth >= 2", "received"),
        cnt("cur_depth >= 3 AND acc48 + conf48 + asgn48 + inst48 > 0", "slot"),
        cnt("cur_depth >= 4 AND conf48 + asgn48 + inst48 > 0", "confirm"),
        cnt("cur_depth >= 5 AND asgn48 + inst48 > 0", "assign"),
        cnt("cur_depth >= 6 AND asgn48 + inst48 > 0", "reached"),
        cnt("cur_depth >= 7 AND inst48 = 1", "install"),
        med("cur_depth >= 3 AND acc48 = 1 AND tat_ta >= 0", "tat_ta", "tat_ta"),
        med("conf48 = 1", "tat_sc_m", "tat_sc"),
        med("asgn48 = 1", "tat_ca_m", "tat_ca"),
        med("inst48 = 1", "tat_ai_m", "tat_ai"),
    ]
)
RULES_ENTITY = ",\n  ".join(
    [
        cnt("cur_depth >= 2", "received"),
        cnt("cur_depth >= 3 AND slot48 + conf48 + asgn48 + inst48 > 0", "slot"),
        cnt("cur_depth >= 4 AND conf48 + asgn48 + inst48 > 0", "confirm"),
        cnt("cur_depth >= 5 AND asgn48 + inst48 > 0", "assign"),
        cnt("cur_depth >= 6 AND reached48 + inst48 > 0", "reached"),
        cnt("cur_depth >= 7 AND inst48 = 1", "install"),
        med("slot48 = 1 AND tat_ta >= 0", "tat_ta", "tat_ta"),
        med("conf48 = 1", "tat_sc_m", "tat_sc"),
        med("asgn48 = 1", "tat_ca_m", "tat_ca"),
        med("inst48 = 1", "tat_ai_m", "tat_ai"),
    ]
)
MEASURES = "received, slot, confirm, assign, reached, install, tat_ta, tat_sc, tat_ca, tat_ai"
RATES = f"""{pct('reached', 'received')} AS reached_pct, {pct('slot', 'received')} AS slot_pct,
  {pct('confirm', 'slot')} AS confirm_pct, {pct('assign', 'confirm')} AS assign_pct,
  {pct('install', 'received')} AS install_pct"""
PER_DAY = f"""{half_up('received', 'entity_days', 2)} AS recv_per_entity_d,
  {half_up('install', 'entity_days', 3)} AS inst_per_entity_d"""
DIMS = ["coh", "cat", "screen", "viewed", "scrolled", "tapped", "ticket", "flow", "mg"]
ROSTER_COLS = "cat, screen, viewed, scrolled, tapped, ticket, flow"


def cuts(base: str, rules: str, dims=DIMS, where: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT period, '{d}' AS dim, CAST({d} AS VARCHAR) AS key, {rules}
FROM {base} WHERE coh IS NOT NULL AND period IS NOT NULL AND {d} IS NOT NULL {where} GROUP BY period, {d}"""
        for d in dims
    )


NO_GH = "AND (bflow IS NULL OR bflow NOT IN ('G', 'H'))"


def classes(base: str, where: str = "") -> str:
    return f"""SELECT pid, days, coalesce(received, 0) AS received, coalesce(confirmed, 0) AS confirmed,
    coalesce(installed, 0) AS installed,
    CASE WHEN coalesce(confirmed, 0) < 3 THEN 'mg_lo'
         WHEN installed / confirmed >= 0.6 THEN 'mg_hi' ELSE 'no_mg' END AS mg,
    CASE WHEN days < 7 THEN 'too_early'
         WHEN coalesce(confirmed, 0) * (days + {C.month_remaining}) / days < 3 THEN 'mg_lo'
         WHEN installed / confirmed >= 0.6 THEN 'mg_hi' ELSE 'no_mg' END AS mgp
  FROM (SELECT pid, days FROM roster WHERE days >= 1) r LEFT JOIN (
    SELECT mgpid AS pid, {cnt('cur_depth >= 2', 'received')},
      {cnt('cur_depth >= 4 AND conf48 + asgn48 + reached48 + inst48 > 0', 'confirmed')},
      {cnt('cur_depth >= 7 AND inst48 = 1', 'installed')}
    FROM {base} WHERE coh = 'E' AND period = 'POST' AND mgpid IS NOT NULL {where} GROUP BY 1) m USING (pid)"""


LATEST_CANDIDATE = """SELECT * FROM (
    SELECT connection_id, current_state AS cs, csp_id, created_at AS cur_created, proposed_slot_date AS psd,
      confirmed_slot_at AS csa, installation_completed_at AS ica, executor_id AS exid,
      max(CASE WHEN otp_verified OR installation_completed_at IS NOT NULL OR completed_step >= 7 THEN 1 ELSE 0 END)
        OVER (PARTITION BY connection_id) AS inst_any,
      min(created_at) OVER (PARTITION BY connection_id) AS tcreated,
      row_number() OVER (PARTITION BY connection_id
        ORDER BY updated_at DESC NULLS FIRST, execution_candidate_id DESC) AS rn
    FROM candidates WHERE etl_current) WHERE rn = 1"""


def booking_rows(date_from) -> str:
    """Clean bookings from a day on, with everything known about their connection."""
    return f"""SELECT b.*, x.connection_id, f.cs, f.csp_id, f.cur_created, f.psd, f.csa,
    CASE WHEN f.inst_any = 1 THEN f.ica END AS done_at, f.exid, f.inst_any, f.tcreated,
    (f.connection_id IS NOT NULL) AS has_cand, a.accepted_at, g.t_assign, e.partner_id,
    b.bt - INTERVAL 330 MINUTE AS st
  FROM (SELECT * FROM clean WHERE booking_date >= DATE '{date_from}') b
  LEFT JOIN attr x USING (mobile, booking_date)
  LEFT JOIN latest_cand f ON f.connection_id = x.connection_id
  LEFT JOIN (SELECT connection_id, min(event_timestamp) AS accepted_at FROM event_history
             WHERE event_type = 'ALLOCATION_ACCEPTED' AND NOT deleted GROUP BY 1) a ON a.connection_id = x.connection_id
  LEFT JOIN (SELECT connection_id, min(updated_at) AS t_assign FROM candidates
             WHERE current_state = 'TECHNICIAN_ASSIGNED' AND created_at >= DATE '{date_from}' - INTERVAL 3 DAY
             GROUP BY 1) g ON g.connection_id = x.connection_id
  LEFT JOIN csp e ON e.csp_id = f.csp_id"""


def base_v1(rows: str) -> str:
    return f"""SELECT mobile, booking_date,
    CASE WHEN n.pid IS NOT NULL THEN 'E' WHEN partner_id IS NOT NULL THEN 'N' END AS coh,
    CASE WHEN inst_any = 1 THEN 6
      WHEN exid IS NOT NULL OR cs IN ('TECHNICIAN_ASSIGNED', 'ARRIVED_AT_SITE', 'INSTALLATION_IN_PROGRESS_POST_FEE',
        'AWAITING_CUSTOMER_OTP', 'FEE_COLLECTION_PENDING') THEN 5
      WHEN csa IS NOT NULL OR cs = 'AWAITING_TECHNICIAN_ASSIGNMENT' THEN 4
      WHEN psd IS NOT NULL OR cs = 'AWAITING_CUSTOMER_SLOT_CONFIRMATION' THEN 3
      WHEN has_cand THEN 2 ELSE 1 END AS cur_depth,
    {nonneg('st', 'accepted_at')} AS tat_slot_m, {nonneg('st', 'csa')} AS tat_conf_m,
    {nonneg('st', 'done_at')} AS tat_inst_m, {diff('tcreated', 'accepted_at')} AS tat_ta,
    {nonneg('accepted_at', 'csa')} AS tat_sc_m, {nonneg('csa', 't_assign')} AS tat_ca_m,
    {nonneg('t_assign', 'done_at')} AS tat_ai_m,
    CASE WHEN cs = 'DECLINED' THEN 1 ELSE 0 END AS declined
  FROM {rows} LEFT JOIN enrolled n ON n.pid = partner_id"""


# Name -> body, in dependency order. Only the ones a statement mentions are put in front of it.
CTES = {
    "ev": """SELECT event_id, ts, user_id, event_type, value,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
    user_id + CAST(regexp_extract(props, '[0-9]+') AS INTEGER) // 34 AS num,
    CAST(user_id + 5999999997 AS VARCHAR) AS mobile,
    user_id || '/' || (date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 4) AS conn,
    user_id || '-' || (CAST(regexp_extract(props, '[0-9]+') AS INTEGER) // 50) AS acct FROM events""",
    "bookings": """SELECT mobile, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS booking_date, ts + INTERVAL 330 MINUTE AS bt,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 330 MINUTE AS nb
  FROM ev WHERE event_type = 'signup'""",
    "accounts": """SELECT mobile, acct AS account_id,
    CASE WHEN k < 90 THEN 'L' || user_id || '-' || (k // 10) END AS lco_account_id,
    CASE WHEN value > 5 THEN ts END AS added_time,
    CASE WHEN k < 15 THEN 'A' WHEN k < 30 THEN 'B' WHEN k < 45 THEN 'G' WHEN k < 60 THEN 'H' WHEN k < 80 THEN 'C' END
      AS group_name, value > 100 AS deleted FROM ev WHERE event_type = 'signup'""",
    "test_accounts": """SELECT CASE WHEN k < 95 THEN 'L' || user_id || '-' || (k // 10) END AS lco_account_id
  FROM ev WHERE event_type = 'error' AND value > 100""",
    "event_history": """SELECT conn AS connection_id,
    CASE event_type WHEN 'view' THEN 'CONNECTION_REQUEST' WHEN 'click' THEN 'ALLOCATION_ACCEPTED' ELSE 'OTHER' END
      AS event_type, ts AS event_timestamp, value > 150 AS deleted FROM ev""",
    "connections": """SELECT conn AS connection_id, user_id || '-' || (min(k) // 50) AS customer_id, max(value) > 5 AS active
  FROM ev WHERE event_type = 'view' GROUP BY conn, user_id""",
    "candidates": f"""SELECT conn AS connection_id, CAST(event_id AS VARCHAR) AS execution_candidate_id, 'e' || num AS csp_id,
    {STATE_CASE} AS current_state, ts AS created_at, ts + to_minutes(k * 10) AS updated_at,
    CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) + 1 END AS proposed_slot_date,
    CASE WHEN event_type = 'click' AND value > 20 THEN ts + INTERVAL 2 HOUR END AS confirmed_slot_at,
    CASE WHEN event_type = 'purchase' AND value > 60 THEN ts + INTERVAL 6 HOUR END AS installation_completed_at,
    CASE WHEN event_type = 'error' AND value > 20 THEN 'x' || k END AS executor_id,
    CASE WHEN event_type <> 'view' THEN event_type = 'purchase' AND value > 90 END AS otp_verified,
    CASE WHEN event_type <> 'error' THEN k // 13 END AS completed_step,
    value > 4 AS etl_current,
    CASE WHEN k >= 93 AND value > 30 THEN 'busy' WHEN k >= 93 AND value > 20 THEN '' END AS failure_reason,
    CASE WHEN k >= 97 THEN 'far' WHEN k >= 95 THEN '' END AS failure_subreason_code,
    CASE WHEN k >= 93 THEN 'r' || k END AS reason_code
  FROM ev WHERE event_type <> 'signup'""",
    "history": f"""SELECT conn AS connection_id, 'e' || num AS csp_id, CAST(event_id AS VARCHAR) AS execution_candidate_id,
    {STATE_CASE} AS current_state, ts AS created_at, ts + to_minutes(k * 10) AS updated_at
  FROM ev WHERE event_type <> 'signup'
  UNION ALL
  SELECT conn, 'e' || num, CAST(event_id AS VARCHAR), 'CONNECTION_ACTIVE', ts, ts + INTERVAL 6 HOUR
  FROM ev WHERE event_type = 'purchase'""",
    "allocations": """SELECT conn AS connection_id, CASE WHEN value > 10 THEN ts - INTERVAL 30 MINUTE END AS assigned_at,
    CASE WHEN value < 120 THEN ts + to_minutes(k) END AS acceptance_timestamp, value > 3 AS active
  FROM ev WHERE event_type = 'click'""",
    "entities": """SELECT 'e' || num AS csp_id, CASE WHEN value < 250 THEN CAST(num + 1000 AS VARCHAR) END AS partner_id,
    'Entity ' || num || '-' || k AS name, value < 300 AS active FROM ev WHERE event_type = 'click' AND value > 100""",
    "csp": """SELECT csp_id, min(partner_id) AS partner_id FROM entities WHERE active GROUP BY 1""",
    "entity_dim": """SELECT DISTINCT 'e' || num AS csp_id, CAST(num + 1000 AS VARCHAR) AS partner_id, value < 200 AS etl_current
  FROM ev WHERE event_type = 'click' AND value > 60""",
    "users": """SELECT DISTINCT CASE WHEN k >= 95 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS id, 'e' || num AS csp_id,
    CASE event_type WHEN 'click' THEN 'OWNER' WHEN 'view' THEN 'MANAGER' WHEN 'purchase' THEN 'MANAGER_PLUS'
      ELSE 'TECHNICIAN' END AS role,
    CASE WHEN value > 30 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status FROM ev""",
    "optins": """SELECT CAST(num + 1000 AS VARCHAR) AS partner_id, CASE WHEN k < 80 THEN 'MG' ELSE 'OTHER' END AS program,
    CASE WHEN value <= 200 THEN ts END AS first_opted_at FROM ev WHERE event_type = 'purchase' AND value > 90""",
    "campaign": """SELECT CASE WHEN k < 90 THEN 'C1' ELSE 'C2' END AS campaign_id, CAST(num + 1000 AS VARCHAR) AS partner_id,
    CASE WHEN k >= 20 THEN ts END AS scan_complete_at FROM ev WHERE event_type = 'click' AND value > 90""",
    "cohorts": """SELECT DISTINCT CAST(num + 1000 AS VARCHAR) AS pid,
    CASE event_type WHEN 'error' THEN 'flow1' ELSE 'flow2' END AS flow FROM ev
  WHERE (event_type = 'error' AND value > 140) OR (event_type = 'view' AND value > 113)""",
    "screen_log": """SELECT CASE WHEN k >= 98 THEN 'RAW' || user_id WHEN k >= 96 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS pid,
    CASE WHEN k < 50 THEN 'f3a' ELSE 'f3b' END || CASE WHEN value < 10 THEN 'X' ELSE '_' END ||
      CASE WHEN k < 20 THEN 'excited' WHEN k < 40 THEN 'dontknow' WHEN k < 60 THEN 'dontcare' WHEN k < 80 THEN 'questions'
        ELSE 'bogus' END AS screen,
    CASE WHEN value > 130 THEN '2' ELSE '3' END AS flow, ts FROM ev WHERE event_type = 'view'""",
    "flags": """SELECT CAST(user_id AS VARCHAR) AS identity,
    CASE WHEN arg_max(k, ts) < 20 THEN 'keepgoing' WHEN arg_max(k, ts) < 40 THEN 'almost'
      WHEN arg_max(k, ts) < 60 THEN 'secured' WHEN arg_max(k, ts) < 75 THEN 'noleads'
      WHEN arg_max(k, ts) < 85 THEN 'other' WHEN arg_min(k, ts) < 50 THEN 'keepgoing' ELSE '' END AS screen,
    max(CASE WHEN event_type = 'view' AND value > 113 THEN 1 ELSE 0 END) AS viewed,
    max(CASE WHEN event_type = 'click' AND value > 113 THEN 1 ELSE 0 END) AS scrolled,
    max(CASE WHEN event_type = 'purchase' AND value > 113 THEN 1 ELSE 0 END) AS tapped,
    max(CASE WHEN event_type = 'error' AND value > 113 THEN 1 ELSE 0 END) AS ticket,
    CAST(min(CASE WHEN event_type = 'view' AND value > 113 THEN epoch_us(ts) // 1000000 END) AS BIGINT) AS view_fs
  FROM ev GROUP BY user_id""",
    "app_events": """SELECT CAST(user_id AS VARCHAR) AS device_id,
    CASE WHEN value > 200 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text,
    CASE event_type WHEN 'click' THEN 'App Launched' ELSE 'Other' END AS event_name,
    CASE WHEN value >= 50 THEN value > 150 END AS deleted, ts + to_hours(c) AS synced
  FROM ev, (VALUES (1), (2)) AS copies(c) WHERE event_type IN ('click', 'signup') AND (c = 1 OR value < 20)""",
    "app_profiles": """SELECT CAST(user_id AS VARCHAR) AS device_id, 'e' || num AS csp_id,
    CASE user_id % 5 WHEN 0 THEN 'owner' WHEN 1 THEN 'Manager' WHEN 2 THEN 'MANAGER_PLUS'
      WHEN 3 THEN 'Technician' ELSE 'guest' END AS role,
    CASE WHEN value < 200 THEN value > 180 END AS deleted FROM ev""",
    # ---- people ---------------------------------------------------------------------------
    "opted": """SELECT partner_id AS pid, min(first_opted_at) AS first_opted_at FROM optins
  WHERE program = 'MG' AND first_opted_at IS NOT NULL GROUP BY 1""",
    "enrolled": """SELECT pid FROM opted WHERE pid IN (SELECT pid FROM cohorts WHERE flow = 'flow1')
  OR (pid IN (SELECT pid FROM cohorts WHERE flow = 'flow2')
      AND pid IN (SELECT partner_id FROM campaign WHERE campaign_id = 'C1' AND scan_complete_at IS NOT NULL))""",
    "anchored": f"""SELECT e.pid, coalesce(greatest(CAST(o.first_opted_at + INTERVAL 330 MINUTE AS DATE), DATE '{C.launch}'),
    DATE '{C.launch}') AS ad FROM enrolled e LEFT JOIN opted o USING (pid)""",
    "owners": """SELECT u.id AS identity, min(d.partner_id) AS pid FROM users u JOIN entity_dim d USING (csp_id)
  WHERE u.role IN ('OWNER', 'MANAGER', 'MANAGER_PLUS') AND u.status = 'ACTIVE' AND d.etl_current
    AND d.partner_id IN (SELECT pid FROM enrolled) GROUP BY 1""",
    "cats": """SELECT pid, code AS cat FROM (
    SELECT o.pid, substr(s.screen, 5) AS code,
      row_number() OVER (PARTITION BY o.pid ORDER BY s.ts DESC, substr(s.screen, 5) DESC) AS rn
    FROM screen_log s JOIN owners o ON try_cast(s.pid AS BIGINT) = try_cast(o.identity AS BIGINT)
    WHERE s.flow = '3' AND s.pid NOT LIKE 'RAW%' AND (s.screen LIKE 'f3a_%' OR s.screen LIKE 'f3b_%')
      AND try_cast(s.pid AS BIGINT) NOT IN (7, 11)
      AND substr(s.screen, 5) IN ('excited', 'dontknow', 'dontcare', 'questions')) WHERE rn = 1""",
    "engaged": """SELECT pid, coalesce(arg_min(screen, identity) FILTER (WHERE screen <> ''), '') AS screen,
    max(viewed) AS viewed, max(scrolled) AS scrolled, max(tapped) AS tapped, max(ticket) AS ticket, min(view_fs) AS view_fs
  FROM flags JOIN owners USING (identity) GROUP BY 1""",
    "roster": f"""SELECT a.pid, a.ad, coalesce(c.cat, 'not_answered') AS cat,
    CASE WHEN t THEN e.screen END AS screen, CASE WHEN t THEN e.viewed END AS viewed,
    CASE WHEN t THEN e.scrolled END AS scrolled, CASE WHEN t THEN e.tapped END AS tapped,
    CASE WHEN t THEN e.ticket END AS ticket,
    CASE WHEN a.pid IN (SELECT pid FROM cohorts WHERE flow = 'flow2') THEN 'f2' ELSE 'f1' END AS flow,
    date_diff('day', a.ad, DATE '{C.as_of}') + 1 AS days,
    CASE WHEN e.viewed = 1 THEN e.view_fs END AS view_fs
  FROM anchored a LEFT JOIN cats c USING (pid)
  LEFT JOIN (SELECT *, screen IN ('keepgoing', 'almost', 'secured', 'noleads') AS t FROM engaged) e USING (pid)""",
    # ---- bases ----------------------------------------------------------------------------
    "clean": """SELECT b.mobile, b.booking_date, b.bt, b.nb, a.bflow FROM (
    SELECT *, row_number() OVER (PARTITION BY mobile, booking_date ORDER BY bt, nb NULLS LAST) AS rn FROM bookings) b
  LEFT JOIN (SELECT mobile, lco_account_id AS lco, group_name AS bflow, row_number() OVER (PARTITION BY mobile
      ORDER BY added_time DESC NULLS LAST, account_id DESC NULLS LAST, lco_account_id DESC NULLS LAST,
        group_name DESC NULLS LAST) AS rn FROM accounts WHERE NOT deleted) a ON a.mobile = b.mobile AND a.rn = 1
  WHERE b.rn = 1 AND (a.lco IS NULL
    OR a.lco NOT IN (SELECT lco_account_id FROM test_accounts WHERE lco_account_id IS NOT NULL))""",
    "all_requests": """SELECT DISTINCT m.mobile, h.event_timestamp AS rts, h.connection_id
  FROM event_history h JOIN connections c ON c.connection_id = h.connection_id AND c.active
  JOIN (SELECT DISTINCT mobile, acct FROM ev WHERE event_type = 'signup' AND value >= 1) m ON m.acct = c.customer_id
  WHERE h.event_type = 'CONNECTION_REQUEST' AND NOT h.deleted""",
    "requests": "SELECT * FROM all_requests WHERE mobile > '5999999999'",
    "attr": """SELECT mobile, booking_date, connection_id FROM (
    SELECT b.mobile, b.booking_date, r.connection_id, row_number() OVER (PARTITION BY b.mobile, b.booking_date
      ORDER BY r.rts, r.connection_id) AS rn
    FROM clean b JOIN requests r ON r.mobile = b.mobile
      AND r.rts BETWEEN b.bt - INTERVAL 330 MINUTE - INTERVAL 2 HOUR AND b.bt - INTERVAL 330 MINUTE + INTERVAL 14 DAY
      AND (b.nb IS NULL OR r.rts + INTERVAL 330 MINUTE < b.nb)) WHERE rn = 1""",
    "latest_cand": LATEST_CANDIDATE,
    "rows2": booking_rows(DATE_FROM),
    "rows1": booking_rows(C.pre_start),
    "rows1d": booking_rows(C.daily_from),
    "base1": base_v1("rows1"),
    "base1d": base_v1("rows1d"),
    "base2": f"""SELECT *, {PERIOD} AS period FROM (
    SELECT mobile, booking_date, CAST(date_part('hour', bt) AS INTEGER) AS bhr, bflow, g.pid AS mgpid,
      CASE WHEN g.pid IS NOT NULL THEN 'E' WHEN partner_id IS NOT NULL THEN 'N' END AS coh, {ROSTER_COLS},
      coalesce(g.ad, DATE '{C.launch}') AS ad,
      CASE WHEN inst_any = 1 THEN 7
        WHEN cs IN ('ARRIVED_AT_SITE', 'INSTALLATION_IN_PROGRESS_PRE_FEE', 'INSTALLATION_IN_PROGRESS_POST_FEE',
          'AWAITING_CUSTOMER_OTP', 'FEE_COLLECTION_PENDING') THEN 6
        WHEN exid IS NOT NULL OR cs = 'TECHNICIAN_ASSIGNED' THEN 5
        WHEN csa IS NOT NULL OR cs = 'AWAITING_TECHNICIAN_ASSIGNMENT' THEN 4
        WHEN psd IS NOT NULL OR cs = 'AWAITING_CUSTOMER_SLOT_CONFIRMATION' THEN 3
        WHEN has_cand THEN 2 ELSE 1 END AS cur_depth,
      {in48('st', 'accepted_at')} AS acc48, {in48('st', 'csa')} AS conf48, {in48('st', 't_assign')} AS asgn48,
      {in48('st', 'done_at')} AS inst48,
      CASE WHEN accepted_at IS NOT NULL AND cur_created IS NOT NULL
        THEN greatest({diff('cur_created', 'accepted_at')}, 0) END AS tat_ta,
      {nonneg('accepted_at', 'csa')} AS tat_sc_m, {nonneg('csa', 't_assign')} AS tat_ca_m,
      {nonneg('t_assign', 'done_at')} AS tat_ai_m, done_at + INTERVAL 330 MINUTE AS inst_ts
    FROM rows2 LEFT JOIN roster g ON g.pid = partner_id)""",
    "alloc": """SELECT connection_id, assigned_at, acceptance_timestamp FROM (
    SELECT *, row_number() OVER (PARTITION BY connection_id
      ORDER BY assigned_at DESC NULLS LAST, acceptance_timestamp DESC) AS rn
    FROM allocations WHERE active AND acceptance_timestamp IS NOT NULL) WHERE rn = 1""",
    "stages": f"""SELECT connection_id, csp_id, min(created_at) AS recv,
    min(updated_at) FILTER (WHERE rk >= 2) AS slot_ts, min(updated_at) FILTER (WHERE rk >= 3) AS conf_ts,
    min(updated_at) FILTER (WHERE rk >= 4) AS asgn_ts, min(updated_at) FILTER (WHERE rk >= 5) AS reached_ts,
    min(updated_at) FILTER (WHERE rk >= 8) AS inst_ts, max(rk) AS maxrank
  FROM (SELECT *, {RANK_CASE} AS rk FROM history) GROUP BY 1, 2""",
    "ebase": f"""SELECT *, {PERIOD} AS period FROM (
    SELECT b.mobile, b.booking_date, CAST(date_part('hour', b.bt) AS INTEGER) AS bhr, b.bflow, s.csp_id, g.pid AS mgpid,
      CASE WHEN g.pid IS NOT NULL THEN 'E' WHEN e.partner_id IS NOT NULL THEN 'N' END AS coh, {ROSTER_COLS},
      coalesce(g.ad, DATE '{C.launch}') AS ad,
      CASE WHEN maxrank >= 8 THEN 7 WHEN maxrank >= 5 THEN 6 WHEN maxrank >= 4 THEN 5 WHEN maxrank >= 3 THEN 4
        WHEN maxrank >= 2 THEN 3 ELSE 2 END AS cur_depth,
      {in48('recv', 'slot_ts')} AS slot48, {in48('recv', 'conf_ts')} AS conf48, {in48('recv', 'asgn_ts')} AS asgn48,
      {in48('recv', 'reached_ts')} AS reached48, {in48('recv', 'inst_ts')} AS inst48,
      CASE WHEN maxrank >= 2 AND {diff('assigned_at', 'acceptance_timestamp')} BETWEEN 0 AND 2880
        THEN {diff('assigned_at', 'acceptance_timestamp')} END AS tat_ta,
      {nonneg('slot_ts', 'conf_ts')} AS tat_sc_m, {nonneg('conf_ts', 'asgn_ts')} AS tat_ca_m,
      {nonneg('asgn_ts', 'inst_ts')} AS tat_ai_m
    FROM attr x JOIN (SELECT * FROM clean WHERE booking_date >= DATE '{DATE_FROM}') b USING (mobile, booking_date)
    JOIN stages s ON s.connection_id = x.connection_id
    LEFT JOIN alloc l ON l.connection_id = x.connection_id
    LEFT JOIN csp e ON e.csp_id = s.csp_id
    LEFT JOIN roster g ON g.pid = e.partner_id)""",
    "cls": classes("ebase"),
    "cls_gh": classes("ebase", NO_GH),
    "base2m": "SELECT b.*, c.mg, c.mgp FROM base2 b LEFT JOIN cls c ON c.pid = b.mgpid",
    "ebasem": "SELECT b.*, c.mg, c.mgp FROM ebase b LEFT JOIN cls c ON c.pid = b.mgpid",
    "base2g": "SELECT b.*, c.mg, c.mgp FROM base2 b LEFT JOIN cls_gh c ON c.pid = b.mgpid",
    "ebaseg": "SELECT b.*, c.mg, c.mgp FROM ebase b LEFT JOIN cls_gh c ON c.pid = b.mgpid",
    "rosterm": "SELECT r.*, c.mg, c.mgp FROM roster r LEFT JOIN cls c USING (pid)",
    "cut2": cuts("base2m", RULES_BOOKING),
    "cuts_e": cuts("ebasem", RULES_ENTITY),
    "installs": """SELECT e.partner_id, i.ica + INTERVAL 330 MINUTE AS lt FROM (
    SELECT connection_id, csp_id, installation_completed_at AS ica, row_number() OVER (PARTITION BY connection_id
      ORDER BY installation_completed_at, execution_candidate_id) AS rn
    FROM candidates WHERE etl_current AND installation_completed_at IS NOT NULL) i
  JOIN csp e ON e.csp_id = i.csp_id WHERE rn = 1""",
    "daily1": f"""SELECT booking_date, coh, {cnt('cur_depth >= 2', 'received')}, {cnt('cur_depth >= 3', 'slot')},
    {cnt('cur_depth >= 4', 'confirm')}, {cnt('cur_depth >= 6', 'install')}, {cnt('cur_depth >= 5', 'assign')},
    {med('cur_depth >= 3 AND tat_ta >= 0', 'tat_ta', 'tat_task_slot')}, {med('true', 'tat_sc_m', 'tat_slot_confirm')},
    {med('true', 'tat_ca_m', 'tat_confirm_assign')}, {med('true', 'tat_ai_m', 'tat_assign_install')}
  FROM base1d WHERE coh IS NOT NULL GROUP BY 1, 2""",
    "cells": f"""SELECT 'B' AS k, booking_date AS d, bhr AS hr, count(*) AS n FROM base2 WHERE coh = 'E' AND cur_depth >= 2 GROUP BY 2, 3
  UNION ALL SELECT 'I', CAST(inst_ts AS DATE), CAST(date_part('hour', inst_ts) AS INTEGER), count(*) FROM base2
    WHERE coh = 'E' AND CAST(inst_ts AS DATE) >= DATE '{DATE_FROM}' GROUP BY 2, 3
  UNION ALL SELECT 'J', CAST(inst_ts AS DATE), CAST(date_part('hour', inst_ts) AS INTEGER), count(*) FROM base2
    WHERE coh = 'N' AND CAST(inst_ts AS DATE) >= DATE '{DATE_FROM}' GROUP BY 2, 3
  UNION ALL SELECT 'K', booking_date, bhr, count(*) FROM base2 WHERE coh = 'E' AND cur_depth >= 7 GROUP BY 2, 3""",
    "days_panel": f"""SELECT d, {cnt("k = 'x'", 'z')}, CAST(sum(CASE WHEN k = 'B' THEN n ELSE 0 END) AS BIGINT) AS b,
    CAST(sum(CASE WHEN k = 'I' THEN n ELSE 0 END) AS BIGINT) AS i, CAST(sum(CASE WHEN k = 'J' THEN n ELSE 0 END) AS BIGINT) AS j
  FROM cells WHERE k <> 'K' AND d <= DATE '{C.as_of}' GROUP BY d""",
    "opens": f"""SELECT * FROM (SELECT e.device_id, e.ts_text, c.pid, CAST(try_cast(e.ts_text AS TIMESTAMP) AS DATE) AS dt,
      CASE WHEN upper(p.role) = 'OWNER' THEN 'owner' WHEN upper(p.role) IN ('MANAGER', 'MANAGER_PLUS') THEN 'mgr'
        WHEN upper(p.role) = 'TECHNICIAN' THEN 'tech' END AS rg,
      row_number() OVER (PARTITION BY e.device_id, e.ts_text, e.event_name ORDER BY e.synced, c.pid,
        CASE WHEN upper(p.role) = 'OWNER' THEN 'owner' WHEN upper(p.role) IN ('MANAGER', 'MANAGER_PLUS') THEN 'mgr'
        WHEN upper(p.role) = 'TECHNICIAN' THEN 'tech' END NULLS LAST) AS rn
    FROM app_events e JOIN app_profiles p ON p.device_id = e.device_id
    JOIN (SELECT DISTINCT csp_id, partner_id AS pid FROM entities WHERE active
          AND partner_id IN (SELECT pid FROM roster)) c ON c.csp_id = p.csp_id
    WHERE e.event_name = 'App Launched' AND try_cast(e.ts_text AS TIMESTAMP) >= DATE '{DATE_FROM}'
      AND NOT coalesce(e.deleted, false) AND NOT coalesce(p.deleted, false)) WHERE rn = 1 AND rg IS NOT NULL""",
    "open_periods": f"""SELECT {PERIOD.replace('booking_date', 'dt')} AS period, rg, o.pid, dt FROM opens o JOIN roster USING (pid)""",
    "rates_o": f"""SELECT period, rg, count(*) AS opens, count(DISTINCT pid || '|' || dt) AS active_days,
    CAST({half_up('count(*) * (SELECT count(*) FROM roster WHERE days >= 1)',
                  '(SELECT sum(days) FROM roster WHERE days >= 1)', 0)} AS BIGINT) AS opens_d
  FROM open_periods WHERE period IS NOT NULL GROUP BY 1, 2""",
    "views": """SELECT pid, make_timestamp(view_fs * 1000000) AS view_ts FROM roster WHERE days >= 1 AND view_fs <> 0""",
    "acts": f"""SELECT v.pid, v.view_ts, min(h.updated_at) AS action_ts FROM views v LEFT JOIN (
      SELECT csp.partner_id AS pid, r.updated_at FROM history r JOIN csp USING (csp_id)
      WHERE r.created_at >= DATE '{C.launch}' AND r.current_state IN {ACTIONS}) h
    ON h.pid = v.pid AND h.updated_at > v.view_ts GROUP BY 1, 2""",
    "acted": """SELECT pid, view_ts, action_ts,
    CAST(round(date_diff('second', view_ts, action_ts) / 60.0) AS BIGINT) AS mins FROM acts""",
    "drill": f"""SELECT b.*, r.connection_id, row_number() OVER (PARTITION BY b.mobile, b.booking_date
      ORDER BY r.rts, r.connection_id) AS rn FROM clean b JOIN all_requests r ON r.mobile = b.mobile
      AND r.rts BETWEEN b.bt - INTERVAL 330 MINUTE - INTERVAL 2 HOUR AND b.bt - INTERVAL 330 MINUTE + INTERVAL 14 DAY
      AND (b.nb IS NULL OR r.rts + INTERVAL 330 MINUTE < b.nb) WHERE b.booking_date = DATE '{DRILL_DAY}'""",
    "names": "SELECT csp_id, partner_id AS pid, max(name) AS nm FROM entities WHERE active GROUP BY 1, 2",
}

DRILL_SHOW = "strftime({} + INTERVAL 330 MINUTE, '%m/%d %H:%M')"


def journey(hour_cond: str) -> str:
    raw = f"""(SELECT execution_candidate_id,
      min(updated_at) FILTER (WHERE current_state IN ('SLOT_SELECTED', 'AWAITING_CUSTOMER_SLOT_CONFIRMATION')) AS prop,
      min(updated_at) FILTER (WHERE current_state = 'DECLINED') AS decl,
      min(updated_at) FILTER (WHERE current_state = 'TECHNICIAN_ASSIGNED') AS asgn,
      min(updated_at) FILTER (WHERE current_state IN ('CONNECTION_ACTIVE', 'RATING_PENDING')) AS inst
    FROM history WHERE created_at >= DATE '{DRILL_DAY}' - 1 GROUP BY 1)"""
    show = DRILL_SHOW.format
    return f"""SELECT d.mobile, d.connection_id, c.execution_candidate_id, c.created_at,
  left(d.mobile, 2) || 'XXXXX' || right(d.mobile, 3) AS masked, strftime(d.bt, '%m/%d %H:%M') AS booked,
  coalesce(n.nm, '?') AS entity, CASE WHEN n.pid IN (SELECT pid FROM roster) THEN 1 ELSE 0 END AS enr,
  {show('c.created_at')} AS sent, c.current_state AS state, {show('w.prop')} AS prop, {show('w.decl')} AS decl,
  {show('w.asgn')} AS asgn, {show('w.inst')} AS inst,
  coalesce(nullif(c.failure_reason, ''), nullif(c.reason_code, ''), '')
    || coalesce(' / ' || nullif(c.failure_subreason_code, ''), '') AS reason,
  {show('c.updated_at')} AS upd
FROM drill d
JOIN latest_cand t ON t.connection_id = d.connection_id
JOIN names o ON o.csp_id = t.csp_id AND o.pid IN (SELECT pid FROM roster)
JOIN candidates c ON c.connection_id = d.connection_id AND c.etl_current
LEFT JOIN names n ON n.csp_id = c.csp_id
LEFT JOIN {raw} w ON w.execution_candidate_id = c.execution_candidate_id
WHERE d.rn = 1 AND {hour_cond}"""


def statement(final: str) -> str:
    """Put the CTEs that ``final`` needs, directly or not, in front of it."""
    names = list(CTES)
    needed: set[str] = set()

    def visit(text: str, self_name: str = "") -> None:
        for name in names:
            if name not in needed and name != self_name and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name], name)

    visit(final)
    if not needed:
        return final
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in names if n in needed)
    return f"WITH {body}\n{final}"
