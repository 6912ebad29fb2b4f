"""The input relations, by role."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Tables:
    """Role name -> DataFrame. Columns:

    bookings        mobile, booking_date, bt (local), nb (local, next booking)
    accounts        mobile, account_id, lco_account_id, added_time, group_name, deleted
    test_accounts   lco_account_id
    all_accounts    mobile, account_id
    event_history   connection_id, event_type, event_timestamp, deleted
    connections     connection_id, customer_id, active
    candidates      connection_id, execution_candidate_id, csp_id, current_state, created_at, updated_at,
                    proposed_slot_date, confirmed_slot_at, installation_completed_at, executor_id,
                    otp_verified, completed_step, etl_current, failure_reason, failure_subreason_code, reason_code
    history         connection_id, csp_id, execution_candidate_id, current_state, created_at, updated_at
    allocations     connection_id, assigned_at, acceptance_timestamp, active
    entities        csp_id, partner_id, name, active
    entity_dim      csp_id, partner_id, etl_current
    users           id, csp_id, role, status
    app_events      device_id, ts_text, event_name, deleted, synced
    app_profiles    device_id, csp_id, role, deleted
    cities          partner_id, partner_city
    optins          partner_id, program, first_opted_at
    campaign        campaign_id, partner_id, scan_complete_at
    screen_log      pid, screen, flow, ts
    cohorts         pid, flow
    profiles        identity, screen, events (map)
    hourly          ts (local hour), precip, cloud; site where there are several
    """

    bookings: DataFrame | None = None
    accounts: DataFrame | None = None
    test_accounts: DataFrame | None = None
    all_accounts: DataFrame | None = None
    event_history: DataFrame | None = None
    connections: DataFrame | None = None
    candidates: DataFrame | None = None
    history: DataFrame | None = None
    allocations: DataFrame | None = None
    entities: DataFrame | None = None
    entity_dim: DataFrame | None = None
    users: DataFrame | None = None
    app_events: DataFrame | None = None
    app_profiles: DataFrame | None = None
    cities: DataFrame | None = None
    optins: DataFrame | None = None
    campaign: DataFrame | None = None
    screen_log: DataFrame | None = None
    cohorts: DataFrame | None = None
    profiles: DataFrame | None = None
    hourly: DataFrame | None = None
