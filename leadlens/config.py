"""Settings and rule tables.

Everything that is a business choice (dates, windows, gates, state names) lives
here as data; the operators take it as parameters.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field, replace

# --------------------------------------------------------------------------
# Lifecycle states and their rank (0 for every other state).
STATE_RANK = {
    "AWAITING_SLOT_PROPOSAL": 1,
    "SLOT_SELECTED": 2,
    "AWAITING_CUSTOMER_SLOT_CONFIRMATION": 2,
    "SLOT_CONFIRMED_BY_CUSTOMER": 3,
    "SLOT_AUTO_CONFIRMED": 3,
    "AWAITING_TECHNICIAN_ASSIGNMENT": 3,
    "TECHNICIAN_ASSIGNED": 4,
    "ARRIVED_AT_SITE": 5,
    "INSTALLATION_IN_PROGRESS_PRE_FEE": 6,
    "FEE_COLLECTION_PENDING": 6,
    "INSTALLATION_IN_PROGRESS_POST_FEE": 7,
    "AWAITING_CUSTOMER_OTP": 7,
    "CONNECTION_ACTIVE": 8,
    "RATING_PENDING": 8,
}
# Minimum rank -> stage depth at entity grain (2 when below all).
RANK_DEPTH = [(8, 7), (5, 6), (4, 5), (3, 4), (2, 3)]
# Minimum rank that marks each stage time at entity grain.
STAGE_RANKS = {"slot": 2, "conf": 3, "asgn": 4, "reached": 5, "inst": 8}
# States that count as "technician assigned or later" in the six-level ladder.
ASSIGNED_OR_LATER = [
    "TECHNICIAN_ASSIGNED",
    "ARRIVED_AT_SITE",
    "INSTALLATION_IN_PROGRESS_POST_FEE",
    "AWAITING_CUSTOMER_OTP",
    "FEE_COLLECTION_PENDING",
]
# States that count as "site reached" in the seven-level ladder.
REACHED_STATES = [
    "ARRIVED_AT_SITE",
    "INSTALLATION_IN_PROGRESS_PRE_FEE",
    "INSTALLATION_IN_PROGRESS_POST_FEE",
    "AWAITING_CUSTOMER_OTP",
    "FEE_COLLECTION_PENDING",
]
# States that count as an action on a lead.
ACTION_STATES = [
    "SLOT_SELECTED",
    "AWAITING_CUSTOMER_SLOT_CONFIRMATION",
    "DECLINED",
    "TECHNICIAN_ASSIGNED",
    "ARRIVED_AT_SITE",
    "INSTALLATION_IN_PROGRESS_PRE_FEE",
    "INSTALLATION_IN_PROGRESS_POST_FEE",
    "FEE_COLLECTION_PENDING",
    "AWAITING_CUSTOMER_OTP",
    "CONNECTION_ACTIVE",
    "RATING_PENDING",
]
# Hop times shown in a lead journey.
JOURNEY_STATES = {
    "prop": ["SLOT_SELECTED", "AWAITING_CUSTOMER_SLOT_CONFIRMATION"],
    "decl": ["DECLINED"],
    "asgn": ["TECHNICIAN_ASSIGNED"],
    "inst": ["CONNECTION_ACTIVE", "RATING_PENDING"],
}
# Roles that own an entity, and role -> role group.
OWNER_ROLES = ["OWNER", "MANAGER", "MANAGER_PLUS"]
ROLE_GROUP = {"OWNER": "owner", "MANAGER": "mgr", "MANAGER_PLUS": "mgr", "TECHNICIAN": "tech"}
# Feedback answers and their labels.
ANSWER_LABELS = {
    "excited": "Excited",
    "questions": "Has Questions",
    "dontcare": "Indifferent",
    "dontknow": "Unaware",
    "not_answered": "Not Answered",
}
NOT_ANSWERED = "not_answered"
ANSWER_CODES = [code for code in ANSWER_LABELS if code != NOT_ANSWERED]
# Banner screens that make an entity "targeted".
SCREENS = ["keepgoing", "almost", "secured", "noleads"]
# Fields of a profile that hold its screen, and key prefixes of its events by engagement flag.
SCREEN_FIELDS = ["mbg_screen_real", "mbg_screen"]
EVENT_PREFIXES = {"viewed": "MBG_View_", "scrolled": "MBG_Scroll_", "tapped": "MBG_TapGuarantee_", "ticket": "MBG_Ticket_"}
# Guarantee classes and their labels.
CLASS_LABELS = {
    "mg_lo": "Getting MG · <3 leads",
    "mg_hi": "Getting MG · ≥3 leads",
    "no_mg": "Not getting MG",
    "too_early": "Too early (<7 days)",
}
# The nine cuts of the funnel.
CUT_DIMS = ["coh", "cat", "screen", "viewed", "scrolled", "tapped", "ticket", "flow", "mg"]
# Engagement panel rows (label, roster flag, wanted value).
ENGAGEMENT_ROWS = [
    ("Viewed", "viewed", 1),
    ("Not viewed", "viewed", 0),
    ("Scrolled", "scrolled", 1),
    ("Tapped Guarantee", "tapped", 1),
    ("Ticket tap", "ticket", 1),
]
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class FunnelConfig:
    """Windows, offsets and gates. ``as_of`` is the last complete day, never the wall clock."""

    launch: dt.date
    as_of: dt.date
    history_start: dt.date | None = None
    offset_minutes: int = 330
    before_hours: int = 2
    after_days: int = 14
    mature_minutes: int = 2880
    assigned_lookback_days: int = 3
    min_subject: str = "5999999999"
    gate_percent: int = 60
    min_confirmed: int = 3
    early_days: int = 7
    lags: tuple[int, ...] = (1, 2, 3, 7, 14)
    daily_lookback_days: int = 16
    excluded_flows: tuple[str, ...] = ("G", "H")
    program: str = "MG"
    campaign: str = "C1"
    test_identities: tuple[int, ...] = ()
    screens: tuple[str, ...] = field(default=tuple(SCREENS))
    screen_fields: tuple[str, ...] = field(default=tuple(SCREEN_FIELDS))
    event_prefixes: dict[str, str] = field(default_factory=lambda: dict(EVENT_PREFIXES), hash=False)

    def __post_init__(self) -> None:
        if self.as_of < self.launch:
            object.__setattr__(self, "as_of", self.launch)

    @property
    def today(self) -> dt.date:
        return self.as_of + dt.timedelta(days=1)

    @property
    def n_days(self) -> int:
        """Complete days since launch; also the length of the fixed PRE window."""
        return (self.as_of - self.launch).days + 1

    @property
    def pre_start(self) -> dt.date:
        return self.launch - dt.timedelta(days=self.n_days)

    @property
    def pre_end(self) -> dt.date:
        return self.launch - dt.timedelta(days=1)

    @property
    def month_start(self) -> dt.date:
        return self.today.replace(day=1)

    @property
    def daily_from(self) -> dt.date:
        return self.today - dt.timedelta(days=self.daily_lookback_days)

    @property
    def month_remaining(self) -> int:
        last = calendar.monthrange(self.as_of.year, self.as_of.month)[1]
        return last - self.as_of.day

    def scan_from(self, longest_live_days: int | None) -> dt.date:
        """First booking day any anchored PRE window can need."""
        start = self.launch - dt.timedelta(days=(longest_live_days or 1) + 1)
        return min(start, self.history_start) if self.history_start else start

    def with_(self, **changes) -> "FunnelConfig":
        return replace(self, **changes)
