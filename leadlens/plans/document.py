"""The full set of panels. Each is built when it is asked for; what several panels read is written once, by the first."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from threading import RLock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ANSWER_LABELS, CLASS_LABELS, FunnelConfig
from ..operators.aggregates import complement_count
from ..operators.joins import lookup
from ..session import stage, staging, together
from ..sources.publish import publish_json
from . import classes as C
from . import engagement as E
from . import funnel as P
from . import installs as I
from .base import BOOKING_KEY, attributed_since, booking_base, booking_base_v1, entity_base
from .payload import payload
from .roster import enrolled, longest_live_days, roster, with_class
from .tables import Tables
from .weather import daily_weather

Section = Callable[[], DataFrame]

ACTUAL = ["mg_lo", "mg_hi", "no_mg"]


class Once:
    """A shared input: made by the first panel that needs it. If that fails, all panels that need it fail alike.

    Others that ask for it at the same time wait for the first.
    """

    def __init__(self, make: Callable):
        self.make, self.value, self.error, self.lock = make, None, None, RLock()

    def __call__(self):
        with self.lock:
            if self.error:
                raise self.error
            if self.value is None:
                try:
                    self.value = self.make()
                except PySparkException as error:
                    self.error = error
                    raise
            return self.value


def staged(make: Section, name: str) -> Once:
    return Once(lambda: stage(make(), name))


@dataclass(frozen=True)
class Bases:
    """Staged inputs that every panel reads."""

    roster: DataFrame
    booking: DataFrame
    entity: DataFrame
    date_from: dt.date


@dataclass(frozen=True)
class SharedInputs:
    """The same, each made when it is first called."""

    roster: Once
    booking: Once
    entity: Once
    date_from: Once


def shared_inputs(t: Tables, cfg: FunnelConfig) -> SharedInputs:
    people = staged(lambda: roster(t, cfg), "roster")
    date_from = Once(lambda: cfg.scan_from(longest_live_days(people())))
    rows = staged(lambda: attributed_since(t, cfg, date_from()), "attributed")
    return SharedInputs(
        people,
        staged(lambda: booking_base(t, cfg, people(), date_from(), rows()), "booking_base"),
        staged(lambda: entity_base(t, cfg, people(), date_from(), rows()), "entity_base"),
        date_from,
    )


def build_bases(t: Tables, cfg: FunnelConfig) -> Bases:
    shared = shared_inputs(t, cfg)
    return Bases(shared.roster(), shared.booking(), shared.entity(), shared.date_from())


def relabel(base: DataFrame, classes: DataFrame) -> DataFrame:
    """Late join of the actual class onto a base; bookings of other entities have no ``mgpid``."""
    label = classes.select(F.col("pid").alias("mgpid"), "mg")
    return lookup(base.drop("mg"), label, ["mgpid"], row_id=BOOKING_KEY)


def grain_sections(base: Section, rules, people: Section, classes: Section, cfg: FunnelConfig) -> dict[str, Section]:
    """Cohort, category, screen, engagement and class panels of one grain."""
    labelled = Once(lambda: with_class(people(), classes(), "mg"))
    # The classes come from the other base: both are made at the same time.
    cuts = staged(lambda: P.funnel_cuts(relabel(*together(base, classes)), rules), "cuts")

    def actual() -> DataFrame:
        block = cuts().filter(F.col("dim") == "mg").drop("dim").withColumnRenamed("key", "mg")
        return P.class_panel(block, classes(), "mg", {k: CLASS_LABELS[k] for k in ACTUAL})

    return {
        "cohorts": lambda: P.cohort_panel(cuts(), labelled(), cfg),
        "categories": lambda: P.category_panel(cuts(), labelled(), ANSWER_LABELS),
        "screens": lambda: P.screen_panel(cuts(), labelled(), cfg.screens),
        "engagement": lambda: P.engagement_panel(cuts(), labelled()),
        "classes": actual,
        "classes_projected": lambda: P.class_panel(P.class_cut(base(), classes(), "mgp", rules), classes(), "mgp", CLASS_LABELS),
    }


def summary(people: DataFrame, cfg: FunnelConfig, date_from: dt.date, generated: dt.datetime | None = None) -> DataFrame:
    """One row of scalars: dates and gates of the document, live entities and those that a banner targets.

    ``generated`` is the caller's time of the refresh; the library never reads the clock.
    """
    live = people.filter(F.col("days") >= 1)
    return live.agg(F.count(F.lit(1)).alias("enrolled"), F.count("screen").alias("targeted")).select(
        F.lit(generated).cast("timestamp_ntz").alias("generated"),
        F.lit(cfg.as_of).alias("as_of"),
        F.lit(cfg.launch).alias("launch"),
        F.lit(date_from).alias("date_from"),
        "enrolled",
        "targeted",
        F.lit(True).alias("anchored"),
        F.lit(cfg.gate_percent).alias("gate_percent"),
        F.lit(cfg.early_days).alias("early_days"),
        F.lit(cfg.month_remaining).alias("month_remaining"),
        F.lit(cfg.n_days).alias("non_days"),
    )


def weather_panel(hourly: DataFrame, daily: DataFrame, cfg: FunnelConfig, date_from: dt.date) -> DataFrame:
    """Weather of the days that the daily panel shows, from the day before its first one up to today.

    The series starts there, so that its first day has no night before. A ``site`` column makes a series for each site.
    """
    keys = [c for c in ("site",) if c in hourly.columns]
    day = F.to_date("ts")
    bounded = hourly.filter((F.col("ts") >= F.lit(date_from - dt.timedelta(days=1)).cast("timestamp_ntz")) & (day <= F.lit(cfg.today)))
    shown = bounded.filter(day >= F.date_sub(daily.select(F.min("d")).scalar(), 1))
    return daily_weather(shown, keys)


def sections(t: Tables, cfg: FunnelConfig, city_pattern: str = "%delhi%", generated: dt.datetime | None = None) -> dict[str, Section]:
    """Panel name -> what builds it: both grains, with and without the excluded flows, and the summary.

    ``publish_json`` takes these as they are: a section that fails leaves out its own panel and no other.
    """
    bases = shared_inputs(t, cfg)
    people = bases.roster
    out: dict[str, Section] = {"summary": lambda: summary(people(), cfg, bases.date_from(), generated)}

    def scope(suffix: str, within: Callable[[DataFrame], DataFrame]) -> None:
        booking, entity = Once(lambda: within(bases.booking())), Once(lambda: within(bases.entity()))
        classes = staged(lambda: C.classify_entities(entity(), people(), cfg), "classes")
        for grain, base, rules in (("booking", booking, P.RULES_BOOKING), ("entity", entity, P.RULES_ENTITY)):
            for name, build in grain_sections(base, rules, people, classes, cfg).items():
                out[f"{grain}_{name}{suffix}"] = build
        out[f"class_counts{suffix}"] = lambda: C.class_counts(classes(), "mg")
        out[f"class_counts_projected{suffix}"] = lambda: C.class_counts(classes(), "mgp")
        out[f"projection{suffix}"] = lambda: C.projection_totals(classes(), cfg)
        cell_rows = staged(lambda: I.cells(booking(), bases.date_from()), "cells")
        out[f"daily{suffix}"] = lambda: I.daily_panel(cell_rows(), cfg)
        out[f"hourly{suffix}"] = lambda: I.hourly_panel(cell_rows(), cfg)

    scope("", lambda base: base)
    scope("_noflow", lambda base: P.without_flows(base, cfg))
    rates = staged(lambda: E.open_rates(t, people(), cfg, bases.date_from()), "app_opens")
    out["app_opens"] = rates
    out["app_opens_total"] = lambda: E.open_totals(rates())
    out["view_to_action"] = lambda: E.view_to_action(E.view_actions(E.viewers(people()), t, cfg))
    out["targeted"] = lambda: out["summary"]().select("targeted", "enrolled")
    if t.cities is not None:
        live = Once(lambda: people().filter(F.col("days") >= 1))
        out["non_enrolled"] = lambda: complement_count(t.cities, "partner_id", "partner_city", city_pattern, live())
    if t.hourly is not None:
        out["weather"] = lambda: weather_panel(t.hourly, out["daily"](), cfg, bases.date_from())
    return out


def dashboard(t: Tables, cfg: FunnelConfig, city_pattern: str = "%delhi%", generated: dt.datetime | None = None) -> dict[str, DataFrame]:
    """All ``sections`` as DataFrames; the first that fails raises."""
    return {name: build() for name, build in sections(t, cfg, city_pattern, generated).items()}


#: Without this panel nothing is published.
MAIN_PANEL = "booking_cohorts"


def refresh(
    t: Tables,
    cfg: FunnelConfig,
    path: str,
    city_pattern: str = "%delhi%",
    generated: dt.datetime | None = None,
    site: str | int | None = None,
) -> list[str]:
    """One refresh: publishes the sections as a new version below ``path`` and removes what was staged for it.

    The folder ``payload`` of the version has them as one nested JSON document. The main panel must be there and
    have rows, else the version before stays; any other section may fail.
    """
    with staging(t.bookings.sparkSession):
        every = sections(t, cfg, city_pattern, generated)
        whole = {"payload": lambda: payload(every, cfg, site).select("json")}
        return publish_json(every | whole, path, require=[MAIN_PANEL], as_text=["payload"])


def fixed_window_sections(t: Tables, cfg: FunnelConfig) -> dict[str, Section]:
    """The fixed-window funnel: PRE/POST blocks with declines, installs, daily trends and lag cohorts, and the windows."""
    ids = staged(lambda: enrolled(t, cfg), "enrolled")
    size = Once(lambda: ids().agg(F.count(F.lit(1)).alias("entities")))
    rows = staged(lambda: attributed_since(t, cfg, min(cfg.pre_start, cfg.daily_from)), "attributed")

    def base_since(first: dt.date) -> DataFrame:
        return booking_base_v1(t, cfg, ids(), first, rows().filter(F.col("booking_date") >= F.lit(first)))

    daily = staged(lambda: P.daily_funnel(base_since(cfg.daily_from), cfg), "daily")
    declines = staged(lambda: I.decline_rate(t, ids(), cfg), "declines")
    windows = {
        "n_days": cfg.n_days,
        "pre_start": cfg.pre_start,
        "pre_end": cfg.pre_end,
        "post_start": cfg.launch,
        "post_end": cfg.as_of,
        "month_start": cfg.month_start,
    }
    return {
        "summary": lambda: size().select(*[F.lit(v).alias(k) for k, v in windows.items()], "entities"),
        "pre_post": lambda: I.with_declines(P.rates_v1(P.funnel_pre_post(base_since(cfg.pre_start), cfg), cfg.n_days, size()), declines()),
        "declines": declines,
        "installs_daily": lambda: I.installs_daily(t, ids(), cfg),
        "installs_hourly": lambda: I.installs_hourly(t, ids(), cfg),
        "bookings_daily": lambda: P.bookings_daily(daily(), cfg),
        "daily": lambda: P.trend(daily(), cfg, "E"),
        "daily_non": lambda: P.trend(daily(), cfg, "N"),
        "lag_cohorts": lambda: P.lag_cohorts(daily(), cfg, size()),
    }


def fixed_window_document(t: Tables, cfg: FunnelConfig) -> dict[str, DataFrame]:
    """All ``fixed_window_sections`` as DataFrames; the first that fails raises."""
    return {name: build() for name, build in fixed_window_sections(t, cfg).items()}
