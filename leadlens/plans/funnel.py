"""Funnel panels over the two bases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CUT_DIMS, ENGAGEMENT_ROWS, FunnelConfig
from ..functions.labels import label_of
from ..functions.predicates import exclude_values
from ..functions.rates import pct, ratio, whole
from ..functions.temporal import between_dates, period_fixed
from ..operators.aggregates import cut_by, entity_days, group_funnel, pick_cut


# Stage rules, as (counts, medians) of SQL conditions: a later stage's evidence also counts
# for the earlier ones.
Rules = tuple[dict[str, str], dict[str, tuple[str, str]]]

RULES_V1: Rules = (
    {
        "received": "cur_depth >= 2",
        "slot": "cur_depth >= 3",
        "confirm": "cur_depth >= 4",
        "install": "cur_depth >= 6",
        "assign": "cur_depth >= 5",
        "decline": "declined = 1",
    },
    {
        "tat_accept": ("cur_depth >= 3 AND tat_ta >= 0", "tat_ta"),
        "tat_slot": ("true", "tat_slot_m"),
        "tat_confirm": ("true", "tat_conf_m"),
        "tat_install": ("true", "tat_inst_m"),
        "tat_sc": ("true", "tat_sc_m"),
        "tat_ca": ("true", "tat_ca_m"),
        "tat_ai": ("true", "tat_ai_m"),
    },
)


def _flagged(depth: int, *flags: str) -> str:
    return f"cur_depth >= {depth} AND 1 IN ({', '.join(flags)})"


def _rules(first: str, reached: str, accepted: str) -> Rules:
    counts = {
        "received": "cur_depth >= 2",
        "slot": _flagged(3, first, "conf48", "asgn48", "inst48"),
        "confirm": _flagged(4, "conf48", "asgn48", "inst48"),
        "assign": _flagged(5, "asgn48", "inst48"),
        "reached": _flagged(6, reached, "inst48"),
        "install": _flagged(7, "inst48"),
    }
    medians = {
        "tat_ta": (f"{accepted} AND tat_ta >= 0", "tat_ta"),
        "tat_sc": ("conf48 = 1", "tat_sc_m"),
        "tat_ca": ("asgn48 = 1", "tat_ca_m"),
        "tat_ai": ("inst48 = 1", "tat_ai_m"),
    }
    return counts, medians


# The booking grain has no "reached" flag of its own; the assignment flag stands in.
RULES_BOOKING = _rules("acc48", "asgn48", "cur_depth >= 3 AND acc48 = 1")
RULES_ENTITY = _rules("slot48", "reached48", "slot48 = 1")

COUNTS = ["received", "slot", "confirm", "assign", "reached", "install"]
TATS = ["tat_ta", "tat_sc", "tat_ca", "tat_ai"]
MEASURES = [*COUNTS, *TATS]


# ---- fixed windows ------------------------------------------------------------------------


def funnel_pre_post(base_v1: DataFrame, cfg: FunnelConfig) -> DataFrame:
    period = period_fixed("booking_date", (cfg.pre_start, cfg.pre_end), (cfg.launch, cfg.as_of))
    rows = base_v1.withColumn("period", period).filter(F.col("coh").isNotNull() & F.col("period").isNotNull())
    return group_funnel(rows, ["period", "coh"], *RULES_V1)


def rates_v1(block: DataFrame, n_days: int, n_entities: DataFrame) -> DataFrame:
    """Percent of received (0 on an empty funnel), per-day averages, received per entity and day.

    ``n_entities`` is a one-row frame with column ``entities``.
    """
    rows = block.withColumn("entities", n_entities.select("entities").scalar())
    return rows.select(
        *block.columns,
        *[whole(c, str(n_days)).alias(f"{c}_d") for c in ("received", "slot", "confirm", "install", "assign")],
        *[pct(c, "received", zero_den=0.0).alias(f"{c}_pct") for c in ("slot", "confirm", "assign", "install")],
        pct("install", "confirm", zero_den=0.0).alias("install_ratio"),
        ratio("received", f"{n_days} * entities", 2).alias("per_entity_d"),
    )


def daily_funnel(base_v1: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Stage counts and four medians per booking day and cohort."""
    counts, medians = RULES_V1
    rows = base_v1.filter(F.col("coh").isNotNull() & (F.col("booking_date") >= F.lit(cfg.daily_from)))
    names = {
        "tat_task_slot": "tat_accept",
        "tat_slot_confirm": "tat_sc",
        "tat_confirm_assign": "tat_ca",
        "tat_assign_install": "tat_ai",
    }
    wanted = {k: v for k, v in counts.items() if k != "decline"}
    return group_funnel(
        rows, ["booking_date", "coh"], wanted, {name: medians[src] for name, src in names.items()}
    )


def trend(daily: DataFrame, cfg: FunnelConfig, cohort: str) -> DataFrame:
    """The POST part of the daily funnel for one cohort."""
    return daily.filter((F.col("coh") == cohort) & between_dates("booking_date", cfg.launch, cfg.as_of))


def bookings_daily(daily: DataFrame, cfg: FunnelConfig) -> DataFrame:
    return trend(daily, cfg, "E").select(F.col("booking_date").alias("d"), F.col("received").alias("r"))


def lag_cohorts(daily: DataFrame, cfg: FunnelConfig, n_entities: DataFrame) -> DataFrame:
    """Enrolled bookings of 1, 2, 3, 7, 14 days ago as they stand now; missing days are skipped."""
    lag = F.datediff(F.lit(cfg.today), F.col("booking_date"))
    rows = daily.filter((F.col("coh") == "E") & lag.isin(list(cfg.lags))).withColumn("lag", lag)
    rows = rows.withColumn("entities", n_entities.select("entities").scalar())
    return rows.select(
        "lag",
        "booking_date",
        "received",
        "slot",
        "confirm",
        "assign",
        "install",
        *[pct(c, "received", zero_den=0.0).alias(f"{c}_pct") for c in ("slot", "confirm", "assign", "install")],
        ratio("received", "entities", 2).alias("per_entity"),
    )


# ---- cuts ---------------------------------------------------------------------------------


def without_flows(base: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Bookings of the excluded flows removed; bookings without a flow stay."""
    return exclude_values(base, "bflow", cfg.excluded_flows, keep_null=True)


def funnel_cuts(base: DataFrame, rules: Rules, dims: Sequence[str] = CUT_DIMS) -> DataFrame:
    """All cuts in one pass, long form: period, dim, key, counts, medians."""
    counts, medians = rules
    rows = base.filter(F.col("coh").isNotNull() & F.col("period").isNotNull())
    return pick_cut(cut_by(rows, ["period"], dims, counts, medians), ["period"], dims, MEASURES)


def class_cut(base: DataFrame, classes: DataFrame, label: str, rules: Rules) -> DataFrame:
    """Funnel per period and class; the label is joined late onto the shared base."""
    counts, medians = rules
    labelled = classes.select(F.col("pid").alias("mgpid"), F.col(label).alias("mg"))
    rows = base.drop("mg").filter((F.col("coh") == "E") & F.col("period").isNotNull()).join(labelled, ["mgpid"])
    return group_funnel(rows.filter(F.col("mg").isNotNull()), ["period", "mg"], counts, medians)


def stage_rates(block: DataFrame) -> DataFrame:
    return block.select(
        "*",
        pct("reached", "received").alias("reached_pct"),
        pct("slot", "received").alias("slot_pct"),
        pct("confirm", "slot").alias("confirm_pct"),
        pct("assign", "confirm").alias("assign_pct"),
        pct("install", "received").alias("install_pct"),
    )


def per_entity_day(block: DataFrame) -> DataFrame:
    return block.select(
        "*",
        ratio("received", "entity_days", 2).alias("recv_per_entity_d"),
        ratio("install", "entity_days", 3).alias("inst_per_entity_d"),
    )


# ---- assembled panels ----------------------------------------------------------------------


def cut_panel(cuts: DataFrame, roster: DataFrame, dim: str, labels: DataFrame) -> DataFrame:
    """One row per wanted key and period: entities, entity-days, counts, medians and rates.

    ``labels`` (key, label) fixes the rows; keys without bookings keep NULL measures.
    """
    block = stage_rates(cuts.filter(F.col("dim") == dim).drop("dim"))
    days = entity_days(roster.withColumn("key", F.col(dim).cast("string")), ["key"])
    out = labels.join(days, ["key"], "left").fillna(0, subset=["entity_days", "entities"])
    return per_entity_day(out.join(block, ["key"], "left"))


def cohort_panel(cuts: DataFrame, roster: DataFrame, cfg: FunnelConfig) -> DataFrame:
    """Enrolled, non-enrolled, and enrolled by flow. Entity-day rates only for enrolled groups."""
    live_all = entity_days(roster.withColumn("key", F.lit("E")), ["key"])
    live_flow = entity_days(roster.withColumn("key", F.col("flow")), ["key"])
    block = stage_rates(cuts.filter(F.col("dim").isin("coh", "flow")).drop("dim"))
    out = per_entity_day(block.join(live_all.unionByName(live_flow), ["key"], "left"))
    return out.withColumn("non_days", F.when(F.col("key") == "N", F.lit(cfg.n_days)))


def label_frame(like: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """(key, label) rows from a mapping of fixed values."""
    return like.sparkSession.createDataFrame(list(labels.items()), "key string, label string")


def category_panel(cuts: DataFrame, roster: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    codes = label_frame(cuts, {k: k for k in labels}).select("key")
    out = cut_panel(cuts, roster, "cat", codes)
    return out.withColumn("label", label_of("key", labels))


def screen_panel(cuts: DataFrame, roster: DataFrame, screens: Sequence[str]) -> DataFrame:
    return cut_panel(cuts, roster, "screen", label_frame(cuts, {s: s for s in screens}).select("key"))


def engagement_panel(cuts: DataFrame, roster: DataFrame) -> DataFrame:
    """Viewed / not viewed / scrolled / tapped / ticket; all rows from one pass over the cuts."""
    rows = cuts.sparkSession.createDataFrame(
        [(label, dim, str(want)) for label, dim, want in ENGAGEMENT_ROWS], "label string, dim string, key string"
    )
    dims = list(dict.fromkeys(dim for _, dim, _ in ENGAGEMENT_ROWS))
    flags = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("key")) for d in dims]))
    days = entity_days(roster.select("days", flags.alias("f")).select("days", "f.dim", "f.key"), ["dim", "key"])
    out = rows.join(days, ["dim", "key"], "left").fillna(0, subset=["entity_days", "entities"])
    out = out.join(stage_rates(cuts.filter(F.col("dim").isin(dims))), ["dim", "key"], "left")
    return per_entity_day(out).drop("dim", "key").withColumnRenamed("label", "key")


def class_panel(block: DataFrame, classes: DataFrame, label: str, labels: Mapping[str, str]) -> DataFrame:
    """Rows per class of the actual or projected label, with the rates of the class."""
    days = entity_days(classes.withColumn("key", F.col(label)), ["key"])
    rows = label_frame(block, labels).join(days, ["key"], "left").fillna(0, subset=["entity_days", "entities"])
    measured = stage_rates(block.withColumnRenamed("mg", "key"))
    return per_entity_day(rows.join(measured, ["key"], "left"))
