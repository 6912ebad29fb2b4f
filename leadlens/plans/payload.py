"""The sections as one nested JSON document, in the layout that a page reads.

Each part of the document is a small aggregate: as many rows as there are cohorts, labels, classes, or days and hours of the shown
window, whatever the data. It becomes one JSON value by an aggregation, and the parts are put together by scalar look-ups.
A part whose section fails is null, except for the main one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ANSWER_LABELS, CLASS_LABELS, ENGAGEMENT_ROWS, FunnelConfig
from ..session import stage

Section = Callable[[], DataFrame]

# --------------------------------------------------------------------------
# Names of measures in a block, and the panel columns they show.
MEASURE_KEYS = {
    "received": "received",
    "slot": "slot",
    "confirm": "confirm",
    "assign": "assign",
    "reached": "reached",
    "install": "install",
    "reached_pct": "reached_pct",
    "slot_pct": "slot_pct",
    "confirm_pct": "confirm_pct",
    "assign_pct": "assign_pct",
    "install_pct": "install_pct",
    "tat_ta": "tat_ta",
    "tat_sc": "tat_sc",
    "tat_ca": "tat_ca",
    "tat_ai": "tat_ai",
    "csp_days": "entity_days",
    "csps": "entities",
    "recv_per_csp_d": "recv_per_entity_d",
    "inst_per_csp_d": "inst_per_entity_d",
}
# Names of the cohort blocks and their keys.
COHORT_KEYS = {"enr": "E", "non": "N", "enr_f1": "f1", "enr_f2": "f2"}
# Names of the four documents within the document, by grain and scope.
GRAINS = {"": ("booking", ""), "csp": ("entity", ""), "noGH": ("booking", "_noflow"), "csp_noGH": ("entity", "_noflow")}
# Names of the heat-map lists and their tags.
HOUR_LISTS = {"hourly_book": "B", "hourly_inst": "I", "hourly_binst": "K"}
GENERATED_FORMAT = "dd MMM yyyy, HH:mm 'IST'"
# --------------------------------------------------------------------------

KEEP_NULLS = {"ignoreNullFields": "false"}


def as_json(value: Column) -> Column:
    return F.to_json(value, KEEP_NULLS)


def json_object(parts: Mapping[str, Column]) -> Column:
    """An object of values that are JSON already; null where one is NULL."""
    fields = [F.concat(F.lit(f'"{name}":'), F.coalesce(value, F.lit("null"))) for name, value in parts.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def _text(value: Column) -> Column:
    """A scalar as JSON."""
    return F.regexp_extract(as_json(F.struct(value.alias("v"))), r"^\{\"v\":(.*)\}$", 1)


def _list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def ordered_list(rows: DataFrame, order: Iterable[Column], item: Column) -> DataFrame:
    """One row: the items (JSON) of ``rows`` in order, as a list."""
    entry = F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], item.alias("item"))
    return rows.agg(_list(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["item"])).alias("json"))


def blocks(panel: DataFrame, *ids: str) -> DataFrame:
    """``key``, ``ids`` and ``data``: the measures by period as JSON; NULL for a key without rows."""
    measures = F.struct(*[F.col(column).alias(name) for name, column in MEASURE_KEYS.items() if column in panel.columns])
    entry = F.when(F.col("period").isNotNull(), F.struct("period", measures.alias("m")))
    by_key = panel.groupBy("key", *ids).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("periods"))
    return by_key.select("key", *ids, F.when(F.size("periods") > 0, as_json(F.col("periods"))).alias("data"))


def cohorts(panel: DataFrame, cfg: FunnelConfig) -> DataFrame:
    entry = F.struct("key", F.coalesce("data", F.lit("null")))
    found = blocks(panel).agg(F.map_from_entries(F.collect_list(entry)).alias("by"))
    parts = {name: F.col("by")[key] for name, key in COHORT_KEYS.items()}
    return found.select(json_object(parts | {"non_days": _text(F.lit(cfg.n_days))}).alias("json"))


def labelled(panel: DataFrame, keys: Sequence[str], show_label: bool) -> DataFrame:
    """The list of a panel's keys in the given order, each with its entities and its data."""
    ids = ["entities", *(["label"] if show_label else [])]
    label = {"label": _text(F.col("label"))} if show_label else {}
    item = json_object({"key": _text(F.col("key")), **label, "csps": _text(F.col("entities")), "data": F.col("data")})
    place = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("key"))
    return ordered_list(blocks(panel, *ids), [place], item)


def counts(panel: DataFrame) -> DataFrame:
    return panel.agg(as_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "entities"))))).alias("json"))


def keyed(rows: DataFrame, key: Column, value: Column) -> DataFrame:
    """One row: an object with the value (JSON) of each row under its key."""
    entry = F.struct(key.cast("string").alias("key"), value.alias("value"))
    fields = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.concat(_text(e["key"]), F.lit(":"), e["value"]))
    return rows.agg(F.concat(F.lit("{"), F.array_join(fields, ","), F.lit("}")).alias("json"))


def app_opens(rates: DataFrame, totals: DataFrame) -> DataFrame:
    """Opens per day by role and in all, by period; both periods are there."""
    roles = rates.groupBy("period").agg(F.sort_array(F.collect_list(F.struct(F.concat("rg", F.lit("_d")), "opens_d"))).alias("roles"))
    rows = totals.join(roles, "period", "left")
    every = F.array_append(F.coalesce("roles", F.array().cast(roles.schema["roles"].dataType)), F.struct(F.lit("total_d"), F.col("total_d")))
    return keyed(rows, F.col("period"), as_json(F.map_from_entries(every)))


def weather(panel: DataFrame, site: str | int | None = None) -> DataFrame:
    """Class by day, of one site where the panel has several."""
    if "site" in panel.columns:
        panel = panel.where(F.col("site") == F.lit(site))
    return keyed(panel, F.col("day"), _text(F.col("weather")))


def _combined(spark, parts: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row: the object of one-row frames; null for those that are missing."""
    values = {name: F.lit(None).cast("string") if df is None else df.select("json").scalar() for name, df in parts.items()}
    return spark.range(1).select(json_object(values).alias("json"))


class Parts:
    """Builds parts, each written once; one whose section fails is None, unless it must be there."""

    def __init__(self):
        self.failed: list[str] = []

    def __call__(self, name: str, build: Section, must: bool = False) -> DataFrame | None:
        try:
            return stage(build(), f"part_{name or 'main'}")
        except PySparkException:
            if must:
                raise
            self.failed.append(name)
            return None


def grain_parts(every: Mapping[str, Section], cfg: FunnelConfig, grain: str, scope: str) -> dict[str, Section]:
    def panel(name: str) -> DataFrame:
        return every[f"{grain}_{name}{scope}"]()

    actual = [k for k in CLASS_LABELS if k != "too_early"]
    return {
        "tab1": lambda: cohorts(panel("cohorts"), cfg),
        "tab2": lambda: labelled(panel("categories"), list(ANSWER_LABELS), True),
        "tab3_screens": lambda: labelled(panel("screens"), cfg.screens, False),
        "tab3_engagement": lambda: labelled(panel("engagement"), [label for label, _, _ in ENGAGEMENT_ROWS], False),
        "targeted": lambda: every["targeted"]().select(_text(F.col("targeted")).alias("json")),
        "tab_mg": lambda: labelled(panel("classes"), actual, True),
        "tab_mg_proj": lambda: labelled(panel("classes_projected"), list(CLASS_LABELS), True),
    }


def class_parts(every: Mapping[str, Section], scope: str) -> dict[str, Section]:
    return {
        "mg_counts": lambda: counts(every[f"class_counts{scope}"]()),
        "mgp_counts": lambda: counts(every[f"class_counts_projected{scope}"]()),
        "mg_proj_totals": lambda: every[f"projection{scope}"]().select(as_json(F.struct("bookings", "installs")).alias("json")),
    }


def days_parts(every: Mapping[str, Section], scope: str, site: str | int | None = None) -> dict[str, Section]:
    parts = {
        "daily": lambda: ordered_list(every[f"daily{scope}"](), [F.col("d")], as_json(F.struct(F.col("d").cast("string").alias("d"), "b", "i", "j"))),
        "from": lambda: every["summary"]().select(_text(F.col("date_from").cast("string")).alias("json")),
    }
    cell = as_json(F.struct(F.col("d").cast("string").alias("d"), "hr", "n"))
    for name, tag in HOUR_LISTS.items():
        parts[name] = lambda tag=tag: ordered_list(every[f"hourly{scope}"]().where(F.col("k") == tag), [F.col("d"), F.col("hr")], cell)
    if not scope and "weather" in every:
        parts["weather"] = lambda: weather(every["weather"](), site)
    return parts


def payload(every: Mapping[str, Section], cfg: FunnelConfig, site: str | int | None = None) -> DataFrame:
    """One row, ``json``: the whole document of ``document.sections``, and ``failed``: the parts that are null for that.

    The page shows the weather of one place: ``site`` names it where the series has several.
    """
    made = Parts()
    head = stage(every["summary"](), "part_summary")
    spark = head.sparkSession

    def of_head(value: Column) -> DataFrame:
        return head.select(_text(value).alias("json"))

    def part(name: str, inner: Mapping[str, Section], must: Sequence[str] = ()) -> dict[str, DataFrame | None]:
        return {key: made(f"{name}.{key}".lstrip("."), build, key in must) for key, build in inner.items()}

    out: dict[str, DataFrame | None] = {
        "generated": of_head(F.date_format("generated", GENERATED_FORMAT)),
        "yest": of_head(F.col("as_of").cast("string")),
        "launch": of_head(F.col("launch").cast("string")),
        "enrolled": of_head(F.col("enrolled")),
        "anchored": of_head(F.col("anchored")),
        "mg_gate": of_head(F.col("gate_percent")),
        "too_early_days": of_head(F.col("early_days")),
        "month_remaining": of_head(F.col("month_remaining")),
    }
    for name, (grain, scope) in GRAINS.items():
        inner = grain_parts(every, cfg, grain, scope) | (class_parts(every, scope) if scope or not name else {})
        found = part(name, inner, ("tab1",) if not name else ())
        if not name:
            out |= found
        else:  # a document within the document is null as a whole where its cohorts are
            out[name] = None if found["tab1"] is None else _combined(spark, found)
    if "non_enrolled" in every:
        out["non_csps"] = made("non_csps", lambda: every["non_enrolled"]().select(_text(F.col("entities")).alias("json")))
    out["tab3_view_action"] = made("tab3_view_action", lambda: every["view_to_action"]().select(as_json(F.struct("*")).alias("json")))
    out["app_opens"] = made("app_opens", lambda: app_opens(every["app_opens"](), every["app_opens_total"]()))
    for name, scope in (("tab4", ""), ("tab4_noGH", "_noflow")):
        found = part(name, days_parts(every, scope, site))
        out[name] = None if found["daily"] is None else _combined(spark, found)
    return _combined(spark, out).select("json", F.array(*[F.lit(f) for f in made.failed]).cast("array<string>").alias("failed"))
