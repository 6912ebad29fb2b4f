"""Hourly rain and cloud to one weather class per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import stage_depth
from ..operators.ordered import previous_value

# Lower limits of the classes, in the order they are tried.
STORM_MM, RAIN_MM, SHOWERS_MM, WET_NIGHT_MM, CLOUDY_PCT = 15, 2.5, 0.3, 1, 70


def daily_weather(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per day: rain and mean cloud of 09-18h, and the rain of the night before.

    The night is the previous *present* day's rain from 21h plus this day's rain up to 06h.
    The lag runs over day rows, which are already one per site and day.
    """
    daytime = "hour(ts) BETWEEN 9 AND 18"

    def rain(cond: str):
        return F.expr(f"sum(CASE WHEN {cond} THEN coalesce(precip, 0D) ELSE 0D END)")

    days = hourly.groupBy(*keys, F.to_date("ts").alias("day")).agg(
        rain(daytime).alias("day_rain"),
        rain("hour(ts) >= 21").alias("late_rain"),
        rain("hour(ts) <= 6").alias("early_rain"),
        F.expr(f"coalesce(avg(CASE WHEN {daytime} THEN coalesce(cloud, 0D) END), 0D)").alias("day_cloud"),
    )
    carried = previous_value(days, list(keys), "day", "late_rain", "prev_late", 0.0)
    night = "prev_late + early_rain"
    weather = stage_depth(
        [
            (f"day_rain >= {STORM_MM}", "storm"),
            (f"day_rain >= {RAIN_MM}", "rain"),
            (f"day_rain >= {SHOWERS_MM}D", "showers"),
            (f"{night} >= {WET_NIGHT_MM}", "wet_night"),
            (f"day_cloud >= {CLOUDY_PCT}", "cloudy"),
        ],
        "clear",
    )
    return carried.select(*keys, "day", "day_rain", F.expr(night).alias("night_rain"), "day_cloud", weather.alias("weather"))
