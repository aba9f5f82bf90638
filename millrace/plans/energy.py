"""Energy study: readings, buildings and weather to a prepared table and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import week_of_month, weekday_name
from millrace.operators.cleaning import exact_mean, fill_constant, fill_mean
from millrace.operators.lookups import with_dimension
from millrace.operators.ordered import HOT_ROWS, lags, with_group_stats
from millrace.session import written

CATEGORIES = ["quarter", "day_of_week", "primary_use", "meter"]
NUMBERS = [
    "wind_speed", "wind_direction", "sea_level_pressure", "air_temperature", "dew_temperature",
    "square_feet", "hour", "prev1week_meter_reading", "prev2week_meter_reading",
]
HOURLY_MEANS = ["air_temperature", "dew_temperature"]
WEEKLY_MEANS = ["sea_level_pressure", "wind_direction", "wind_speed"]
LAG_KEY = ["building_id", "meter", "day_of_week", "hour"]


def dated(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(
        {
            "quarter": F.quarter(ts),
            "day_of_week": weekday_name(ts),
            "hour": F.hour(ts),
            "week": week_of_month(ts),
        }
    )


def fill_weather(df: DataFrame) -> DataFrame:
    """Temperatures by (site, week, hour) mean, the rest by (site, week) mean."""
    stats = [exact_mean(c).alias(f"__m_{c}") for c in HOURLY_MEANS]
    hourly = with_group_stats(df, ["site_id", "week", "hour"], *stats)
    weekly = with_group_stats(
        hourly, ["site_id", "week"], *[exact_mean(c).alias(f"__m_{c}") for c in WEEKLY_MEANS]
    )
    measures = [*HOURLY_MEANS, *WEEKLY_MEANS]
    return weekly.withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in measures}).drop(
        *[f"__m_{c}" for c in measures]
    )


def prepare(
    readings: DataFrame,
    buildings: DataFrame,
    weather: DataFrame,
    lag_key: Sequence[str] = LAG_KEY,
    lag_order: Sequence[str] = ("timestamp",),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Cleaned table with the readings one and two weeks earlier; rows must have all three.

    Weather measures missing for a whole group take the mean of the table. The default ``lag_key`` keeps buildings and meters apart. ``["day_of_week", "hour"]`` with
    the order ``["building_id", "meter", "timestamp"]`` gives the form where a neighbour's
    reading can stand in at a border. Filtering before the lag would change it, so it is last.
    """
    # Each table that is read more than once is worked out once.
    sky = written(fill_weather(written(dated(weather), "weather")), "sky")
    sky = fill_mean(sky, [*HOURLY_MEANS, *WEEKLY_MEANS])
    facts = with_dimension(readings, buildings, "building_id")
    joined = with_dimension(facts, sky, ["timestamp", "site_id"])
    names = {1: "prev1week_meter_reading", 2: "prev2week_meter_reading"}
    # Joins to dimensions add no rows, so the readings alone bound the size of lag groups.
    lagged = lags(joined, lag_key, lag_order, "meter_reading", names, hot_rows, dated(readings))
    return fill_constant(lagged, {n: 0.0 for n in names.values()}).where(
        "meter_reading > 0 and prev2week_meter_reading > 0 and prev1week_meter_reading > 0"
    )


def prepare_calendar(
    readings: DataFrame, key: Sequence[str] = ("building_id", "meter"), weeks: Sequence[int] = (1, 2)
) -> DataFrame:
    """Earlier readings by the calendar: exactly 7 and 14 days before, by equi-join."""
    out = readings
    for k in weeks:
        earlier = readings.select(
            *key,
            (F.col("timestamp") + F.expr(f"interval {7 * k} days")).alias("timestamp"),
            F.col("meter_reading").alias(f"prev{k}week_meter_reading"),
        )
        out = out.join(earlier, [*key, "timestamp"], "left")
    return out
