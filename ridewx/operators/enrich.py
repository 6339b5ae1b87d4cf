"""Joining events to observations by hour or by day.

The observation side is one row per hour (or day), so it is tiny next to
the events. It is broadcast only after a size check: the table is written
to the checkpoint folder, its rows and bytes read back, and a broadcast hint
is given when they are within ``max_broadcast_rows`` and
``MAX_BROADCAST_BYTES``; above it the join falls back to a shuffle join,
where AQE splits a skewed hour.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewx.operators.quality import (
    SILVER_EXPECTATIONS,
    TRIP_EXPECTATIONS,
    Checked,
    apply_expectations,
)
from ridewx.schemas import WEATHER_JOIN_COLUMNS
from ridewx.session import materialize_counted

# An hour row is under 100 bytes: one million rows (114 years of hours)
# stay under ~100 MB per executor.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
# The columns are the caller's choice, so bytes are bounded too.
MAX_BROADCAST_BYTES = 512 << 20


@dataclass
class SizedSide:
    df: DataFrame
    rows: int
    broadcast: bool


def size_checked(small: DataFrame, label: str,
                 max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> SizedSide:
    """Materialize ``small`` in the checkpoint folder and decide broadcast.

    Nothing is kept between calls, so a changed source is seen by the next
    join. A caller with several joins over one hour table writes it once
    and passes the written table. ``max_broadcast_rows=None`` runs nothing
    and leaves the join to the planner, which knows sizes at run time.
    """
    if max_broadcast_rows is None:
        return SizedSide(small, -1, False)
    table, rows, size = materialize_counted(small, label)
    if rows <= max_broadcast_rows and size <= MAX_BROADCAST_BYTES:
        return SizedSide(F.broadcast(table), rows, True)
    return SizedSide(table, rows, False)


def with_hour_keys(trips: DataFrame, time_col: str = "tpep_pickup_datetime") -> DataFrame:
    return trips.withColumns({
        "pickup_date": F.to_date(F.col(time_col)),
        "pickup_hour": F.hour(F.col(time_col)),
    })


def hour_side(hours: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Observation keys renamed so they cannot clash with trip columns."""
    cols = columns or WEATHER_JOIN_COLUMNS
    return hours.select(F.col("date").alias("weather_date"),
                        F.col("hour").alias("weather_hour"), *cols)


def _hour_match(left: DataFrame, right: DataFrame) -> Column:
    return ((left["pickup_date"] == right["weather_date"])
            & (left["pickup_hour"] == right["weather_hour"]))


def join_hours(trips: DataFrame, hours: DataFrame, how: str = "left",
               time_col: str = "tpep_pickup_datetime",
               columns: list[str] | None = None,
               max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Trips joined to the observation of their pickup hour.

    ``hours`` must be unique on (date, hour) (see ``unique_hours``), or
    trips would be multiplied. ``how`` is any join type; ``left_semi`` and
    ``left_anti`` give matched and unmatched trips.
    """
    keyed = with_hour_keys(trips, time_col)
    side = size_checked(hour_side(hours, columns), "hours", max_broadcast_rows).df
    joined = keyed.join(side, _hour_match(keyed, side), how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined
    return joined.drop("weather_date", "weather_hour")


def merge_hours(trips: DataFrame, hours: DataFrame, columns: list[str],
                time_col: str = "tpep_pickup_datetime",
                max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join as the exploration writes it: the named columns of the
    hour's observation and its ``date`` and ``hour``, NULL without one.
    ``trips`` must have no columns of these names."""
    keyed = with_hour_keys(trips, time_col)
    side = size_checked(hours.select("date", "hour", *columns), "hours", max_broadcast_rows).df
    return keyed.join(side, (keyed["pickup_date"] == side["date"]) & (keyed["pickup_hour"] == side["hour"]), "left")


def check_trips(trips: DataFrame) -> Checked:
    """Trip expectations: fail on a missing pickup time, drop negative fares."""
    return apply_expectations(trips, TRIP_EXPECTATIONS, "trips")


def enrich_hourly(trips: DataFrame, hours: DataFrame,
                  time_col: str = "tpep_pickup_datetime",
                  max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
                  observe: bool = True, stop: bool = True) -> tuple[DataFrame, list[Checked]]:
    """The silver layer: trips left-joined to their hour, with the layer's
    expectations applied to the joined rows in one step (fail on a missing
    pickup time, then one set of counters, then drop negative fares), so
    every counter sees the same rows, as for any declared dataset.

    ``observe=False`` keeps the fail and drop checks but no warn counters;
    ``stop=False`` counts the fail check instead of raising, for a staged
    write. Unless ``max_broadcast_rows`` is None, the hour table is written
    and counted while this is called.
    Trip columns keep their types (TIMESTAMP or TIMESTAMP_NTZ times, zips of
    any type). Returns the 18-column table and the checks, whose counters
    fill after the first action.
    """
    joined = join_hours(trips, hours, "left", time_col, max_broadcast_rows=max_broadcast_rows)
    out = joined.select(*trips.columns, *WEATHER_JOIN_COLUMNS, "pickup_date", "pickup_hour")
    expectations = TRIP_EXPECTATIONS + (SILVER_EXPECTATIONS if observe else [])
    checked = apply_expectations(out, expectations, "taxi_weather_joined", stop)
    return checked.df, [checked]


def enrich_daily(trips: DataFrame, days: DataFrame, how: str = "inner",
                 time_col: str = "tpep_pickup_datetime",
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Trips joined to a one-row-per-day observation table on pickup date."""
    keyed = trips.withColumn("pickup_date", F.to_date(F.col(time_col)))
    side = size_checked(days, "days", max_broadcast_rows).df
    joined = keyed.join(side, keyed["pickup_date"] == side["weather_date"], how)
    return joined.drop("weather_date")
