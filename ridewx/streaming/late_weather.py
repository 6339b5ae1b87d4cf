"""Streaming enrichment when observations also arrive as a stream.

Trips and observations are two streams, either of which may be behind. The
observations of an hour are reduced to the earliest (the one-per-hour guard
as a streaming aggregate), and trips are joined to them on the hour, a left
outer join with both sides in state. A trip that comes before its
observation waits for it; it is emitted without weather only when the
watermark has passed its hour, so no observation can still come.

The watermark follows the slower of the two streams, each allowed ``delay``
of disorder, so it never passes hours whose observations are merely late as
a whole. A restarted query keeps the watermark it had, and moves it on once
both streams have delivered rows again. State holds the trips and observations of open hours only. Rows
behind the watermark are dropped and counted (``run_available``).

An hour's trips are one key of the join: in a micro-batch they meet in one
task, as in every equi-join on the hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewx.operators.observations import earliest_per_group, type_observations
from ridewx.schemas import HOURLY_VARIABLES, WEATHER_JOIN_COLUMNS
from ridewx.streaming.enrich_stream import EVENT_TIME, wall_clock_instant

DELAY = "1 hour"


def hour_stream(observations: DataFrame, delay: str = DELAY) -> DataFrame:
    """The earliest observation of every hour, typed, with the hour's
    ``window``; emitted once the watermark has passed the hour. Staged rows
    in either shape; rows without a time belong to no hour."""
    rows = (observations.select("datetime", *HOURLY_VARIABLES).filter(F.col("datetime").isNotNull())
            .withColumn(EVENT_TIME, wall_clock_instant(F.col("datetime"))).withWatermark(EVENT_TIME, delay))
    hours = earliest_per_group(rows, [F.window(EVENT_TIME, "1 hour")], "datetime")
    return type_observations(hours, keep=("window",)).select("window", *WEATHER_JOIN_COLUMNS)


def enrich_late(trips: DataFrame, observations: DataFrame, time_col: str = "tpep_pickup_datetime",
                delay: str = DELAY) -> DataFrame:
    """Trips (a stream) left-joined to the observations (a stream) of their
    pickup hour: the silver columns."""
    keyed = (trips.withColumn(EVENT_TIME, wall_clock_instant(F.col(time_col))).withWatermark(EVENT_TIME, delay)
             .withColumn("window", F.window(EVENT_TIME, "1 hour")))
    joined = keyed.join(hour_stream(observations, delay), "window", "left")
    return joined.select(*trips.columns, *WEATHER_JOIN_COLUMNS, F.to_date(time_col).alias("pickup_date"),
                         F.hour(time_col).alias("pickup_hour"))
