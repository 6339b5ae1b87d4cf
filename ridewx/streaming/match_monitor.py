"""Match rate on a stream (E4): the share of trips of the last 24 hours that
found an observation, hour by hour, and whether it calls for an alert.

Trips are counted per hour first, a windowed aggregate that combines
map-side, so only one row per hour reaches the stateful operator, whatever
the number of trips. Its state is the last hours' counts. A timer at the end
of each hour (event time) sums the hours of the window, emits the rate and
forgets hours that no later window needs.

``transformWithState`` keeps its timers apart from its map, which Spark's
default state store cannot; ``state_conf`` has the setting to start with.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ridewx.functions.timecols import ntz_literal
from ridewx.streaming.enrich_stream import EVENT_TIME, wall_clock_instant

# Executors run the processor without having this library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
WINDOW_HOURS, THRESHOLD = 24, 0.9
HOUR_MS = 3_600_000
_COUNTS = T.StructType([T.StructField("trips", T.LongType()), T.StructField("matched", T.LongType())])
_OUT = T.StructType([T.StructField("monitor", T.StringType()), T.StructField("end_ms", T.LongType()),
                     T.StructField("trips", T.LongType()), T.StructField("matched", T.LongType()),
                     T.StructField("hours", T.LongType())])


class SlidingCounts(StatefulProcessor):
    """Per monitor: counts by hour end (ms), summed over ``hours`` of them
    whenever an hour's timer goes off."""

    def __init__(self, hours: int):
        self.width = hours * HOUR_MS

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", T.StructType([T.StructField("end_ms", T.LongType())]), _COUNTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            seen = self.counts.getValue((row.end_ms,)) if self.counts.containsKey((row.end_ms,)) else (0, 0)
            self.counts.updateValue((row.end_ms,), (seen[0] + row.trips, seen[1] + row.matched))
            self.handle.registerTimer(row.end_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        trips = matched = hours = 0
        old = []
        for (at,), (n, m) in self.counts.iterator():
            if end - self.width < at <= end:
                trips, matched, hours = trips + n, matched + m, hours + 1
            # The next timer is an hour on at the earliest.
            if at <= end + HOUR_MS - self.width:
                old.append(at)
        for at in old:
            self.counts.removeKey((at,))
        yield Row(monitor=key[0], end_ms=end, trips=trips, matched=matched, hours=hours)

    def close(self) -> None:
        pass


def state_conf(spark: SparkSession) -> dict:
    """What a match rate stream needs besides the session's settings: RocksDB
    where the session has Spark's default store (another one stays)."""
    package, _, name = spark.conf.get(PROVIDER).rpartition(".")
    if name != "HDFSBackedStateStoreProvider":
        return {}
    return {PROVIDER: f"{package}.RocksDBStateStoreProvider"}


def match_rate_stream(trips: DataFrame, matched: str | Column = "temperature_2m",
                      time_col: str = "tpep_pickup_datetime", delay: str = "1 hour", hours: int = WINDOW_HOURS,
                      threshold: float = THRESHOLD, monitor: Column | None = None) -> DataFrame:
    """window_end, trips, matched, hours, match_rate, alert of every hour
    with trips, over the ``hours`` that end with it (``hours`` of them with
    trips). A trip is matched where ``matched`` is not null. ``monitor``: a
    column to watch separately (its values are the stateful operator's keys,
    kept in the result); one monitor for all trips by default. Start it
    with ``state_conf``."""
    found = F.col(matched) if isinstance(matched, str) else matched
    name = F.lit("all") if monitor is None else monitor.cast("string")
    counts = (trips.withColumn(EVENT_TIME, wall_clock_instant(F.col(time_col))).withWatermark(EVENT_TIME, delay)
              .groupBy(F.window(EVENT_TIME, "1 hour").alias("hour"), name.alias("monitor"))
              .agg(F.count(F.lit(1)).alias("trips"), F.count(found).alias("matched"))
              .select("monitor", "hour", F.unix_millis(F.col("hour.end")).alias("end_ms"), "trips", "matched"))
    sums = counts.groupBy("monitor").transformWithState(
        statefulProcessor=SlidingCounts(hours), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    rate = F.try_divide("matched", "trips")
    return sums.select(
        *([] if monitor is None else ["monitor"]),
        F.timestamp_add("MILLISECOND", F.col("end_ms"), ntz_literal("1970-01-01 00:00:00")).alias("window_end"),
        "trips", "matched", "hours", rate.alias("match_rate"),
        (F.col("matched") < F.col("trips") * threshold).alias("alert"))
