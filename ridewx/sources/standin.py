"""Trips and hourly observations derived from the driver's ``events`` table.

The test data has no trips or weather, so both are derived from events:
``error`` events play the observations and all other events the trips.
Some hours therefore have no observation, some hours have several, and
some fares are negative, which exercises the join, the uniqueness guard
and the expectations on real data that grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewx.functions.classify import (
    WEATHER_CODE_CLASSES,
    WEATHER_CODE_CLASSES_COARSE,
    classify_code_coarse,
)
from ridewx.functions.timecols import wall_clock
from ridewx.schemas import HOURLY_VARIABLES
from ridewx.session import source_path

OBSERVATION_EVENT = "error"

# Codes whose observation carries rain or snow in the stand-in: the
# rain-like and snow-like classes of the detailed code table.
_RAIN_CLASSES = ("Drizzle", "Rain", "Rain Showers")
_SNOW_CLASSES = ("Snow", "Snow Showers")
RAIN_CODES = sorted(c for n, cs in WEATHER_CODE_CLASSES if n in _RAIN_CLASSES for c in cs)
SNOW_CODES = sorted(c for n, cs in WEATHER_CODE_CLASSES if n in _SNOW_CLASSES for c in cs)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(source_path(sf_dir, "events"))


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def weather_raw(events: DataFrame, *keep: str) -> DataFrame:
    """Staged observations (the load step's 8-column shape), one per
    ``error`` event; an hour can hold several. ``keep`` names event columns
    to carry along."""
    c, k = F.col("c"), F.col("k")
    rain = F.when(k.isin(*RAIN_CODES), c / 100.0).otherwise(F.lit(0.0))
    snow = F.when(k.isin(*SNOW_CODES), c / 100.0).otherwise(F.lit(0.0))
    return (
        events.filter(F.col("event_type") == OBSERVATION_EVENT)
        .select(F.col("ts").alias("datetime"), _cents().alias("c"), _k().alias("k"), *keep)
        .select(
            *keep,
            "datetime",
            ((c - 3000) / 100.0).alias("temperature_2m"),
            k.cast("double").alias("relative_humidity_2m"),
            (rain + snow).alias("precipitation"),
            rain.alias("rain"),
            snow.alias("snowfall"),
            (c / 1000.0).alias("wind_speed_10m"),
            k.alias("weather_code"),
        )
    )


def weather_staged(events: DataFrame) -> DataFrame:
    """Observations staged with derived columns (the command's 13-column
    shape) by a careless loader: the rain flag is taken from precipitation,
    so snow counts as rain, and codes outside the coarse table have no
    category. The row checks on staged data find both."""
    known = [c for _, codes in WEATHER_CODE_CLASSES_COARSE for c in codes]
    return weather_raw(events).withColumns({
        "date": F.to_date("datetime"), "hour": F.hour("datetime"),
        "is_raining": F.col("precipitation") > 0, "is_snowing": F.col("snowfall") > 0,
        "weather_category": F.when(F.col("weather_code").isin(*known), classify_code_coarse("weather_code"))})


def response_documents(events: DataFrame) -> DataFrame:
    """Observations as landed response documents (JSON text), one per day
    and station (the event's user), at full time precision: every staged
    row is in one document, and a document is bounded by one station's day.
    """
    time = F.replace(F.col("datetime").cast("string"), F.lit(" "), F.lit("T")).alias("time")
    items = (weather_raw(events, "user_id")
             .groupBy(F.to_date("datetime").alias("day"), "user_id")
             .agg(F.array_sort(F.collect_list(F.struct(time, *HOURLY_VARIABLES))).alias("items")))

    def part(name: str) -> Column:
        return F.transform("items", lambda x: x[name]).alias(name)

    doc = F.struct(F.lit(0.0).alias("latitude"), F.col("user_id").cast("double").alias("longitude"),
                   F.struct(*[part(v) for v in ["time", *HOURLY_VARIABLES]]).alias("hourly"))
    return items.select("day", F.to_json(doc).alias("body"))


def broken_documents(events: DataFrame, every: int = 7) -> DataFrame:
    """``response_documents`` of which every so many stations' are broken in
    one of three ways: no hourly data, no times, one array emptied."""
    docs = response_documents(events)
    station = F.get_json_object("body", "$.longitude").cast("double").cast("bigint") % every
    emptied = F.regexp_replace("body", r'"rain":\[[^]]*]', '"rain":[]')
    return docs.select("day", F.when(station == 0, F.lit('{"invalid": "response"}'))
                       .when(station == 1, F.replace("body", F.lit('"time":'), F.lit('"times":')))
                       .when(station == 2, emptied).otherwise(F.col("body")).alias("body"))


def local_documents(observations: DataFrame, zone: str) -> DataFrame:
    """One document per local day with every hour that passed on it, 23 to
    25 of them, as local times without offset in order of time; readings are
    NULL where an hour has no observation. ``observations`` have
    ``hour_instant`` and the variables, one row per hour."""
    shown = wall_clock(F.col("hour_instant"), zone)
    days = observations.select(F.to_date(shown).alias("day")).distinct()
    midnight = F.to_utc_timestamp(F.concat(F.col("day").cast("string"), F.lit(" 00:00:00Z")).cast("timestamp"), zone)
    grid = days.select("day", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("h"), midnight.alias("m")).select(
        "day", F.timestamp_add("HOUR", "h", "m").alias("hour_instant"))
    grid = grid.withColumn("shown", shown).filter(F.to_date("shown") == F.col("day"))
    rows = grid.join(observations.select("hour_instant", *HOURLY_VARIABLES), "hour_instant", "left")
    time = F.replace(F.substring(F.col("shown").cast("string"), 1, 16), F.lit(" "), F.lit("T")).alias("time")
    items = rows.groupBy("day").agg(F.array_sort(F.collect_list(
        F.struct("hour_instant", time, *HOURLY_VARIABLES))).alias("items"))
    part = lambda name: F.transform("items", lambda x: x[name]).alias(name)
    hourly = F.struct(*[part(v) for v in ["time", *HOURLY_VARIABLES]]).alias("hourly")
    return items.select("day", F.to_json(F.struct(hourly), {"ignoreNullFields": "false"}).alias("body"))


def trips(events: DataFrame) -> DataFrame:
    """Trip rows from every non-observation event.

    Dropoff is ``k`` minutes after pickup (``k = 0`` breaks pickup <
    dropoff on purpose) and fares below 5.00 come out negative.
    """
    c, k = F.col("c"), F.col("k")
    return (
        events.filter(F.col("event_type") != OBSERVATION_EVENT)
        .select("ts", "user_id", _cents().alias("c"), _k().alias("k"))
        .select(
            F.col("ts").alias("tpep_pickup_datetime"),
            F.timestamp_add("MINUTE", k, F.col("ts")).alias("tpep_dropoff_datetime"),
            (F.col("user_id") + 10000).cast("string").alias("pickup_zip"),
            (k + 10000).cast("string").alias("dropoff_zip"),
            (k / 10.0).alias("trip_distance"),
            ((c - 500) / 100.0).alias("fare_amount"),
        )
    )


def load(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(trips, weather_raw) for a scale-factor folder."""
    events = read_events(spark, sf_dir)
    return trips(events), weather_raw(events)
