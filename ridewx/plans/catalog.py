"""The query catalog: one function per operator, each ``(spark, sf_dir)``.

Every query reads the driver's tables (through the events stand-in) over
their whole extent; nothing is sampled or capped except where the cap is
the feature (``sample_trips``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ridewx.functions.classify import (
    LIBRARY_NULL_LABEL,
    WEATHER_CODE_CLASSES,
    classify_code,
    classify_code_coarse,
    condition_recode,
    temperature_band,
)
from ridewx.functions.timecols import between_inclusive
from ridewx.operators import changes, instants, metrics, stats
from ridewx.operators.sampling import first_rows_by_time
from ridewx.operators.enrich import check_trips, enrich_daily, enrich_hourly, join_hours, merge_hours
from ridewx.operators.observations import (
    bronze_weather,
    daily_weather,
    guard_report,
    hours_of,
    rename_to_units,
    type_observations,
    unique_raw_hours,
)
from ridewx.operators.quality import (
    BRONZE_EXPECTATIONS,
    FAIL,
    SILVER_EXPECTATIONS,
    TRIP_EXPECTATIONS,
    TRIP_ROW_CHECKS,
    WEATHER_ROW_CHECKS,
    apply_expectations,
    expect_or_drop,
    match_rate,
    quarantine,
    quarantine_report,
    quality_report,
    quality_reports,
)
from ridewx.plans import medallion
from ridewx.schemas import TRIP_SCHEMA, WEATHER_HOURLY_SCHEMA, WEATHER_RAW_SCHEMA
from ridewx.sources import responses, standin
from ridewx.sources.sinks import write_clustered, write_table
from ridewx.sources.tables import read_fixture, read_table, rows_to_frame, use_namespace
from ridewx.session import scratch_path, source_path
from ridewx.streaming.enrich_stream import (
    check_trip_stream,
    enrich_stream,
    hourly_stream_metrics,
    read_file_stream,
    run_available,
    stream_trips,
    wall_clock_instant,
)
from ridewx.streaming.late_weather import enrich_late
from ridewx.streaming.match_monitor import match_rate_stream, state_conf

# Parameters of the catalog queries.
SAMPLE_FROM, SAMPLE_TO, SAMPLE_ROWS = "2024-01-01", "2024-01-30", 10_000
WINDOW_DAYS = 7
PREVIEW_ROWS = 5
REFRESH_FROM, REFRESH_TO = "2024-01-10", "2024-01-12"
# Micro-batches of the replayed late stream: trips of these days of the
# month, each followed one batch later by its observations.
LATE_DAYS = [(1, 10), (11, 20), (21, 31)]
# A zone and a shift of the events that brings a clock change (2024-11-03) among them.
CLOCK_ZONE, CLOCK_SHIFT_DAYS = "America/New_York", 295
# The exploration's columns.
EXPLORATION_COLUMNS = ["temperature_c", "precipitation_mm", "weather_category"]
SAMPLE_COLUMNS = ["pickup_datetime", "dropoff_datetime", "pickup_zip", "dropoff_zip",
                  "trip_distance", "fare_amount"]


class Inputs:
    """Lazily derived inputs for one scale-factor folder. Nothing is kept
    between queries: each sees the files as they are."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = standin.read_events(spark, sf_dir)
        self.trips = standin.trips(self.events)
        self.weather_raw = standin.weather_raw(self.events)
        self._weather: DataFrame | None = None
        self._hours: DataFrame | None = None

    def weather(self) -> DataFrame:
        """Typed observations (bronze without counters)."""
        if self._weather is None:
            self._weather = type_observations(self.weather_raw)
        return self._weather

    def hours(self) -> DataFrame:
        """One typed observation per hour. The guard runs on the staged
        rows, whose columns are fixed-width, so it hash-aggregates; typing
        after it gives the same rows as typing first."""
        if self._hours is None:
            self._hours = hours_of(self.weather_raw)
        return self._hours

    def silver(self) -> DataFrame:
        """The silver rows, lazily, so that each query reads only the
        columns it needs; no copy of the trips is written."""
        return enrich_hourly(self.trips, self.hours(), observe=False)[0]

    def checked_trips(self) -> DataFrame:
        return check_trips(self.trips).df


def _q(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# --- sources -------------------------------------------------------------

def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read a table by name or path."""
    return read_table(spark, source_path(sf_dir, "events"))


def sample_trips(i: Inputs) -> DataFrame:
    """Trips with pickup BETWEEN two dates, first rows by time."""
    t = i.trips.select(
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        "pickup_zip", "dropoff_zip", "trip_distance", "fare_amount")
    in_range = t.filter(between_inclusive("pickup_datetime", SAMPLE_FROM, SAMPLE_TO))
    return first_rows_by_time(in_range, "pickup_datetime", SAMPLE_ROWS, SAMPLE_COLUMNS)


def ingest_hourly(i: Inputs) -> DataFrame:
    """Hourly response documents (JSON text) → typed rows."""
    docs = standin.response_documents(i.events)
    return responses.with_time_parts(responses.parse_response_text(docs, "body"))


def preview_trips(i: Inputs) -> DataFrame:
    """A repeatable preview, the first trips by pickup time."""
    order = list(TRIP_SCHEMA.names)
    return first_rows_by_time(i.trips, "tpep_pickup_datetime", PREVIEW_ROWS, order)


def _trip_bounds(i: Inputs) -> DataFrame:
    return i.trips.agg(F.to_date(F.min("tpep_pickup_datetime")).alias("start_date"),
                       F.to_date(F.max("tpep_pickup_datetime")).alias("end_date"))


def plan_windows(i: Inputs) -> DataFrame:
    """Request windows covering the trips' date span."""
    return responses.plan_windows(_trip_bounds(i), WINDOW_DAYS)


def union_chunks(i: Inputs) -> DataFrame:
    """Observations staged in two shapes (each month's first half by
    the notebook, 8 columns; the rest by the command, 13 columns), unioned
    by name and typed again; bronze recomputes the derived columns."""
    first_half = F.dayofmonth("datetime") <= 15
    notebook_shape = i.weather_raw.filter(first_half)
    command_shape = (i.weather_raw.filter(~first_half)
                     .withColumns({"date": F.to_date("datetime"), "hour": F.hour("datetime"),
                                   "is_raining": F.col("rain") > 0,
                                   "is_snowing": F.col("snowfall") > 0,
                                   "weather_category": classify_code("weather_code")}))
    return type_observations(responses.union_chunks([notebook_shape, command_shape]))


def csv_read_back(i: Inputs) -> DataFrame:
    """Trips written as CSV with a header, read back as text and
    typed again."""
    path = scratch_path(i.spark, "trips") + ".csv"
    text = i.trips.select(*[F.col(c).cast("string") for c in TRIP_SCHEMA.names])
    write_table(text, path, fmt="csv", header="true")
    return read_fixture(i.spark, path).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in TRIP_SCHEMA.fields])


def json_read_back(i: Inputs) -> DataFrame:
    """Staged observations written as JSON lines with times as
    text, read back by schema and typed."""
    path = scratch_path(i.spark, "weather") + ".json"
    write_table(i.weather_raw.withColumn("datetime", F.col("datetime").cast("string")), path, fmt="json")
    schema = StructType([StructField(f.name, StringType() if f.name == "datetime" else f.dataType)
                         for f in WEATHER_RAW_SCHEMA.fields])
    return type_observations(read_fixture(i.spark, path, schema, lines=True))


def clustered_read_back(i: Inputs) -> DataFrame:
    """Typed observations with a time, written clustered by date and
    read back."""
    path = scratch_path(i.spark, "clustered")
    write_clustered(i.weather(), path, "date", "datetime")
    return read_table(i.spark, path).select(*WEATHER_HOURLY_SCHEMA.names)


def refresh_silver(i: Inputs) -> DataFrame:
    """All layers written from trips whose fares were still wrong
    on some dates; these dates are refreshed and silver is read back."""
    return _refreshed(i)["taxi_weather_joined"]


def stream_ingest(i: Inputs) -> DataFrame:
    """Response documents read as a stream while they land, in two
    runs of one query; the second takes up only what is new."""
    docs, out = scratch_path(i.spark, "landing"), scratch_path(i.spark, "ingested")
    checkpoint = scratch_path(i.spark, "ingest-chk")
    landed = standin.response_documents(i.events)
    for part in (F.dayofmonth("day") <= 15, F.dayofmonth("day") > 15):
        landed.filter(part).select("body").write.mode("append").text(docs)
        run_available(responses.stream_responses(i.spark, docs), out, checkpoint)
    return responses.with_time_parts(i.spark.read.parquet(out))


def missing_windows(i: Inputs) -> DataFrame:
    """Planned windows of which some days have not landed: here the last
    week of every month."""
    rows = i.weather_raw.filter(F.dayofmonth("datetime") < 22)
    missing = responses.missing_windows(responses.plan_windows(_trip_bounds(i), WINDOW_DAYS), rows)
    return missing.withColumn("missing_days", F.array_join(F.col("missing_days").cast("array<string>"), ","))


def _refreshed(i: Inputs) -> medallion.Layers:
    """Layers written from trips whose fares were still wrong on some dates,
    after these dates' refresh."""
    root = scratch_path(i.spark, "layers")
    late = F.to_date("tpep_pickup_datetime").between(
        F.lit(REFRESH_FROM).cast("date"), F.lit(REFRESH_TO).cast("date"))
    early = i.trips.withColumn("fare_amount", F.when(late, F.col("fare_amount") + 1).otherwise(F.col("fare_amount")))
    medallion.write_all(early, i.weather_raw, root)
    return medallion.refresh(i.trips, i.weather_raw, root, REFRESH_FROM, REFRESH_TO)


def refresh_gold(i: Inputs) -> DataFrame:
    """The summary after a refresh of three dates, finished from the
    state that only these dates' silver was read for."""
    return _refreshed(i)["weather_impact_summary"]


def refresh_gold_bands(i: Inputs) -> DataFrame:
    """The temperature bands after the same refresh."""
    return _refreshed(i)["temperature_band_analysis"]


def _old_load(i: Inputs) -> DataFrame:
    """The hours of an earlier load: a night not there yet, a morning still
    too warm, an evening since withdrawn."""
    hours = unique_raw_hours(i.weather_raw).withColumns({"date": F.to_date("datetime"), "hour": F.hour("datetime")})
    day, hour = F.dayofmonth("datetime"), F.col("hour")
    warm = F.when((day == 12) & (hour < 12), F.col("temperature_2m") + 1).otherwise(F.col("temperature_2m"))
    return hours.filter(~((day == 11) & (hour < 6))).withColumn("temperature_2m", warm)


def _new_load(i: Inputs) -> DataFrame:
    hours = unique_raw_hours(i.weather_raw).withColumns({"date": F.to_date("datetime"), "hour": F.hour("datetime")})
    return hours.filter(~((F.dayofmonth("datetime") == 13) & (F.col("hour") >= 18)))


def weather_changes(i: Inputs) -> DataFrame:
    """The hours inserted, updated and deleted between two loads."""
    return changes.change_feed(_old_load(i), _new_load(i), ["date", "hour"]).select(
        "date", "hour", "kind", F.array_join("changed", ",").alias("changed"))


def refresh_changed(i: Inputs) -> DataFrame:
    """Layers of the old load, brought up to the new one by a refresh
    of the dates that changed; silver is read back."""
    root = scratch_path(i.spark, "layers")
    old, new = _old_load(i), _new_load(i)
    medallion.write_all(i.trips, old.select(*WEATHER_RAW_SCHEMA.names), root)
    return medallion.refresh_changed(i.trips, old, new, root)[medallion.SILVER]


def qualified_read(i: Inputs) -> DataFrame:
    """Trips saved as a table and read by its catalog-qualified name."""
    name = _trip_table(i)
    return read_table(i.spark, f"spark_catalog.{name}")


def namespace_read(i: Inputs) -> DataFrame:
    """The same by a bare name in the current schema, which is then set
    back."""
    database, name = _trip_table(i).split(".")
    before = i.spark.catalog.currentDatabase()
    use_namespace(i.spark, "spark_catalog", database)
    try:
        return read_table(i.spark, name)
    finally:
        use_namespace(i.spark, "spark_catalog", before)


def table_handle(i: Inputs) -> DataFrame:
    """A lazy handle on a table, with a filter and columns put on it."""
    return (read_table(i.spark, _trip_table(i)).filter(F.col("fare_amount") >= 0)
            .select("tpep_pickup_datetime", "fare_amount"))


def _trip_table(i: Inputs) -> str:
    database = "ridewx_" + scratch_path(i.spark, "t").rsplit("-", 1)[1]
    i.spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(i.spark, 'database')}'")
    write_table(i.trips, f"{database}.trips")
    return f"{database}.trips"


def code_lookup(i: Inputs) -> DataFrame:
    """The code classes as local rows, joined to every event; the table
    has one row per code."""
    rows = [{"code": c, "label": label} for label, codes in WEATHER_CODE_CLASSES for c in codes]
    schema = StructType([StructField("code", IntegerType()), StructField("label", StringType())])
    labels = F.broadcast(rows_to_frame(i.spark, rows, schema))
    k = F.get_json_object("props", "$.k").try_cast("int")
    coded = i.events.select("event_id", k.alias("weather_code"))
    return coded.join(labels, F.col("weather_code") == F.col("code"), "left").select("event_id", "weather_code", "label")


def rejected_documents(i: Inputs) -> DataFrame:
    """Response documents that cannot be parsed, by reason."""
    return responses.rejected_report(standin.broken_documents(i.events))


# --- projections and classification --------------------------------------

def unit_names(i: Inputs) -> DataFrame:
    """Observations with their measures under unit names."""
    return rename_to_units(i.weather())



def bronze_weather_q(i: Inputs) -> DataFrame:
    """Typed hourly observations with bronze expectations."""
    return bronze_weather(i.weather_raw).df


def classify_code_q(i: Inputs) -> DataFrame:
    """Detailed code classes (library form: NULL → Unknown)."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return i.events.select("event_id", k.alias("weather_code")).select(
        "event_id", "weather_code",
        classify_code("weather_code", null_label=LIBRARY_NULL_LABEL).alias("weather_category"))


def classify_code_coarse_q(i: Inputs) -> DataFrame:
    """Coarse code classes."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    return i.events.select("event_id", k.alias("weather_code")).select(
        "event_id", "weather_code",
        classify_code_coarse("weather_code").alias("weather_category"))


def temperature_bands(i: Inputs) -> DataFrame:
    """Band of every observation."""
    return i.weather().select("datetime", "temperature_2m",
                              temperature_band("temperature_2m").alias("temperature_band"))


def condition_recode_q(i: Inputs) -> DataFrame:
    """P10: plotting condition of every enriched trip."""
    return i.silver().select("tpep_pickup_datetime", "weather_category", "is_raining",
                             "is_snowing", condition_recode().alias("weather_condition"))


# --- expectations ---------------------------------------------------------

def expect_warn_report(i: Inputs) -> DataFrame:
    """Violations per expectation and dataset. The silver rows
    are counted as its declared checks see them: joined, before the drop.
    The left join keeps every trip once, so one pass counts both."""
    joined = join_hours(i.trips, i.hours(), "left")
    return (quality_report(i.weather(), BRONZE_EXPECTATIONS + WEATHER_ROW_CHECKS, "weather_hourly")
            .unionByName(quality_reports(joined, {
                "trips": TRIP_ROW_CHECKS,
                "taxi_weather_joined": TRIP_EXPECTATIONS + SILVER_EXPECTATIONS})))


def staged_checks(i: Inputs) -> DataFrame:
    """The row checks on staged rows, whose flag and category came
    with them and can therefore be wrong."""
    return quality_report(standin.weather_staged(i.events), WEATHER_ROW_CHECKS, "weather_raw")


def guard_report_q(i: Inputs) -> DataFrame:
    """What the one-per-hour guard keeps and drops."""
    return guard_report(i.weather_raw)


def expect_drop(i: Inputs) -> DataFrame:
    """Trips left after the drop expectation."""
    return i.checked_trips()


def expect_fail_pass(i: Inputs) -> DataFrame:
    """The fail expectation passes over the whole table."""
    fails = [e for e in TRIP_EXPECTATIONS if e.action == FAIL]
    return apply_expectations(i.trips, fails, "trips_fail").df


QUARANTINE_CHECKS = TRIP_EXPECTATIONS + [
    expect_or_drop("pickup_before_dropoff", "tpep_pickup_datetime < tpep_dropoff_datetime"),
    expect_or_drop("fare_not_over_100", "fare_amount <= 100"),
]


def quarantine_counts(i: Inputs) -> DataFrame:
    """Trips split into good and rejected rows, each rejected row with
    all its reasons, written and read back, counted."""
    good, rejected, _ = quarantine(i.trips, QUARANTINE_CHECKS, scratch_path(i.spark, "quarantine"), "trips")
    return quarantine_report(good, rejected)


def quarantined_trips(i: Inputs) -> DataFrame:
    """The rejected trips with their reasons."""
    _, rejected, _ = quarantine(i.trips, QUARANTINE_CHECKS, scratch_path(i.spark, "quarantine"), "trips")
    return rejected.withColumn("violations", F.array_join("violations", ","))


def match_rate_q(i: Inputs) -> DataFrame:
    """Share of trips that found an observation, 90 % check."""
    return match_rate(i.silver())


# --- joins ----------------------------------------------------------------

def unique_hours_q(i: Inputs) -> DataFrame:
    """Guard: one observation per (date, hour)."""
    return i.hours()


def enrich_hourly_q(i: Inputs) -> DataFrame:
    """The silver table."""
    return i.silver()


def merge_hourly(i: Inputs) -> DataFrame:
    """All trips with three columns of their hour, under unit names and
    in coarse classes, and the hour's own date and hour."""
    hours = rename_to_units(i.hours()).withColumn("weather_category", classify_code_coarse("weather_code"))
    return merge_hours(i.trips, hours, EXPLORATION_COLUMNS)


def enrich_daily_q(i: Inputs) -> DataFrame:
    """Trips joined (inner) to the day's observations."""
    return enrich_daily(i.checked_trips(), daily_weather(i.weather()))


def matched_semi(i: Inputs) -> DataFrame:
    """Trips whose hour has an observation."""
    return join_hours(i.checked_trips(), i.hours(), "left_semi")


def unmatched_anti(i: Inputs) -> DataFrame:
    """Trips whose hour has none."""
    return join_hours(i.checked_trips(), i.hours(), "left_anti")


def repeated_hour(i: Inputs) -> DataFrame:
    """Trips and observations around the end of daylight saving
    time. Observations land as local times without offset; both passes of
    the repeated hour keep their observation and their trips."""
    later = lambda c: wall_clock_instant(F.date_add(F.to_date(c), CLOCK_SHIFT_DAYS).cast("string")
                                         .cast("timestamp_ntz")) + (F.col(c) - F.to_date(c).cast("timestamp_ntz"))
    raw = i.weather_raw.withColumn("instant", later("datetime"))
    landed = standin.local_documents(instants.unique_instants(raw.drop("datetime"), CLOCK_ZONE), CLOCK_ZONE)
    parsed = responses.parse_response_text(landed, "body", keep=("day",))
    resolved = instants.resolve_instants(parsed, CLOCK_ZONE, ["day"])
    seen = resolved.filter(F.col("temperature_2m").isNotNull())
    hours = instants.unique_instants(seen.drop("day", "position"), CLOCK_ZONE)
    trips = i.trips.withColumn("pickup", later("tpep_pickup_datetime"))
    joined = instants.join_on_instant(trips, hours, "pickup", CLOCK_ZONE, ["temperature_2m", "weather_code", "clock"])
    return joined.select(
        instants.wall_clock(F.col("pickup"), "UTC").alias("pickup_utc"),
        instants.wall_clock(F.col("pickup"), CLOCK_ZONE).alias("pickup_local"),
        "fare_amount", "temperature_2m", "weather_code", "clock")


# --- aggregates -----------------------------------------------------------

def weather_impact_summary(i: Inputs) -> DataFrame:
    """A1 (flagship)."""
    return metrics.weather_impact_summary(i.silver())


def hourly_weather_metrics(i: Inputs) -> DataFrame:
    """A2."""
    return metrics.hourly_weather_metrics(i.silver())


def temperature_band_analysis(i: Inputs) -> DataFrame:
    """A3."""
    return metrics.temperature_band_analysis(i.silver())


def explore_summary(i: Inputs) -> DataFrame:
    """A4."""
    return metrics.explore_summary(i.silver())


def profile_weather(i: Inputs) -> DataFrame:
    """A5."""
    return stats.profile_weather(i.weather())


def category_counts(i: Inputs) -> DataFrame:
    """A6."""
    return metrics.category_counts(i.weather())


def condition_compare(i: Inputs) -> DataFrame:
    """A7/P13/P16."""
    return metrics.condition_compare(i.silver())


def fare_boxplot(i: Inputs) -> DataFrame:
    """A9."""
    return stats.fare_boxplot(i.silver())


def distance_trend(i: Inputs) -> DataFrame:
    """A10: regression line."""
    return stats.distance_trend(i.silver())


def distance_by_degree(i: Inputs) -> DataFrame:
    """A10: binned averages."""
    return stats.distance_by_degree(i.silver())


def distance_smooth(i: Inputs) -> DataFrame:
    """A10: local regression of distance on temperature."""
    return stats.distance_smooth(i.silver())


def fare_sketch_check(i: Inputs) -> DataFrame:
    """Quartiles from merged daily sketches, held against the exact ranks
    of the fares."""
    return stats.quartile_errors(i.silver(), stats.fare_quartiles(stats.fare_sketches(i.silver())))


def rainy_day_ridership(i: Inputs) -> DataFrame:
    """A11."""
    return metrics.rainy_day_ridership(i.checked_trips(), i.hours())


# --- streaming ------------------------------------------------------------

def stream_enrich(i: Inputs) -> DataFrame:
    """The events file as a trip stream, enriched batch by batch; the
    query runs to completion and its sink is returned."""
    trips = check_trip_stream(stream_trips(i.spark, i.sf_dir))
    out = scratch_path(i.spark, "stream_enrich-out")
    run_available(enrich_stream(trips, i.hours()), out, scratch_path(i.spark, "stream_enrich-chk"))
    return i.spark.read.parquet(out)


def stream_hourly_metrics(i: Inputs) -> DataFrame:
    """Hourly windows over the enriched stream, watermark one hour."""
    trips = check_trip_stream(stream_trips(i.spark, i.sf_dir))
    out = scratch_path(i.spark, "stream_hourly_metrics-out")
    run_available(hourly_stream_metrics(enrich_stream(trips, i.hours())), out,
                  scratch_path(i.spark, "stream_hourly_metrics-chk"))
    return i.spark.read.parquet(out)


def stream_late_weather(i: Inputs) -> DataFrame:
    """Trips and observations as two streams; the observations of every
    ten days land one micro-batch after their trips. All trips of hours that
    the watermark has passed are there."""
    trips_at, weather_at = scratch_path(i.spark, "late-trips"), scratch_path(i.spark, "late-weather")
    i.weather_raw.limit(0).coalesce(1).write.mode("append").parquet(weather_at)
    for first, last in LATE_DAYS:
        for rows, time, path in ((i.trips, "tpep_pickup_datetime", trips_at), (i.weather_raw, "datetime", weather_at)):
            # One file a step, so that a step is one micro-batch.
            (rows.filter(F.dayofmonth(time).between(first, last)).coalesce(1).write.mode("append").parquet(path))
    trips = check_trip_stream(read_file_stream(i.spark, trips_at, max_files_per_trigger=1))
    weather = read_file_stream(i.spark, weather_at, max_files_per_trigger=1)
    out = scratch_path(i.spark, "late-out")
    run_available(enrich_late(trips, weather), out, scratch_path(i.spark, "late-chk"))
    return i.spark.read.parquet(out)


def stream_match_rate(i: Inputs) -> DataFrame:
    """Match rate over the last 24 hours, hour by hour, and alerts."""
    trips = check_trip_stream(stream_trips(i.spark, i.sf_dir))
    out = scratch_path(i.spark, "match-out")
    run_available(match_rate_stream(enrich_stream(trips, i.hours())), out, scratch_path(i.spark, "match-chk"),
                  conf=state_conf(i.spark))
    return i.spark.read.parquet(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_events": scan_events,
    "sample_trips": _q(sample_trips),
    "preview_trips": _q(preview_trips),
    "ingest_hourly": _q(ingest_hourly),
    "plan_windows": _q(plan_windows),
    "union_chunks": _q(union_chunks),
    "bronze_weather": _q(bronze_weather_q),
    "classify_code": _q(classify_code_q),
    "classify_code_coarse": _q(classify_code_coarse_q),
    "temperature_bands": _q(temperature_bands),
    "condition_recode": _q(condition_recode_q),
    "expect_warn_report": _q(expect_warn_report),
    "staged_checks": _q(staged_checks),
    "guard_report": _q(guard_report_q),
    "expect_drop": _q(expect_drop),
    "expect_fail_pass": _q(expect_fail_pass),
    "match_rate": _q(match_rate_q),
    "csv_read_back": _q(csv_read_back),
    "json_read_back": _q(json_read_back),
    "clustered_read_back": _q(clustered_read_back),
    "refresh_silver": _q(refresh_silver),
    "unit_names": _q(unit_names),
    "merge_hourly": _q(merge_hourly),
    "unique_hours": _q(unique_hours_q),
    "enrich_hourly": _q(enrich_hourly_q),
    "enrich_daily": _q(enrich_daily_q),
    "matched_semi": _q(matched_semi),
    "unmatched_anti": _q(unmatched_anti),
    "weather_impact_summary": _q(weather_impact_summary),
    "hourly_weather_metrics": _q(hourly_weather_metrics),
    "temperature_band_analysis": _q(temperature_band_analysis),
    "explore_summary": _q(explore_summary),
    "profile_weather": _q(profile_weather),
    "category_counts": _q(category_counts),
    "condition_compare": _q(condition_compare),
    "fare_boxplot": _q(fare_boxplot),
    "distance_trend": _q(distance_trend),
    "distance_by_degree": _q(distance_by_degree),
    "rainy_day_ridership": _q(rainy_day_ridership),
    "stream_enrich": _q(stream_enrich),
    "stream_hourly_metrics": _q(stream_hourly_metrics),
    "stream_late_weather": _q(stream_late_weather),
    "stream_match_rate": _q(stream_match_rate),
    "refresh_gold": _q(refresh_gold),
    "refresh_gold_bands": _q(refresh_gold_bands),
    "weather_changes": _q(weather_changes),
    "refresh_changed": _q(refresh_changed),
    "quarantine_counts": _q(quarantine_counts),
    "quarantined_trips": _q(quarantined_trips),
    "distance_smooth": _q(distance_smooth),
    "fare_sketch_check": _q(fare_sketch_check),
    "repeated_hour": _q(repeated_hour),
    "qualified_read": _q(qualified_read),
    "namespace_read": _q(namespace_read),
    "table_handle": _q(table_handle),
    "code_lookup": _q(code_lookup),
    "rejected_documents": _q(rejected_documents),
    "stream_ingest": _q(stream_ingest),
    "missing_windows": _q(missing_windows),
}

FLAGSHIP = "weather_impact_summary"
