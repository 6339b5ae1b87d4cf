"""Streaming forms of the enrichment (X1) and the hourly metrics.

X1 is a stream-static left join: each micro-batch of trips is joined to
the (size-checked, broadcast) hour table; it keeps no state. X2 groups the
enriched stream into tumbling one-hour windows of pickup time with a
watermark, in append mode: a window is emitted once the watermark passes
its end and its state is dropped, so state holds only the open windows.
Trips later than the watermark are dropped, as in any append aggregate, and
counted in the report that ``run_available`` returns. ``late_weather`` has
the form in which observations are a stream too.

Sources and sinks are files. The caller names the sink and the streaming
checkpoint, so a query restarted with the same ones resumes where it
stopped. The hour table of X1 and X2 is the one read when the query starts;
``enrich_batches`` reads it anew for every micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewx.functions.timecols import hour_start
from ridewx.functions.exact import DISTANCE_PLACES, MONEY_PLACES, avg_fine, sum_fine
from ridewx.operators.enrich import hour_side, join_hours, size_checked, with_hour_keys
from ridewx.operators.quality import SILVER_EXPECTATIONS, TRIP_EXPECTATIONS, DROP, FAIL, apply_expectations
from ridewx.schemas import WEATHER_JOIN_COLUMNS
from ridewx.sources import standin

EVENT_TIME = "event_time"


def read_file_stream(spark: SparkSession, folder: str, pattern: str = "*.parquet",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files landing in ``folder`` (matching ``pattern``) as a
    stream; the schema is taken from the files already there."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(folder)


def check_trip_stream(trips: DataFrame) -> DataFrame:
    """Trip expectations on a stream: fail filters, counters (reported in
    the query progress as ``trips_stream``), then drop filters."""
    for e in TRIP_EXPECTATIONS:
        if e.action == FAIL:
            msg = F.lit(f"Expectation '{e.name}' failed: {e.predicate}")
            trips = trips.filter(F.when(e.passes(), F.lit(True)).otherwise(F.raise_error(msg)))
    trips = trips.observe("trips_stream", F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(~e.passes()).alias(e.name) for e in TRIP_EXPECTATIONS])
    for e in TRIP_EXPECTATIONS:
        if e.action == DROP:
            trips = trips.filter(e.passes())
    return trips


def enrich_stream(trips: DataFrame, hours: DataFrame,
                  time_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Trips (a stream) left-joined to the static hour table."""
    side = size_checked(hour_side(hours), "hours").df
    keyed = with_hour_keys(trips, time_col)
    joined = keyed.join(side, (keyed["pickup_date"] == side["weather_date"])
                        & (keyed["pickup_hour"] == side["weather_hour"]), "left")
    out = joined.select(*trips.columns, *WEATHER_JOIN_COLUMNS, "pickup_date", "pickup_hour")
    # The silver layer's warn checks, reported with the query progress.
    return out.observe("silver_stream", F.count(F.lit(1)).alias("rows"),
                       *[F.count_if(~e.passes()).alias(e.name) for e in SILVER_EXPECTATIONS])


def enrich_batches(trips: DataFrame, hours: Callable[[], DataFrame], out: str, checkpoint: str,
                   time_col: str = "tpep_pickup_datetime", fmt: str = "parquet",
                   on_counters: Callable[[int, dict], None] | None = None) -> str:
    """X1 with an hour table that may grow: every micro-batch of ``trips``
    is joined to ``hours()`` as it is then, and written to a folder of its
    own under ``out`` (overwritten if the batch is run again, so each trip
    is written once). The silver layer's warn checks are counted on every
    batch and passed to ``on_counters`` with the batch's number. Processes
    what is available now; returns ``out``."""
    columns = [*trips.columns, *WEATHER_JOIN_COLUMNS, "pickup_date", "pickup_hour"]

    def write(batch: DataFrame, number: int) -> None:
        checked = apply_expectations(join_hours(batch, hours(), "left", time_col).select(*columns),
                                     SILVER_EXPECTATIONS, f"silver_batch_{number}")
        checked.df.write.mode("overwrite").format(fmt).save(f"{out}/batch={number}")
        if on_counters is not None:
            on_counters(number, checked.metrics())

    _finish(trips.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
    return out


def wall_clock_instant(ts_ntz):
    """A TIMESTAMP_NTZ wall-clock time as the instant it names in UTC.

    Watermarks need TIMESTAMP; reading the wall clock as UTC (instead of
    casting in the session zone) keeps hour windows on local hours and the
    result independent of ``spark.sql.session.timeZone``.
    """
    return F.concat(ts_ntz.cast("string"), F.lit("Z")).cast("timestamp")


def hourly_stream_metrics(enriched: DataFrame, time_col: str = "tpep_pickup_datetime",
                          delay: str = "1 hour") -> DataFrame:
    """Per one-hour window of pickup time and weather category."""
    timed = enriched.withColumns({
        EVENT_TIME: wall_clock_instant(F.col(time_col)),
        "window_start": hour_start(time_col),
    })
    # The window (on the watermarked column) drives state eviction; the
    # truncated wall-clock hour names the same window as TIMESTAMP_NTZ.
    return (timed.withWatermark(EVENT_TIME, delay)
            .groupBy(F.window(EVENT_TIME, "1 hour"), "window_start", "weather_category")
            .agg(F.count(F.lit(1)).alias("trip_count"),
                 avg_fine("fare_amount", MONEY_PLACES, 2).alias("avg_fare"),
                 sum_fine("fare_amount", MONEY_PLACES, 2).alias("total_revenue"),
                 avg_fine("trip_distance", DISTANCE_PLACES, 2).alias("avg_distance"))
            .select("window_start",
                    F.timestamp_add("HOUR", F.lit(1), F.col("window_start")).alias("window_end"),
                    "weather_category", "trip_count", "avg_fare", "total_revenue",
                    "avg_distance"))


LATE_ROWS = "rowsDroppedByWatermark"


def late_rows(progress: list) -> int:
    """Rows that stateful operators dropped because they lay behind the
    watermark, over the given progress reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


def _finish(query) -> dict:
    """The last progress report, with the rows dropped behind the watermark
    under ``LATE_ROWS``, over as many micro-batches as the session keeps
    reports of (``spark.sql.streaming.numRecentProgressUpdates``)."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    recent = query.recentProgress
    return {**recent[-1], LATE_ROWS: late_rows(recent)} if recent else {LATE_ROWS: 0}


@contextmanager
def _settings(spark: SparkSession, conf: dict) -> Iterator[None]:
    """``conf`` in the session, whose own settings are put back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_available(df: DataFrame, out: str, checkpoint: str, output_mode: str = "append",
                  fmt: str = "parquet", conf: dict | None = None) -> dict:
    """Process everything available now into the file sink ``out``; return
    the last progress report. A later call with the same ``out`` and
    ``checkpoint`` takes up only what is new. ``conf``: settings of this
    query alone (it takes them over from the session when it starts)."""
    with _settings(df.sparkSession, conf or {}):
        query = (df.writeStream.format(fmt).outputMode(output_mode)
                 .option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True)
                 .start(out))
    return _finish(query)


def stream_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in trips as a stream over the events table: its folder of
    part files, or the single ``events.parquet`` file in ``sf_dir``."""
    table = standin.source_path(sf_dir, "events")
    # Spark names the files, also on file systems that os.path does not reach.
    names = [f.rsplit("/", 2)[1:] for f in spark.read.parquet(table).inputFiles()]
    if len(names) == 1 and names[0][1] == "events.parquet" != names[0][0]:
        events = read_file_stream(spark, sf_dir, "events.parquet")
    else:
        events = read_file_stream(spark, table, "*.parquet")
    return standin.trips(events)
