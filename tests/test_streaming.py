import os

from ridewx.operators.observations import hours_of
from ridewx.plans.catalog import Inputs
from ridewx.streaming.enrich_stream import (
    check_trip_stream,
    enrich_batches,
    enrich_stream,
    hourly_stream_metrics,
    read_file_stream,
    run_available,
    stream_trips,
)

from tests.conftest import SF_CHECK


def test_stream_static_enrichment_counts(spark, tmp_dir):
    i = Inputs(spark, SF_CHECK)
    trips = check_trip_stream(stream_trips(spark, SF_CHECK))
    out = os.path.join(tmp_dir, "out")
    progress = run_available(enrich_stream(trips, i.hours()), out, os.path.join(tmp_dir, "chk"))
    assert progress["observedMetrics"]["silver_stream"]["has_weather_data"] >= 0
    df = spark.read.parquet(out)
    assert df.count() == 7231
    assert df.filter("temperature_2m IS NOT NULL").count() == 6814


def test_windowed_metrics_hold_back_open_windows(spark, tmp_dir):
    i = Inputs(spark, SF_CHECK)
    trips = check_trip_stream(stream_trips(spark, SF_CHECK))
    out = os.path.join(tmp_dir, "out")
    run_available(hourly_stream_metrics(enrich_stream(trips, i.hours())), out, os.path.join(tmp_dir, "chk"))
    df = spark.read.parquet(out)
    # 720 hours of data; the watermark (latest pickup - 1 hour) has not
    # passed the end of the last two windows, so they stay open.
    assert df.select("window_start").distinct().count() == 718
    assert df.groupBy().sum("trip_count").first()[0] < 7231


def test_stream_resumes_and_sees_new_weather(spark, fixture_trips, fixture_weather_raw, tmp_dir):
    trips, weather, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "weather", "out", "chk"))
    late = "datetime >= TIMESTAMP_NTZ'2021-12-24 00:00:00'"
    fixture_weather_raw.filter(f"NOT ({late})").write.parquet(weather)

    def run(day_filter):
        fixture_trips.filter(day_filter).coalesce(1).write.mode("append").parquet(trips)
        enrich_batches(check_trip_stream(read_file_stream(spark, trips)),
                       lambda: hours_of(spark.read.parquet(weather)), out, chk)
        return {(r.tpep_pickup_datetime, r.temperature_2m) for r in spark.read.parquet(out).collect()}

    cut = "tpep_pickup_datetime {} TIMESTAMP_NTZ'2021-08-01 00:00:00'"
    assert len(run(cut.format("<"))) == 8
    fixture_weather_raw.filter(late).write.mode("append").parquet(weather)
    rows = run(cut.format(">="))
    assert len(rows) == 13 and spark.read.parquet(out).count() == 13
    assert sum(t is None for _, t in rows) == 1


def test_run_available_takes_up_only_what_is_new(spark, fixture_trips, fixture_weather_raw, tmp_dir):
    trips, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "out", "chk"))
    hours = hours_of(fixture_weather_raw)
    for _ in range(2):
        fixture_trips.coalesce(1).write.mode("append").parquet(trips)
        run_available(enrich_stream(check_trip_stream(read_file_stream(spark, trips)), hours), out, chk)
    assert spark.read.parquet(out).count() == 26
