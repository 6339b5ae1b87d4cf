"""Weather that arrives after its trips, rows behind the watermark, the
sliding match rate and the counters of the batch form."""

import datetime as dt
import glob
import os
import shutil

from pyspark.sql import functions as F

from ridewx.plans.catalog import QUERIES
from ridewx.streaming.enrich_stream import (
    LATE_ROWS,
    check_trip_stream,
    enrich_batches,
    hourly_stream_metrics,
    read_file_stream,
    run_available,
    stream_trips,
)
from ridewx.streaming.late_weather import enrich_late
from ridewx.streaming.match_monitor import PROVIDER, match_rate_stream, state_conf

TRIPS = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, pickup_zip string, "
         "dropoff_zip string, trip_distance double, fare_amount double")
WEATHER = ("datetime timestamp_ntz, temperature_2m double, relative_humidity_2m double, precipitation double, "
           "rain double, snowfall double, wind_speed_10m double, weather_code int")


def at(hour, minute=0):
    return dt.datetime(2024, 5, 1) + dt.timedelta(hours=hour, minutes=minute)


def land_trips(spark, path, *times, fare=5.0):
    rows = [(t, t + dt.timedelta(minutes=9), "a", "b", 1.0, fare) for t in times]
    spark.createDataFrame(rows, TRIPS).coalesce(1).write.mode("append").parquet(path)


def land_weather(spark, path, *readings):
    rows = [(t, temp, 50.0, 0.0, 0.0, 0.0, 3.0, 0) for t, temp in readings]
    spark.createDataFrame(rows, WEATHER).coalesce(1).write.mode("append").parquet(path)


def test_weather_after_its_trips_is_joined_across_a_restart(spark, tmp_dir):
    trips, weather, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "weather", "out", "chk"))

    def run():
        run_available(enrich_late(check_trip_stream(read_file_stream(spark, trips)), read_file_stream(spark, weather)),
                      out, chk)
        return {(r.tpep_pickup_datetime, r.temperature_2m) for r in spark.read.parquet(out).collect()}

    land_trips(spark, trips, at(1, 10), at(2, 20), at(3, 30), at(6))
    land_weather(spark, weather, (at(0, 5), 1.0))
    assert run() == set()  # the observations stop at hour 0: everything waits
    # Hour 1 has two observations (the earlier counts), hour 2 none.
    land_weather(spark, weather, (at(1, 40), 12.0), (at(1, 15), 11.0), (at(3, 1), 13.0), (at(4, 30), 14.0))
    land_trips(spark, trips, at(4, 45))
    assert run() == {(at(1, 10), 11.0), (at(2, 20), None)}
    land_weather(spark, weather, (at(9), 19.0))
    land_trips(spark, trips, at(9))
    everything = {(at(1, 10), 11.0), (at(2, 20), None), (at(3, 30), 13.0), (at(4, 45), 14.0), (at(6), None)}
    assert run() == everything
    assert spark.read.parquet(out).count() == 5
    assert run() == everything  # nothing new: nothing is written twice


def test_rows_behind_the_watermark_are_counted(spark, tmp_dir):
    trips, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "out", "chk"))

    def run():
        stream = check_trip_stream(read_file_stream(spark, trips)).withColumn("weather_category", F.lit("Clear"))
        return run_available(hourly_stream_metrics(stream), out, chk)[LATE_ROWS]

    land_trips(spark, trips, at(1), at(10))
    assert run() == 0
    land_trips(spark, trips, at(2), at(2, 30), at(11))  # two trips eight hours late
    assert run() == 1  # one partial row of the hour that both fell in
    land_trips(spark, trips, at(10, 30))
    assert run() == 0


def test_sliding_match_rate_across_a_restart(spark, tmp_dir):
    trips, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "out", "chk"))

    def land(hour, n, matched):
        rows = [(at(hour, i), 1.0 if i < matched else None) for i in range(n)]
        spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, temperature_2m double").coalesce(
            1).write.mode("append").parquet(trips)

    def run():
        run_available(match_rate_stream(read_file_stream(spark, trips), hours=3), out, chk)
        return {(r.window_end, r.trips, r.matched, r.hours, r.alert) for r in spark.read.parquet(out).collect()}

    land(0, 10, 10)
    land(1, 10, 7)
    land(4, 4, 4)
    first = {(at(1), 10, 10, 1, False), (at(2), 20, 17, 2, True)}
    assert run() == first
    land(3, 2, 2)  # not late yet: the watermark is at hour 3
    land(9, 1, 1)
    # Hour 0 has left the window that ends at 4; at 5 hour 1 is out too.
    assert run() == first | {(at(4), 12, 9, 2, True), (at(5), 6, 6, 2, False)}


def test_match_rate_by_monitor(spark, tmp_dir):
    trips, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "out", "chk"))
    rows = [(at(0, i), "ab"[i % 2], 1.0 if i % 2 else None) for i in range(10)] + [(at(5), "a", 1.0)]
    spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, zone string, temperature_2m double").write.parquet(trips)
    run_available(match_rate_stream(read_file_stream(spark, trips), monitor=F.col("zone")), out, chk)
    assert {(r.monitor, r.trips, r.match_rate, r.alert) for r in spark.read.parquet(out).collect()} == {
        ("a", 5, 0.0, True), ("b", 5, 1.0, False)}


def test_match_rate_on_sparks_default_state_store(spark, tmp_dir):
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    session = spark.newSession()
    session.conf.set(PROVIDER, default)
    rows = [(at(0, 5), "error"), (at(0, 10), "click"), (at(0, 20), "click"), (at(2), "click"), (at(2, 30), "error"),
            (at(3), "click"), (at(9), "click")]
    session.createDataFrame([(n, t, 1, kind, 50.0, '{"k": 7}') for n, (t, kind) in enumerate(rows)],
                            "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                            "props string").coalesce(1).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    found = QUERIES["stream_match_rate"](session, tmp_dir).collect()
    assert {(r.window_end, r.trips, r.matched, r.hours, r.alert) for r in found} == {
        (at(1), 2, 2, 1, False), (at(3), 3, 3, 2, False), (at(4), 4, 3, 3, True)}
    assert session.conf.get(PROVIDER) == default  # the caller's setting is put back


def test_trip_stream_of_one_remote_file(spark, tmp_dir):
    # One file, then a folder of part files, by a path that names its file system.
    rows = spark.createDataFrame([(1, at(1), 1, "click", 50.0, '{"k": 7}')],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                                 "props string").coalesce(1)
    folder = os.path.join(tmp_dir, "folder")
    rows.write.parquet(os.path.join(folder, "events.parquet"))
    part, = glob.glob(os.path.join(folder, "events.parquet", "*.parquet"))
    one = os.path.join(tmp_dir, "one")
    os.mkdir(one)
    shutil.copy(part, os.path.join(one, "events.parquet"))
    for n, path in enumerate((one, f"file://{one}", folder, f"file://{folder}")):
        out = os.path.join(tmp_dir, f"out{n}")
        run_available(stream_trips(spark, path), out, os.path.join(tmp_dir, f"chk{n}"))
        assert spark.read.parquet(out).count() == 1


def test_another_state_store_stays(spark):
    session = spark.newSession()
    session.conf.set(PROVIDER, "org.example.OtherProvider")
    assert state_conf(session) == {}


def test_batches_report_their_counters(spark, fixture_trips, fixture_weather_raw, tmp_dir):
    from ridewx.operators.observations import hours_of

    trips, out, chk = (os.path.join(tmp_dir, d) for d in ("trips", "out", "chk"))
    fixture_trips.coalesce(1).write.parquet(trips)
    seen = {}
    enrich_batches(check_trip_stream(read_file_stream(spark, trips)), lambda: hours_of(fixture_weather_raw), out, chk,
                   on_counters=seen.__setitem__)
    written = spark.read.parquet(out)
    assert sum(m["rows"] for m in seen.values()) == written.count()
    assert sum(m["has_weather_data"] for m in seen.values()) == written.filter("temperature_2m IS NULL").count()
