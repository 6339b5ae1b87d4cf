"""Local hours around two clock changes, and documents that can't be parsed."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ridewx.operators import instants
from ridewx.schemas import HOURLY_VARIABLES
from ridewx.sources import responses

ZONE = "America/New_York"


def document(times, temps):
    hourly = {v: [None] * len(times) for v in HOURLY_VARIABLES} | {"time": times, "temperature_2m": temps}
    return json.dumps({"hourly": hourly})


def utc(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def resolved(spark, docs, **options):
    df = spark.createDataFrame(list(enumerate(docs)), "doc int, body string")
    parsed = responses.parse_response_text(df, "body", keep=("doc",))
    return instants.resolve_instants(parsed, ZONE, ["doc"], **options)


def seen(df):
    """(position, temperature, instant as UTC text, clock) in order."""
    out = df.select("doc", "position", "temperature_2m", "clock",
                    instants.wall_clock(F.col("instant"), "UTC").cast("string").alias("utc"))
    return [(r.position, r.temperature_2m, r.utc, r.clock) for r in out.orderBy("doc", "position").collect()]


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_autumn_and_spring(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        autumn = [f"2024-11-03T{h}:00" for h in ("00", "01", "01", "02")]
        spring = [f"2024-03-10T{h}:00" for h in ("01", "02", "03")]
        got = seen(resolved(spark, [document(autumn, [1, 2, 3, 4]), document(spring, [5, 6, 7])]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [(0, 1.0, "2024-11-03 04:00:00", "plain"), (1, 2.0, "2024-11-03 05:00:00", "first"),
                   (2, 3.0, "2024-11-03 06:00:00", "second"), (3, 4.0, "2024-11-03 07:00:00", "plain"),
                   (0, 5.0, "2024-03-10 06:00:00", "plain"), (1, 6.0, "2024-03-10 07:00:00", "gap"),
                   (2, 7.0, "2024-03-10 07:00:00", "plain")]


def test_times_finer_than_an_hour_and_single_passes(spark):
    fine = [f"2024-11-03T{t}" for t in ("00:30", "01:00", "01:30", "01:00", "01:30", "02:00")]
    clocks = [c for *_, c in seen(resolved(spark, [document(fine, [0] * 6)]))]
    assert clocks == ["plain", "first", "first", "second", "second", "plain"]
    # One pass only, a missing time, and an empty document.
    got = seen(resolved(spark, [document(["2024-11-03T01:00"], [1]), document([None, "2024-11-03T01:00"], [1, 2]),
                                document([], [])]))
    assert [c for *_, c in got] == ["first", None, "first"]


def test_both_passes_keep_their_observation_and_trips(spark):
    times = [f"2024-11-03T{h:02d}:00" for h in (0, 1, 1, 2)]
    hours = instants.unique_instants(resolved(spark, [document(times, [10, 20, 30, 40])]).drop("doc", "position"), ZONE)
    assert hours.count() == 4
    trips = spark.createDataFrame([(n, utc(t)) for n, t in enumerate(
        ["2024-11-03 05:10", "2024-11-03 06:10", "2024-11-03 06:59:59.999999", "2024-11-03 08:00"])], "n int, pickup timestamp")
    joined = instants.join_on_instant(trips, hours, "pickup", ZONE, ["temperature_2m", "clock"])
    assert {r.n: (r.temperature_2m, r.clock) for r in joined.collect()} == {
        0: (20.0, "first"), 1: (30.0, "second"), 2: (30.0, "second"), 3: (None, None)}


def test_half_hour_zones_begin_hours_on_the_local_clock(spark):
    at = spark.createDataFrame([(utc("2024-06-01 10:40"),)], "t timestamp")
    hour = instants.hour_instant(F.col("t"), "Asia/Kolkata")  # 16:10 local
    assert at.select(instants.wall_clock(hour, "UTC").cast("string")).first()[0] == "2024-06-01 10:30:00"


def test_rejected_documents_by_reason(spark):
    good = document(["2024-01-01T00:00"], [1])
    docs = [good, good, '{"invalid": "response"}', "not json", None, '{"hourly": {"rain": [1]}}',
            json.dumps({"hourly": {"time": ["2024-01-01T00:00"], "rain": [1, 2]}})]
    got = {r.problem: r.documents for r in responses.rejected_report(
        spark.createDataFrame([(d,) for d in docs], "body string")).collect()}
    assert got == {None: 2, responses.MISSING_HOURLY: 3, responses.MISSING_TIME: 1, responses.UNEVEN: 1}
