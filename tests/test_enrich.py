import datetime as dt

from ridewx.operators.enrich import enrich_hourly, join_hours, size_checked
from ridewx.operators.observations import daily_weather, type_observations, unique_hours
from ridewx.plans.catalog import QUERIES
from ridewx.schemas import TRIP_SCHEMA, WEATHER_RAW_SCHEMA

from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_duplicate_hours_do_not_multiply_trips(spark):
    t = dt.datetime(2024, 1, 1, 9, 0)
    raw = spark.createDataFrame([
        (t, 1.0, 50.0, 0.0, 0.0, 0.0, 1.0, 0),
        (t + dt.timedelta(minutes=30), 2.0, 50.0, 0.0, 0.0, 0.0, 1.0, 61),
    ], WEATHER_RAW_SCHEMA)
    hours = unique_hours(type_observations(raw))
    trips = spark.createDataFrame([(t + dt.timedelta(minutes=5), t, "1", "2", 1.0, 5.0)], TRIP_SCHEMA)
    silver = enrich_hourly(trips, hours)[0].collect()
    assert len(silver) == 1
    assert silver[0].temperature_2m == 1.0  # the earliest observation of the hour


def test_left_join_keeps_trip_count_and_semi_anti_partition(spark):
    q = {k: QUERIES[k](spark, SF_SMALL) for k in
         ("enrich_hourly", "matched_semi", "unmatched_anti", "expect_drop")}
    n = q["expect_drop"].count()
    assert q["enrich_hourly"].count() == n == 726
    assert q["matched_semi"].count() + q["unmatched_anti"].count() == n
    assert q["matched_semi"].count() == 188


def test_hour_join_is_broadcast_after_size_check(spark):
    df = QUERIES["matched_semi"](spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(df)


def test_hour_join_falls_back_to_shuffle_join(spark):
    from ridewx.plans.catalog import Inputs
    i = Inputs(spark, SF_SMALL)
    df = join_hours(i.checked_trips(), i.hours(), "left", max_broadcast_rows=10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(df)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert df.count() == 726
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_check_writes_anew_for_each_caller(spark):
    df = spark.range(5).selectExpr("id", "id * 2 AS v")
    a = size_checked(df, "t")
    b = size_checked(spark.range(5).selectExpr("id", "id * 2 AS v"), "t")
    assert a.rows == b.rows == 5 and a.broadcast
    assert set(a.df.inputFiles()).isdisjoint(b.df.inputFiles())


def test_daily_weather_one_row_per_day(spark):
    from ridewx.plans.catalog import Inputs
    days = daily_weather(Inputs(spark, SF_SMALL).weather())
    assert days.count() == days.select("weather_date").distinct().count()


def test_earliest_per_group_paths_agree_and_ties_keep_whole_rows(spark):
    from pyspark.sql import functions as F

    from ridewx.operators.observations import earliest_per_group
    t0 = dt.datetime(2024, 1, 1, 9, 15)
    rows = [(t0, 1.0, 7), (t0, 2.0, 8), (t0 + dt.timedelta(minutes=1), 0.5, 9),
            (t0 + dt.timedelta(hours=1), 3.0, 1), (t0 + dt.timedelta(hours=1, seconds=1), 4.0, 2)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, x double, c int")
    keys = [F.hour("t").alias("h")]
    picks = []
    for ordered in (rows, list(reversed(rows))):
        d = spark.createDataFrame(ordered, "t timestamp_ntz, x double, c int").repartition(3)
        picks.append(sorted(tuple(r) for r in earliest_per_group(d, keys, "t").collect()))
    assert picks[0] == picks[1]  # the tie at 09:15 resolves the same way
    chosen = {r[0]: r for r in picks[0]}
    assert (chosen[9][2], chosen[9][3]) in {(1.0, 7), (2.0, 8)}  # a whole row, never mixed
    assert chosen[10][2:] == (3.0, 1)
    # the struct path (a string column) agrees where there is no tie
    s = df.withColumn("s", F.col("c").cast("string")).filter("x != 2.0")
    got = {r.h: (r.x, r.s) for r in earliest_per_group(s, keys, "t").collect()}
    assert got == {9: (1.0, "7"), 10: (3.0, "1")}


def test_changed_source_is_seen_and_types_pass_through(spark, tmp_dir):
    """No hour table is kept between joins; trips may hold TIMESTAMP times
    and integer zips."""
    import os

    from ridewx.operators.enrich import enrich_hourly
    from ridewx.operators.observations import hours_of

    path = os.path.join(tmp_dir, "raw")
    trips = spark.sql("""SELECT TIMESTAMP '2021-05-01 10:15:00' AS tpep_pickup_datetime,
        TIMESTAMP '2021-05-01 10:30:00' AS tpep_dropoff_datetime, 1 AS pickup_zip, 2 AS dropoff_zip,
        1.5D AS trip_distance, 9.0D AS fare_amount""")

    def join(temperature):
        spark.sql(f"""SELECT TIMESTAMP_NTZ '2021-05-01 10:00:00' AS datetime, {temperature}D AS temperature_2m,
            50D AS relative_humidity_2m, 0D AS precipitation, 0D AS rain, 0D AS snowfall, 1D AS wind_speed_10m,
            0 AS weather_code""").write.mode("overwrite").parquet(path)
        return enrich_hourly(trips, hours_of(spark.read.parquet(path)), observe=False)[0]

    first, second = join(1.0), None
    assert first.first().temperature_2m == 1.0
    second = join(99.0)
    assert second.first().temperature_2m == 99.0
    assert dict(second.dtypes)["pickup_zip"] == "int" and dict(second.dtypes)["tpep_pickup_datetime"] == "timestamp"


def test_guard_ties_do_not_depend_on_order(spark):
    from ridewx.operators.observations import guard_report, hours_of, unique_hours, type_observations
    from ridewx.schemas import WEATHER_RAW_SCHEMA
    t = dt.datetime(2024, 1, 1, 5)
    rows = [(t, 1.0, 50.0, 0.1, 0.1, None, 3.0, 61), (t, 1.0, 50.0, 0.1, None, 0.1, 3.0, 61),
            (None, 9.0, 50.0, 0.0, 0.0, 0.0, 3.0, 0)]
    seen = set()
    for order in (rows, rows[::-1]):
        raw = spark.createDataFrame(order, WEATHER_RAW_SCHEMA).coalesce(1)
        by_raw = hours_of(raw).collect()
        by_typed = unique_hours(type_observations(raw)).collect()
        assert len(by_raw) == len(by_typed) == 1  # a row without a time is in no hour
        seen.add(by_raw[0])
        r = guard_report(raw).first()
        assert (r.observations, r.without_time, r.hours, r.dropped) == (3, 1, 1, 1)
    assert len(seen) == 1
