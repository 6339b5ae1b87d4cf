"""Skew, time zones and the load step."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ridewx.operators.enrich import join_hours
from ridewx.operators.observations import type_observations, unique_hours
from ridewx.plans.medallion import load_observations
from ridewx.schemas import WEATHER_RAW_SCHEMA
from ridewx.streaming.enrich_stream import wall_clock_instant

from tests.test_plans import _plan


def test_hot_hour_is_split_in_shuffle_join(spark):
    """A third of all trips in one hour, and the hour table forced past the
    broadcast bound: AQE splits the hot partition of the join."""
    base = dt.datetime(2024, 1, 1)
    # distinct rows, so shuffle blocks do not compress away the skew
    hot = spark.range(30000).select(
        "id", (F.lit(base) + F.make_interval(secs=(F.col("id") % 3600).cast("int"))).alias("t"))
    spread = spark.range(30000, 90000).select(
        "id", (F.lit(base) + F.make_interval(hours=(F.col("id") % 2000).cast("int"))).alias("t"))
    trips = hot.unionByName(spread).select(
        F.col("t").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("t").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
        F.col("id").cast("string").alias("pickup_zip"), F.sha2(F.col("id").cast("string"), 256).alias("dropoff_zip"),
        (F.col("id") / 7.0).alias("trip_distance"), (F.col("id") / 3.0).alias("fare_amount"))
    raw = spark.range(2000).select(
        (F.lit(base) + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz")
        .alias("datetime"),
        *[F.lit(1.0).alias(c) for c in WEATHER_RAW_SCHEMA.names[1:-1]],
        F.lit(0).alias("weather_code"))
    hours = unique_hours(type_observations(raw))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = join_hours(trips, hours, "left", max_broadcast_rows=100)
        plan = _plan(df)
        assert "SortMergeJoin" in plan and "skew=true" in plan.replace(" ", "")
        assert df.count() == 90000
        assert df.filter("temperature_2m IS NULL").count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_wall_clock_instant_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on this day does not exist in New York (clocks jump forward)
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS t")
        got = df.select(F.unix_micros(wall_clock_instant(F.col("t")))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    want = int(dt.datetime(2024, 3, 10, 2, 30, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    assert got == want


def test_load_observations_from_landing(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    doc = {"latitude": 0.0, "longitude": 0.0, "hourly": {
        "time": ["2022-10-30T04:00", "2022-10-30T05:00"],
        "temperature_2m": [9.5, -4.0], "relative_humidity_2m": [40.0, 99.0],
        "precipitation": [0.0, 8.25], "rain": [0.0, 8.25], "snowfall": [0.0, 0.0],
        "wind_speed_10m": [2.0, 30.75], "weather_code": [2, 65]}}
    with open(os.path.join(landing, "w0.json"), "w") as f:
        json.dump(doc, f)
    out = load_observations(spark, landing, os.path.join(tmp_dir, "weather_hourly"))
    rows = {r.hour: r for r in out.collect()}
    assert rows[4].weather_category == "Partly Cloudy" and rows[5].weather_category == "Rain"
    assert rows[5].is_raining is True and str(rows[4].date) == "2022-10-30"


def test_hour_helpers_are_zone_free_in_dst_gap(spark):
    from ridewx.functions.timecols import format_local_minute, hour_start, ntz_literal
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:45.5' AS t")
        r = df.select(hour_start("t").alias("h"), format_local_minute("t").alias("f"),
                      (F.col("t") > ntz_literal("2024-03-10 02:30:00")).alias("after")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r.h == dt.datetime(2024, 3, 10, 2, 0)
    assert r.f == "2024-03-10T02:30" and r.after is True


def test_cluster_conf_sizes_partitions():
    from ridewx.session import cluster_conf
    # sized by what is shuffled, not by what is read
    conf = cluster_conf(cores=8000, shuffled_bytes=10**12)
    assert int(conf["spark.sql.shuffle.partitions"]) == max(8000, -(-10**12 // (256 << 20)))
    assert int(cluster_conf(cores=8)["spark.sql.shuffle.partitions"]) == 8
    # more than the driver can track is left to larger partitions
    assert int(cluster_conf(cores=8, shuffled_bytes=10**14)["spark.sql.shuffle.partitions"]) == 50_000
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_folder_rules():
    import pytest

    from ridewx.session import checkpoint_dir

    class Conf(dict):
        def get(self, k, default=None):
            return super().get(k, default)

    class Ctx:
        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, master, conf, folder=None):
            self.sparkContext, self.conf = Ctx(master, folder), Conf(conf)

    # configured shared folder is used as is
    s = Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert checkpoint_dir(s) == "hdfs://nn/ckpt"
    # a cluster without one is refused: no machine-local fallback
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session("k8s://api", {}))
    # local mode gets a temporary folder
    assert checkpoint_dir(Session("local[2]", {})).startswith("/")


def test_wide_hour_table_is_not_broadcast(spark, monkeypatch):
    from ridewx.operators import enrich
    wide = spark.range(50).select(F.lit("x" * 1000).alias("note"), "id")
    assert enrich.size_checked(wide, "wide").broadcast
    monkeypatch.setattr(enrich, "MAX_BROADCAST_BYTES", 40_000)
    assert not enrich.size_checked(wide, "wide").broadcast
