import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ridewx.session import RECOMMENDED_CONF

    builder = (SparkSession.builder.master("local[*]")
               .appName("ridewx-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ridewx-wh-")))
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only when none is configured.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get(
            "spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ridewx-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ridewx-test-")


@pytest.fixture(scope="session")
def fixture_trips(spark):
    from pyspark.sql import functions as F

    from ridewx.sources.tables import read_fixture

    df = read_fixture(spark, os.path.join(FIXTURES, "trips.json"))
    return df.select(
        F.to_timestamp_ntz("pickup_datetime").alias("tpep_pickup_datetime"),
        F.to_timestamp_ntz("dropoff_datetime").alias("tpep_dropoff_datetime"),
        "pickup_zip", "dropoff_zip",
        F.col("trip_distance").cast("double").alias("trip_distance"),
        F.col("fare_amount").cast("double").alias("fare_amount"),
    )


@pytest.fixture(scope="session")
def fixture_weather_raw(spark):
    from ridewx.schemas import WEATHER_RAW_SCHEMA
    from ridewx.sources.tables import read_fixture

    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "datetime" else f.dataType)
        for f in WEATHER_RAW_SCHEMA.fields])
    df = read_fixture(spark, os.path.join(FIXTURES, "weather.json"), text_schema)
    return df.withColumn("datetime", F.to_timestamp_ntz("datetime"))
