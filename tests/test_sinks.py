import os

import pytest

from ridewx.plans import medallion
from ridewx.plans.catalog import Inputs
from ridewx.sources.sinks import write_clustered, write_table
from ridewx.sources.tables import read_table

from tests.conftest import SF_SMALL


def test_write_table_overwrites(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    write_table(spark.range(3), path)
    write_table(spark.range(5), path)
    assert read_table(spark, path).count() == 5


def test_clustered_write_prunes_partitions(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "w")
    write_clustered(i.weather(), path, "date", "datetime")
    back = spark.read.parquet(path)
    assert back.count() == 201
    one_day = back.filter("date = DATE'2024-01-02'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one_day.count() == back.filter("date = DATE'2024-01-02'").count()


def test_build_graph_lazily(spark):
    i = Inputs(spark, SF_SMALL)
    layers = medallion.build(i.trips, i.weather_raw)
    assert set(layers.frames) >= {"weather_hourly", "taxi_weather_joined",
                                  "weather_impact_summary", "hourly_weather_metrics",
                                  "temperature_band_analysis"}
    # Nothing has run yet: counters are empty, not waited for.
    assert layers.checks["taxi_weather_joined"][0].metrics(wait=0.1) == {}
    assert layers["taxi_weather_joined"].count() == 726


def test_write_all_layers(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    layers = medallion.write_all(i.trips, i.weather_raw, tmp_dir)
    assert layers["taxi_weather_joined"].count() == 726
    assert sum(r.trip_count for r in layers["weather_impact_summary"].collect()) == 726
    m = layers.expectation_metrics()
    assert m["taxi_weather_joined"]["valid_fare"] == 73
    # counted on the joined rows before the drop: 600 of 799 trips lack weather
    assert m["taxi_weather_joined"]["rows"] == 799
    assert m["taxi_weather_joined"]["has_weather_data"] == 600
    assert m["weather_hourly"]["reasonable_temperature"] == 35


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def test_refresh_replaces_only_its_dates(spark, tmp_dir):
    from pyspark.sql import functions as F
    i = Inputs(spark, SF_SMALL)
    root = os.path.join(tmp_dir, "layers")
    medallion.write_all(i.trips.withColumn("fare_amount", F.col("fare_amount") + 1), i.weather_raw, root)
    before = _files(f"{root}/taxi_weather_joined")
    out = medallion.refresh(i.trips, i.weather_raw, root, "2024-01-03", "2024-01-04")
    after = _files(f"{root}/taxi_weather_joined")
    dates = {p.split("pickup_date=")[1][:10] for p in before.keys() ^ after.keys()}
    assert dates == {"2024-01-03", "2024-01-04"}
    assert all(after[p] == t for p, t in before.items() if p in after)
    silver, day = out["taxi_weather_joined"], F.col("pickup_date").between("2024-01-03", "2024-01-04")
    right = i.silver()
    fares = lambda df: sorted(r.fare_amount for r in df.select("fare_amount").collect())
    assert fares(silver.filter(day)) == fares(right.filter(day))
    assert silver.columns == right.columns
    # Elsewhere the old fares, one higher, which also keeps more trips.
    assert silver.filter(~day).count() >= right.filter(~day).count()
    assert sum(r.trip_count for r in out["weather_impact_summary"].collect()) == silver.count()
    # Bronze has no date folders.
    assert not [p for p in _files(f"{root}/weather_hourly") if "date=" in p]


@pytest.mark.parametrize("as_table", [False, True])
def test_refresh_empties_dates_that_lose_all_trips(spark, tmp_dir, as_table):
    from pyspark.sql import functions as F
    i = Inputs(spark, SF_SMALL)
    day = F.to_date("tpep_pickup_datetime")
    # One date withdrawn, one whose fares now all fail the drop check.
    late = (i.trips.filter(day != F.lit("2024-01-03").cast("date"))
            .withColumn("fare_amount", F.when(day == F.lit("2024-01-04").cast("date"), -1.0)
                        .otherwise(F.col("fare_amount"))))
    root, whole = ("ridewx_lost", "ridewx_whole") if as_table else (f"{tmp_dir}/lost", f"{tmp_dir}/whole")
    content = lambda layers: {n: sorted(map(str, layers[n].collect())) for n in (
        "taxi_weather_joined", "weather_impact_summary", "hourly_weather_metrics", "temperature_band_analysis")}
    try:
        if as_table:
            for name in (root, whole):
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
        old = medallion.write_all(i.trips, i.weather_raw, root)["taxi_weather_joined"]
        assert {str(r[0]) for r in old.select("pickup_date").distinct().collect()} >= {"2024-01-03", "2024-01-04"}
        want = content(medallion.write_all(late, i.weather_raw, whole))
        # The range also holds dates that keep their trips.
        for _ in range(2):
            assert content(medallion.refresh(late, i.weather_raw, root, "2024-01-03", "2024-01-05")) == want
        # No date is left, then all come back.
        gone = medallion.refresh(late.limit(0), i.weather_raw, root, "2000-01-01", "2100-01-01")
        assert not any(content(gone).values())
        assert content(medallion.refresh(late, i.weather_raw, root, "2000-01-01", "2100-01-01")) == want
    finally:
        if as_table:
            for name in (root, whole):
                spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_layers_as_catalog_tables(spark):
    i = Inputs(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS ridewx_layers")
    try:
        medallion.write_all(i.trips.limit(0), i.weather_raw, "ridewx_layers")
        assert spark.table("ridewx_layers.taxi_weather_joined").count() == 0
        medallion.write_all(i.trips, i.weather_raw, "ridewx_layers")
        assert spark.table("ridewx_layers.taxi_weather_joined").count() == 726
        out = medallion.refresh(i.trips, i.weather_raw, "ridewx_layers", "2024-01-02", "2024-01-02")
        assert out["taxi_weather_joined"].count() == 726
        assert sorted(map(str, out["taxi_weather_joined"].collect())) == sorted(map(str, i.silver().collect()))
    finally:
        spark.sql("DROP DATABASE IF EXISTS ridewx_layers CASCADE")


def test_catalog_tables_by_qualified_name(spark):
    from ridewx.sources.tables import use_namespace
    spark.sql("CREATE DATABASE IF NOT EXISTS ridewx_test")
    use_namespace(spark, "spark_catalog", "ridewx_test")
    try:
        write_table(spark.range(4), "trips_t")  # current-schema name
        assert read_table(spark, "spark_catalog.ridewx_test.trips_t").count() == 4
        write_table(spark.range(2), "ridewx_test.trips_t")  # qualified overwrite
        assert read_table(spark, "trips_t").count() == 2
    finally:
        use_namespace(spark, "spark_catalog", "default")
        spark.sql("DROP DATABASE IF EXISTS ridewx_test CASCADE")


def test_release_scratch_removes_app_folder(spark):
    from ridewx.session import materialize, release_scratch, scratch_root
    root = scratch_root(spark)
    df = materialize(spark.range(3), "tmp_release")
    assert df.count() == 3
    local = root.replace("file:", "")
    assert os.path.isdir(local)
    assert release_scratch(spark)
    assert not os.path.exists(local)


def test_clustered_write_splits_a_hot_date(spark, tmp_dir):
    from pyspark.sql import functions as F
    hot = spark.range(60000).select(F.lit("2024-01-01").cast("date").alias("d"),
                                    F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    cold = spark.range(2000).select(F.lit("2024-01-02").cast("date").alias("d"),
                                    F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    df = hot.unionByName(cold).withColumn("t", F.col("id"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        path = os.path.join(tmp_dir, "c")
        write_clustered(df, path, "d", "t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = [f for f in os.listdir(os.path.join(path, "d=2024-01-01")) if f.endswith(".parquet")]
    cold_files = [f for f in os.listdir(os.path.join(path, "d=2024-01-02")) if f.endswith(".parquet")]
    assert len(hot_files) > 1 and len(cold_files) >= 1
    assert spark.read.parquet(path).count() == 62000
