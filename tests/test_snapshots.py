"""Snapshots (write, audit, publish), the mergeable gold state, the change
feed and what they give the refresh."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ridewx.operators import metrics
from ridewx.operators.changes import change_feed, date_runs
from ridewx.operators.quality import (
    ExpectationFailed,
    Expectation,
    apply_expectations,
    expect,
    expect_or_drop,
    expect_or_fail,
    quarantine,
    quarantine_report,
)
from ridewx.plans import medallion
from ridewx.plans.catalog import Inputs
from ridewx.sources import snapshots

from tests.conftest import SF_SMALL

LAYERS = (medallion.SILVER, *medallion.GOLD)


def rows(df):
    return sorted(map(str, df.collect()))


def content(layers):
    return {name: rows(layers[name]) for name in LAYERS}


def null_trip(trips):
    first = trips.limit(1).withColumn("tpep_pickup_datetime", F.lit(None).cast("timestamp_ntz"))
    return trips.unionByName(first)


def days(spark, *pairs):
    return spark.createDataFrame([(dt.date(2024, 1, d), v) for d, v in pairs], "day date, v int")


def test_publish_replaces_only_the_named_dates(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, root, "day")
    assert snapshots.publish(spark, snapshots.stage(days(spark, (1, 10), (2, 20), (3, 30)), root, "day", "v")) == 1
    change = snapshots.stage(days(spark, (2, 21), (2, 22)), root, "day", "v")
    before = rows(snapshots.read(spark, root, "day"))  # staged, not published
    assert len(before) == 3
    assert snapshots.publish(spark, change, "2024-01-02", "2024-01-03") == 2
    assert rows(snapshots.read(spark, root, "day").select("v")) == ["Row(v=10)", "Row(v=21)", "Row(v=22)"]
    assert rows(snapshots.read(spark, root, "day", version=1)) == before
    assert snapshots.read(spark, root, "day").columns == ["day", "v"]


def test_a_version_is_published_once(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/t"
    snapshots.publish(spark, snapshots.stage(days(spark, (1, 1)), root, "day", "v"))
    a, b = (snapshots.stage(days(spark, (2, n)), root, "day", "v") for n in (5, 6))
    known = snapshots.versions(spark, root)
    snapshots.publish(spark, a, "2024-01-02", "2024-01-02")
    # A publisher that read the versions before the other one finished.
    monkeypatch.setattr(snapshots, "versions", lambda *_: known)
    with pytest.raises(Exception, match="(?i)exists"):
        snapshots.publish(spark, b, "2024-01-02", "2024-01-02")
    monkeypatch.undo()
    assert rows(snapshots.read(spark, root, "day").select("v")) == ["Row(v=1)", "Row(v=5)"]


def test_empty_tables_and_other_schemas(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    snapshots.publish(spark, snapshots.stage(days(spark).limit(0), root, "day", "v"))
    empty = snapshots.read(spark, root, "day")
    assert empty.count() == 0 and empty.columns == ["day", "v"]
    other = snapshots.stage(days(spark, (1, 1)).withColumn("w", F.lit(1)), root, "day", "v")
    with pytest.raises(ValueError, match="schema"):
        snapshots.publish(spark, other, "2024-01-01", "2024-01-01")


def test_vacuum_keeps_the_newest_snapshots(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    snapshots.publish(spark, snapshots.stage(days(spark, (1, 1), (2, 2)), root, "day", "v"))
    for n in (3, 4):
        snapshots.publish(spark, snapshots.stage(days(spark, (2, n)), root, "day", "v"), "2024-01-02", "2024-01-02")
    snapshots.stage(days(spark, (9, 9)), root, "day", "v")  # never published
    snapshots.vacuum(spark, root, "day", keep=1)
    assert snapshots.versions(spark, root) == [3]
    assert rows(snapshots.read(spark, root, "day").select("v")) == ["Row(v=1)", "Row(v=4)"]
    assert len(os.listdir(f"{root}/data")) == 2


def test_an_interrupted_publisher_is_cleared_away(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    snapshots.publish(spark, snapshots.stage(days(spark, (1, 1)), root, "day", "v"))
    os.makedirs(f"{root}/snapshots/version=2/_temporary/0")
    with pytest.raises(RuntimeError, match="version=2"):
        snapshots.publish(spark, snapshots.stage(days(spark, (1, 2)), root, "day", "v"))
    assert rows(snapshots.read(spark, root, "day").select("v")) == ["Row(v=1)"]
    snapshots.vacuum(spark, root, "day")
    assert snapshots.publish(spark, snapshots.stage(days(spark, (1, 2)), root, "day", "v")) == 2
    assert rows(snapshots.read(spark, root, "day").select("v")) == ["Row(v=2)"]


def test_audit_judges_the_counters(spark, tmp_dir):
    df = days(spark, (1, 1), (2, -1), (3, None))
    checked = apply_expectations(df, [expect_or_fail("positive", "v > 0"), expect("known", "v IS NOT NULL")],
                                 stop=False)
    with pytest.raises(ExpectationFailed, match="not written"):
        snapshots.audit([checked.__class__(checked.df, None, checked.expectations)])
    snapshots.stage(checked.df, f"{tmp_dir}/t", "day", "v")
    with pytest.raises(ExpectationFailed, match="'positive' failed: 2 of 3"):
        snapshots.audit([checked])
    warned = apply_expectations(df, [expect("known", "v IS NOT NULL")], stop=False)
    snapshots.stage(warned.df, f"{tmp_dir}/t", "day", "v")
    assert snapshots.audit([warned], {"known": 0.5}) == {"rows": 3, "known": 1}
    with pytest.raises(ExpectationFailed, match="known"):
        snapshots.audit([warned], {"known": 0.1})


def test_a_failing_load_leaves_readers_on_the_old_rows(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    old = content(medallion.write_all(i.trips, i.weather_raw, tmp_dir))
    for load in (lambda: medallion.write_all(null_trip(i.trips), i.weather_raw, tmp_dir),
                 lambda: medallion.refresh(null_trip(i.trips), i.weather_raw, tmp_dir, "2024-01-03", "2024-01-04"),
                 lambda: medallion.refresh(i.trips, i.weather_raw, tmp_dir, "2024-01-03", "2024-01-04",
                                           max_share={"has_weather_data": 0.01})):
        with pytest.raises(ExpectationFailed):
            load()
        assert {n: rows(medallion.read_layer(spark, tmp_dir, n)) for n in LAYERS} == old


def test_a_fail_check_stops_the_refresh_of_catalog_tables(spark):
    i = Inputs(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS ridewx_audit")
    try:
        old = content(medallion.write_all(i.trips, i.weather_raw, "ridewx_audit"))
        with pytest.raises(Exception, match="valid_pickup_datetime"):
            medallion.refresh(null_trip(i.trips), i.weather_raw, "ridewx_audit", "2024-01-03", "2024-01-04")
        assert rows(spark.table(f"ridewx_audit.{medallion.SILVER}").select(*i.silver().columns)) == old[medallion.SILVER]
    finally:
        spark.sql("DROP DATABASE IF EXISTS ridewx_audit CASCADE")


def test_state_finishes_the_gold_tables(spark):
    silver = Inputs(spark, SF_SMALL).silver()
    odd = silver.limit(5).withColumn("fare_amount", F.lit(None).cast("double")).withColumn(
        "trip_distance", F.lit(float("nan")))
    silver = silver.unionByName(odd)
    state = metrics.gold_state(silver)
    # Rows of one key from several parts add up.
    half = F.xxhash64("tpep_pickup_datetime") % 2 == 0
    parts = metrics.gold_state(silver.filter(half)).unionByName(metrics.gold_state(silver.filter(~half)))
    for finish, whole in ((metrics.summary_from_state, metrics.weather_impact_summary),
                          (metrics.hourly_from_state, metrics.hourly_weather_metrics),
                          (metrics.bands_from_state, metrics.temperature_band_analysis)):
        want = rows(whole(silver))
        assert rows(finish(state)) == want and rows(finish(parts)) == want


def test_refresh_reads_only_its_dates_of_silver(spark, tmp_dir):
    i = Inputs(spark, SF_SMALL)
    medallion.write_all(i.trips, i.weather_raw, tmp_dir)
    out = medallion.refresh(i.trips, i.weather_raw, tmp_dir, "2024-01-03", "2024-01-04")
    read = {f.split("pickup_date=")[1][:10] for f in out["changed_silver"].inputFiles()}
    assert read == {"2024-01-03", "2024-01-04"}
    # Gold is finished from the state alone.
    state_files = out[medallion.STATE].inputFiles()
    assert state_files and all(f"/{medallion.STATE}/" in f for f in state_files)
    assert content(out) == content(medallion.write_all(i.trips, i.weather_raw, f"{tmp_dir}/whole"))


def test_change_feed(spark):
    schema = "d date, h int, t float, c string"
    day = dt.date(2024, 1, 1)
    old = spark.createDataFrame([(day, 1, 1.0, "x"), (day, 2, 2.0, None), (day, 3, None, "y"), (day, 4, 4.0, "z"),
                                 (None, 5, 1.0, "n")], schema)
    new = spark.createDataFrame([(day, 1, 1.0, "x"), (day, 2, 2.0, ""), (day, 3, 3.0, "q"), (day, 6, None, None),
                                 (None, 5, 1.0, "n")], schema)
    got = {(r.h, r.kind, tuple(r.changed)) for r in change_feed(old, new, ["d", "h"]).collect()}
    assert got == {(2, "updated", ("c",)), (3, "updated", ("c", "t")), (4, "deleted", ()), (6, "inserted", ())}
    assert change_feed(old, old, ["d", "h"]).count() == 0
    assert change_feed(old.limit(0), new.limit(0), ["d", "h"]).count() == 0
    with pytest.raises(Exception, match="several rows"):
        change_feed(old.unionByName(old), new, ["d", "h"]).collect()
    added = change_feed(old, new.withColumn("w", F.lit(1)), ["d", "h"])
    assert all("w" in r.changed for r in added.filter("kind = 'updated'").collect())


def test_date_runs(spark):
    d = days(spark, (1, 0), (2, 0), (2, 1), (5, 0), (7, 0), (8, 0))
    assert date_runs(d, "day") == [("2024-01-01", "2024-01-02"), ("2024-01-05", "2024-01-05"),
                                   ("2024-01-07", "2024-01-08")]
    assert date_runs(d.limit(0), "day") == []


def test_refresh_changed_equals_a_full_rebuild(spark, tmp_dir):
    from ridewx.plans.catalog import _new_load, _old_load
    i = Inputs(spark, SF_SMALL)
    base = i.weather_raw.columns
    medallion.write_all(i.trips, _old_load(i).select(*base), f"{tmp_dir}/a")
    first = snapshots.versions(spark, f"{tmp_dir}/a/{medallion.SILVER}")
    out = medallion.refresh_changed(i.trips, _old_load(i), _new_load(i), f"{tmp_dir}/a")
    assert content(out) == content(medallion.write_all(i.trips, _new_load(i).select(*base), f"{tmp_dir}/b"))
    # Nothing changed: nothing is published.
    now = snapshots.versions(spark, f"{tmp_dir}/a/{medallion.SILVER}")
    same = medallion.refresh_changed(i.trips, _new_load(i), _new_load(i), f"{tmp_dir}/a")
    assert content(same) == content(out) and now == snapshots.versions(spark, f"{tmp_dir}/a/{medallion.SILVER}") != first


def test_quarantine_loses_no_row(spark, tmp_dir):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, 3.0), (None, -2.0), (5, None), (6, 200.0)], "id int, fare double")
    checks = [expect_or_fail("has_id", "id IS NOT NULL"), expect_or_drop("fare_ok", "fare >= 0"),
              Expectation("cheap", "fare < 100")]
    good, rejected, checked = quarantine(df, checks, f"{tmp_dir}/q")
    assert rows(good) == ["Row(id=1, fare=5.0)", "Row(id=6, fare=200.0)"]
    assert {(r.id, r.fare): r.violations for r in rejected.collect()} == {
        (2, -1.0): ["fare_ok"], (None, 3.0): ["has_id"], (None, -2.0): ["has_id", "fare_ok"], (5, None): ["fare_ok"]}
    assert checked.metrics() == {"rows": 6, "has_id": 2, "fare_ok": 3, "cheap": 2}
    report = {(r.outcome, r.expectation): r.rows for r in quarantine_report(good, rejected).collect()}
    assert report == {("kept", None): 2, ("rejected", None): 4, ("reason", "has_id"): 2, ("reason", "fare_ok"): 3}
    none = quarantine(df.limit(0), checks, f"{tmp_dir}/none")
    assert [r.rows for r in quarantine_report(*none[:2]).collect()] == [0, 0]
    with pytest.raises(ValueError):
        quarantine(df.withColumn("rejected", F.lit(1)), checks, f"{tmp_dir}/x")
