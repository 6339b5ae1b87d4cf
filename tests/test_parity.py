"""Every catalog query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from ridewx.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events",):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["weather_category", "trip_count", "avg_fare", "avg_distance",
                          "avg_temperature", "total_revenue"]
    assert sum(r.trip_count for r in rows) == 726 and len(rows) == 11


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(_norm(x) for x in r) for r in df.collect()]
    rel = con.sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert sorted(srows, key=_key) == sorted(drows, key=_key)


ZONE_SENSITIVE = ["sample_trips", "ingest_hourly", "stream_hourly_metrics", "hourly_weather_metrics",
                  "plan_windows", "enrich_daily"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = entry_mod.queries()[name](spark, SF_SMALL)
        srows = [tuple(_norm(x) for x in r) for r in df.collect()]
        cols = df.columns
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = con.sql(entry_mod.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert sorted(srows, key=_key) == sorted(drows, key=_key)


MULTI_TASK = ["weather_impact_summary", "unique_hours", "fare_boxplot", "sample_trips",
              "expect_warn_report", "ingest_hourly", "stream_hourly_metrics"]


@pytest.fixture(scope="module")
def split_dir(spark):
    import tempfile
    root = tempfile.mkdtemp(prefix="ridewx-split-")
    (spark.read.parquet(os.path.join(SF_SMALL, "events.parquet")).repartition(4)
     .write.parquet(os.path.join(root, "events.parquet")))
    return root


@pytest.mark.parametrize("name", MULTI_TASK)
def test_query_on_many_files_matches_oracle(spark, con, split_dir, name):
    df = entry_mod.queries()[name](spark, split_dir)
    assert len(df.inputFiles()) >= 1
    srows = [tuple(_norm(x) for x in r) for r in df.collect()]
    rel = con.sql(entry_mod.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in df.columns]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert sorted(srows, key=_key) == sorted(drows, key=_key)


def test_oracles_run_with_every_driver_view_registered():
    tables = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
    c = duckdb.connect()
    for t in tables:
        path = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(path):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    for name, sql in entry_mod.oracle_sql().items():
        rel = c.sql(sql)
        assert rel.columns, name
        rel.fetchall()
