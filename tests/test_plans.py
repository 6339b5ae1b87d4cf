"""Physical-plan properties that matter at scale."""

import contextlib
import datetime as dt
import io

from ridewx.functions.timecols import between_inclusive, within_days
from ridewx.operators import metrics
from ridewx.plans.catalog import QUERIES, Inputs

from tests.conftest import SF_SMALL


def _explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _plan(df) -> str:
    df.collect()  # final adaptive plan
    return _explain(df)


def _initial_plan(df) -> str:
    return _explain(df)


def test_scan_pushes_filter_and_prunes_columns(spark):
    i = Inputs(spark, SF_SMALL)
    plan = _initial_plan(i.checked_trips().select("fare_amount"))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in plan
    # user_id, event_id and props are never read for a fare-only projection
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_expectation_barrier_sits_between_fail_and_drop(spark):
    plan = _initial_plan(QUERIES["expect_drop"](spark, SF_SMALL))
    assert "CollectMetrics" in plan
    # the drop predicate stays above the counters: not pushed into the scan
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert pushed and not any("GreaterThanOrEqual" in ln for ln in pushed)


def test_unique_hours_aggregates_map_side(spark):
    plan = _initial_plan(QUERIES["unique_hours"](spark, SF_SMALL))
    # staged rows are fixed-width: min_by on one row key hash-aggregates,
    # partial (map side) + final, never a window or a sort
    assert "Window" not in plan and "SortAggregate" not in plan
    assert plan.count("HashAggregate (") >= 2


def test_silver_join_is_broadcast(spark):
    plan = _initial_plan(Inputs(spark, SF_SMALL).silver())
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan


def test_gold_aggregate_is_partial_and_prunes_its_scan(spark):
    df = metrics.weather_impact_summary(Inputs(spark, SF_SMALL).silver(), ordered=False)
    plan = _initial_plan(df)
    assert "partial_count" in plan and "partial_sum" in plan
    # four event columns for the flagship, and no copy of silver
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in plan
    assert "/taxi_weather_joined" not in plan


def test_boxplot_fences_are_joined_by_their_size(spark):
    # no hint: the join is planned as a sort-merge join and becomes a
    # broadcast one when the fences turn out small
    final, initial = _plan(QUERIES["fare_boxplot"](spark, SF_SMALL)).split("Initial Plan")[:2]
    assert "BroadcastHashJoin Inner" in final


def test_no_python_udf_anywhere(spark):
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = _initial_plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_null_weather_group_kept_in_summary_dropped_in_explore(spark):
    silver = Inputs(spark, SF_SMALL).silver()
    a1 = {r.weather_category for r in metrics.weather_impact_summary(silver).collect()}
    a4 = {r.weather_category for r in metrics.explore_summary(silver).collect()}
    assert None in a1 and None not in a4


def test_between_keeps_midnight_bound(spark):
    rows = [(dt.datetime(2023, 6, 30, 0, 0),), (dt.datetime(2023, 6, 30, 9, 0),),
            (dt.datetime(2023, 6, 1, 0, 0),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert df.filter(between_inclusive("t", "2023-06-01", "2023-06-30")).count() == 2
    assert df.filter(within_days("t", "2023-06-01", "2023-06-30")).count() == 3



def test_sample_is_a_top_k_with_pushed_bounds(spark):
    plan = _initial_plan(QUERIES["sample_trips"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(ts,2024-01-01" in plan
