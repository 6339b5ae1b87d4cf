from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridewx.functions.exact import avg_exact, max_exact, min_exact, round_scaled, sum_exact


def half_up(x: Decimal, places: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def test_tie_rounds_away_from_zero(spark):
    df = spark.createDataFrame([(27.0,), (27.25,)], "v double")  # mean 27.125
    row = df.agg(avg_exact("v", 2, 2).alias("a"), sum_exact("v", 2).alias("s")).first()
    assert row.a == 27.13 and row.s == 54.25
    neg = spark.createDataFrame([(-27.0,), (-27.25,)], "v double")
    assert neg.agg(avg_exact("v", 2, 2)).first()[0] == -27.13


def test_float_measure_scaled_from_its_decimal_form(spark):
    df = spark.createDataFrame([(3.1,), (3.5,)], "v float")  # 3.0999999046 as float
    row = df.agg(avg_exact("v", 2, 1).alias("a"), min_exact("v", 2, 1).alias("mn"),
                 max_exact("v", 2, 1).alias("mx")).first()
    assert (row.a, row.mn, row.mx) == (3.3, 3.1, 3.5)


def test_empty_and_null_groups(spark):
    df = spark.createDataFrame([(None,)], "v double")
    row = df.agg(avg_exact("v", 2, 2).alias("a"), sum_exact("v", 2).alias("s")).first()
    assert row.a is None and row.s is None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=30))
def test_mean_matches_decimal_half_up(spark, cents):
    df = spark.createDataFrame([(c / 100.0,) for c in cents], "v double")
    got = df.agg(avg_exact("v", 2, 2)).first()[0]
    want = half_up(Decimal(sum(cents)) / Decimal(100 * len(cents)), 2)
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.integers(min_value=-10**12, max_value=10**12))
def test_round_scaled_matches_decimal(spark, v):
    got = spark.range(1).select(round_scaled(F.lit(v), 2, 1)).first()[0]
    assert got == half_up(Decimal(v) / 100, 1)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(min_value=-10**7, max_value=10**7), min_size=1, max_size=25),
       st.sampled_from([(2, 2), (2, 1), (1, 2), (0, 2)]))
def test_spark_and_oracle_rounding_agree(spark, values, places):
    import duckdb

    from ridewx.functions.exact import mean_half_up, round_scaled
    from ridewx.plans import oracle
    in_p, out_p = places
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = df.agg(mean_half_up(F.sum("v"), F.count("v"), in_p, out_p).alias("m"),
                 round_scaled(F.min("v"), 2, 1).alias("r")).first()
    rows = ", ".join(f"({v})" for v in values)
    sql = (f"SELECT {oracle.mean('sum(v)', 'count(v)', in_p, out_p)} AS m, "
           f"{oracle.rnd('min(v)', 2, 1)} AS r FROM (VALUES {rows}) t(v)")
    want = duckdb.sql(sql).fetchall()[0]
    assert (got.m, got.r) == want


def test_inputs_are_rounded_once_and_nan_does_not_abort(spark):
    from ridewx.functions.exact import MONEY_PLACES, TEMPERATURE_PLACES

    df = spark.createDataFrame([(0.005, 2.449), (0.003, 2.449), (float("nan"), None)], "fare double, t double")
    r = df.agg(avg_exact("fare", MONEY_PLACES, 2).alias("f"), avg_exact("t", TEMPERATURE_PLACES, 1).alias("t"),
               sum_exact("fare", MONEY_PLACES, 2).alias("s")).first()
    assert (r.f, r.t, r.s) == (0.0, 2.4, 0.01)


def test_digits_behind_the_fourth_place_count(spark):
    from ridewx.functions.exact import MONEY_PLACES, avg_fine, sum_fine

    def of(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return tuple(df.agg(avg_fine("x", MONEY_PLACES, 2).alias("a"), sum_fine("x", MONEY_PLACES, 2).alias("s")).first())

    assert of(0.00499999) == (0.0, 0.0) and of(0.00500001) == (0.01, 0.01)
    assert of(27.12, 27.13) == (27.13, 54.25) and of(-27.12, -27.13) == (-27.13, -54.25)
    assert of(0.00004, 0.00004, 0.00007) == (0.0, 0.0) and of(*[0.00004] * 125) == (0.0, 0.01)
    assert of(5.0, None, float("nan")) == (5.0, 5.0) and of(None) == (None, None)
    assert of(9e14, -9e14, 1.005) == (0.34, 1.01)


def test_fine_sums_add_up_in_parts(spark):
    from ridewx.functions.exact import fine_sums, mean_fine

    df = spark.range(1000).selectExpr("id % 7 AS part", "(id * 7919 % 100003) / 30011.0 AS x")
    names = ("s", "r", "n")
    part = df.groupBy("part").agg(*[c.alias(n) for c, n in zip(fine_sums("x", 4), names)])
    whole = df.agg(mean_fine(*fine_sums("x", 4), 4, 2)).first()[0]
    assert part.agg(mean_fine(F.sum("s"), F.sum("r"), F.sum("n"), 4, 2)).first()[0] == whole
    exact = sum((i * 7919 % 100003) / 30011.0 for i in range(1000)) / 1000
    assert whole == pytest.approx(exact, abs=0.00501)
