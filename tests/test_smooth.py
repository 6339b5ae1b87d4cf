"""Local regression from bin moments against numpy, and fare sketches
against exact ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridewx.operators import stats
from ridewx.plans.catalog import Inputs


def numpy_smooth(x, y, degree, bandwidth=5):
    """Tricube-weighted line through (x, y), read off at ``degree``; weights
    are taken at the middle of each tenth of a degree."""
    away = np.sign(x) * np.floor(np.abs(x) * 10 + 0.5) / 10 - degree
    near = np.abs(away) < bandwidth - 1e-9
    if not near.any() or np.abs(away).min() > 1 + 1e-9:
        return None
    w = (1 - (np.abs(away[near]) / bandwidth) ** 3) ** 3
    design = np.stack([np.ones(near.sum()), x[near] - degree], axis=1) * np.sqrt(w)[:, None]
    return np.linalg.lstsq(design, y[near] * np.sqrt(w), rcond=1e-9)[0][0]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(9)
    groups = {"a": rng.integers(-5000, 5000, 4001), "b": np.array([7]), None: rng.integers(0, 3, 50),
              "c": np.array([-3, 10**6]), "d": rng.integers(0, 10**9, 300)}
    rows = [(g, int(v), int(n)) for g, values in groups.items() for v, n in zip(*np.unique(values, return_counts=True))]
    hist = spark.createDataFrame(rows, "g string, v long, f long")
    for block in (1, 16, 1024):
        shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
        got = {r.g: (r.n, list(r.q)) for r in stats.exact_quantiles(hist, "g", "v", "f", shares, block).collect()}
        assert set(got) == set(groups)
        for g, values in groups.items():
            assert got[g][0] == len(values) and got[g][1] == pytest.approx(np.quantile(values, shares))
    assert stats.exact_quantiles(hist.limit(0), "g", "v", "f").count() == 0


def test_smooth_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = np.round(np.concatenate([rng.normal(8, 7, 3000), rng.uniform(35, 36, 20)]), 2)
    y = np.round(2 + np.sin(x / 4) + rng.normal(0, 0.3, len(x)), 1)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "temperature_2m double, trip_distance double")
    odd = spark.createDataFrame([(None, 1.0), (2.0, None), (None, None)], df.schema)
    got = {r.temperature_degree: r.smooth_distance for r in stats.distance_smooth(df.unionByName(odd)).collect()}
    want = {d: numpy_smooth(x, y, d) for d in range(-60, 80)}
    assert set(got) == {d for d, v in want.items() if v is not None} and 25 < len(got)
    for d, v in got.items():
        assert v == pytest.approx(want[d], abs=2e-4), d


def test_smooth_of_one_temperature_and_of_nothing(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (3.0, 6.0)], "temperature_2m float, trip_distance double")
    assert {r.temperature_degree: r.smooth_distance for r in stats.distance_smooth(df).collect()} == {2: 3.0, 3: 3.0, 4: 3.0}
    assert stats.distance_smooth(df.limit(0)).count() == 0


def test_smooth_sends_bins_not_trips(spark):
    df = spark.range(1000).select(F.lit(3.0).alias("temperature_2m"), (F.col("id") / 10).alias("trip_distance"))
    plan = stats.distance_smooth(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Python" not in plan and "Join" not in plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_sketched_quartiles_keep_their_rank(spark, sf):
    silver = Inputs(spark, f"/root/testdata/{sf}").silver()
    checked = stats.quartile_errors(silver, stats.fare_quartiles(stats.fare_sketches(silver))).collect()
    assert len(checked) >= 7 and all(r.q1_ok and r.median_ok and r.q3_ok for r in checked)


def test_sketches_of_any_dates_merge(spark):
    silver = Inputs(spark, "/root/testdata/sf0.01").silver()
    sketches = stats.fare_sketches(silver)
    some = F.col("pickup_date") < "2024-01-11"
    part = stats.fare_quartiles(sketches.filter(some))
    assert all(r.q1_ok and r.median_ok and r.q3_ok
               for r in stats.quartile_errors(silver.filter(some), part).collect())
    # A sketch's size does not follow its rows.
    widest = sketches.select(F.max(F.length("sketch"))).first()[0]
    assert widest < 64 * stats.SKETCH_K
