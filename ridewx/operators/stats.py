"""Distribution statistics: table profile, box-plot statistics and trends.

These replace plots that pulled whole tables to one machine: the numbers
behind them are computed where the data lies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridewx.functions.classify import condition_recode
from ridewx.functions.exact import (
    DISTANCE_PLACES,
    TEMPERATURE_PLACES,
    avg_fine,
    max_exact,
    min_exact,
    scaled,
)

QUARTILES = [0.25, 0.5, 0.75]
WHISKER = 1.5
TREND_DIGITS = 10
# The box plot is over fares in whole cents.
CENTS = 2


def profile_weather(weather: DataFrame) -> DataFrame:
    """Row count, date span and temperature span of observations."""
    return weather.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        min_exact("temperature_2m", TEMPERATURE_PLACES, 1).alias("min_temperature"),
        max_exact("temperature_2m", TEMPERATURE_PLACES, 1).alias("max_temperature"),
    )


def exact_quantiles(hist: DataFrame, group: str, value: str, freq: str, shares: list[float] = QUARTILES,
                    block: int = 1024) -> DataFrame:
    """``group``, ``n`` and ``q`` (linear interpolation, one entry per share)
    from a histogram of whole-number values, without gathering a group's
    histogram in one task. Counts of blocks of ``block`` values are summed up
    first (a row per block); only blocks that hold a wanted rank are then
    summed up value by value."""
    def earlier(*by: str):
        return Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)

    before = F.coalesce(F.sum("m").over(earlier("g", "b")), F.lit(0))
    blocks = (hist.groupBy(F.col(group).alias("g"), F.floor(F.col(value) / block).alias("b")).agg(F.sum(freq).alias("m"))
              .withColumns({"before": before, "n": F.sum("m").over(Window.partitionBy("g"))}))
    # Zero-based ranks on either side of each share's place among n values.
    place = [(F.col("n") - 1) * F.lit(p) for p in shares]
    ranks = [f(x).cast("long") for x in place for f in (F.floor, F.ceil)]
    holds = [(F.col("before") <= r) & (r < F.col("before") + F.col("m")) for r in ranks]
    wanted = blocks.filter(reduce(lambda a, b: a | b, holds)).select("g", "b", "before", "n")
    inside = (hist.select(F.col(group).alias("g2"), F.col(value).alias("v"), F.col(freq).alias("f"),
                          F.floor(F.col(value) / block).alias("b2"))
              .join(wanted, F.col("g2").eqNullSafe(F.col("g")) & (F.col("b2") == F.col("b")))
              .withColumn("at", F.col("before") + F.coalesce(F.sum("f").over(earlier("g", "b", "v")), F.lit(0))))
    found = inside.groupBy("g", "n").agg(*[
        F.max(F.when((F.col("at") <= r) & (r < F.col("at") + F.col("f")), F.col("v"))).alias(f"v{i}")
        for i, r in enumerate(ranks)])
    q = [F.col(f"v{2 * i}") + (F.col(f"v{2 * i + 1}") - F.col(f"v{2 * i}")) * (x - F.floor(x))
         for i, x in enumerate(place)]
    return found.select(F.col("g").alias(group), "n", F.array(*q).alias("q"))


def fare_boxplot(silver: DataFrame) -> DataFrame:
    """Box-plot statistics of fares per weather condition, in one pass.

    The pass builds a histogram: trips per (condition, fare in whole cents).
    It is an ordinary hash aggregate keyed by both, so a condition holding a
    third of all trips is spread over many reducers by fare value, and its
    size is bounded by conditions x distinct fares, not by trips.
    Everything else runs on the histogram:

    - exact quartiles (``exact_quantiles``), reported in cents without
      rounding; fences ``q1 - 1.5 iqr`` and ``q3 + 1.5 iqr``;
    - whiskers (the extreme fares inside the fences) and the outlier count,
      from the histogram joined to its condition's fences. The fence table
      has one row per condition, and conditions are a fixed label set (the
      category labels plus Rain, Snow and NULL) unless the caller's table
      has others, so the planner decides by its size.
    """
    hist = (silver.select(condition_recode().alias("weather_condition"),
                          scaled("fare_amount", CENTS).alias("cents"))
            .filter(F.col("cents").isNotNull())
            .groupBy("weather_condition", "cents").agg(F.count(F.lit(1)).alias("freq")))
    quart = exact_quantiles(hist, "weather_condition", "cents", "freq").withColumnRenamed("n", "trips")
    q1, q3 = F.col("q")[0], F.col("q")[2]
    fences = quart.select(
        F.col("weather_condition").alias("_wc"), "trips",
        q1.alias("q1_cents"), F.col("q")[1].alias("median_cents"), q3.alias("q3_cents"),
        (q1 - (q3 - q1) * WHISKER).alias("lower_fence_cents"),
        (q3 + (q3 - q1) * WHISKER).alias("upper_fence_cents"),
    )
    inside = ((F.col("cents") >= F.col("lower_fence_cents"))
              & (F.col("cents") <= F.col("upper_fence_cents")))
    keys = ["_wc", "trips", "q1_cents", "median_cents", "q3_cents",
            "lower_fence_cents", "upper_fence_cents"]
    return (hist.join(fences, hist["weather_condition"].eqNullSafe(fences["_wc"]))
            .groupBy(*keys)
            .agg((F.min(F.when(inside, F.col("cents"))) / 100.0).alias("lower_whisker"),
                 (F.max(F.when(inside, F.col("cents"))) / 100.0).alias("upper_whisker"),
                 F.coalesce(F.sum(F.when(~inside, F.col("freq"))), F.lit(0).cast("bigint"))
                 .alias("outliers"))
            .withColumnRenamed("_wc", "weather_condition"))


def distance_trend(silver: DataFrame) -> DataFrame:
    """Least-squares line of trip distance on temperature (matched trips)."""
    y = F.col("trip_distance").cast("double")
    x = F.col("temperature_2m").cast("double")
    return silver.agg(
        F.regr_count(y, x).alias("pairs"),
        F.round(F.regr_slope(y, x), TREND_DIGITS).alias("slope"),
        F.round(F.regr_intercept(y, x), TREND_DIGITS).alias("intercept"),
        F.round(F.regr_r2(y, x), TREND_DIGITS).alias("r2"),
    )


BANDWIDTH_DEGREES = 5
SMOOTH_DIGITS = 6


def _moments(x, y) -> list:
    """Exact sums of a bin: rows, x, x * x, y, x * y, as whole numbers."""
    return [F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"),
            F.sum(y).alias("sy"), F.sum(x * y).alias("sxy")]


def distance_smooth(silver: DataFrame, bandwidth: int = BANDWIDTH_DEGREES) -> DataFrame:
    """A smooth curve of trip distance over temperature: at every whole
    degree a line is fitted to the trips within ``bandwidth`` degrees, with
    tricube weights of their distance, and read off there.

    One pass over the trips reduces them to the moments of bins a tenth of a
    degree wide, exact whole numbers that add up map-side; a bin holding a
    third of all trips is one row. Each bin then goes to the degrees it
    reaches, 2 * ``bandwidth`` at most, and every degree solves its own two
    normal equations. A weight is taken at its bin's middle; the trips keep
    their own temperatures otherwise. The bandwidth is fixed in degrees, not
    a share of all trips. Where all weight lies on one temperature, the value
    is the weighted mean. Degrees more than one degree away from any trip are
    left out, and so are trips without temperature or distance."""
    y, x = scaled("trip_distance", DISTANCE_PLACES), scaled("temperature_2m", TEMPERATURE_PLACES)
    unit, middle = 10 ** TEMPERATURE_PLACES, 10 ** (TEMPERATURE_PLACES - 1)
    rows = (silver.select(x.alias("x"), y.alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
            .withColumn("bin", F.round(F.col("x") / middle).cast("bigint")))
    offset = F.col("x") - F.col("bin") * middle
    bins = rows.groupBy("bin").agg(*_moments(offset, F.col("y")))
    # Whole degrees that the bin reaches.
    reach = bins.withColumn("degree", F.explode(F.sequence(
        F.ceil(F.col("bin") / 10 - bandwidth), F.floor(F.col("bin") / 10 + bandwidth))))
    away = (F.col("bin") - F.col("degree") * 10) / 10.0
    u = F.abs(away) / float(bandwidth)
    w = F.pow(F.lit(1.0) - u * u * u, F.lit(3.0))
    t = F.col("sx") / float(unit)
    tt = F.col("sxx") / float(unit) / float(unit)
    v = F.col("sy") / float(10 ** DISTANCE_PLACES)
    tv = F.col("sxy") / float(unit) / float(10 ** DISTANCE_PLACES)
    sums = reach.groupBy(F.col("degree").cast("int").alias("temperature_degree")).agg(
        F.min(F.abs(away)).alias("nearest"), F.sum("n").alias("trips"),
        F.sum(w * F.col("n")).alias("s0"), F.sum(w * (away * F.col("n") + t)).alias("s1"),
        F.sum(w * (away * away * F.col("n") + 2 * away * t + tt)).alias("s2"),
        F.sum(w * v).alias("t0"), F.sum(w * (away * v + tv)).alias("t1")).filter("nearest <= 1.0 AND s0 > 0")
    det = F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1")
    fitted = F.when(det > F.lit(1e-9) * F.col("s0") * F.col("s0"),
                    (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) / det).otherwise(F.col("t0") / F.col("s0"))
    return sums.select("temperature_degree", "trips", F.round(fitted, SMOOTH_DIGITS).alias("smooth_distance"))


#: Size of a fare sketch: ranks err by about 0.3 % of the fares.
SKETCH_K = 1024


def fare_sketches(silver: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Mergeable quantile sketches (KLL) of fares in cents, per pickup date
    and weather condition, with the fares' count: a state of bounded size
    that is kept beside silver and merged over any dates."""
    cents = scaled("fare_amount", CENTS)
    return (silver.select("pickup_date", condition_recode().alias("weather_condition"), cents.alias("cents"))
            .filter("cents IS NOT NULL").groupBy("pickup_date", "weather_condition")
            .agg(F.count(F.lit(1)).alias("trips"), F.kll_sketch_agg_bigint("cents", F.lit(k)).alias("sketch")))


def fare_quartiles(sketches: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Approximate quartiles of fares in cents per condition, from any set
    of ``fare_sketches``; each is a fare that occurs, and its rank is off by
    a small share (0.3 % of the fares or so at ``SKETCH_K``). ``fare_boxplot``
    is the exact form."""
    merged = sketches.groupBy("weather_condition").agg(
        F.sum("trips").alias("trips"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch"))
    q = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(p) for p in QUARTILES]))
    return merged.withColumn("q", q).select(
        "weather_condition", "trips", F.col("q")[0].alias("q1_cents"), F.col("q")[1].alias("median_cents"),
        F.col("q")[2].alias("q3_cents"))


RANK_ERROR = 0.01


def quartile_errors(silver: DataFrame, quartiles: DataFrame, error: float = RANK_ERROR) -> DataFrame:
    """Per condition the trips, and for each approximate quartile whether its
    rank among all fares lies within ``error`` of the share it stands for.
    One pass over the trips counts the fares below and up to each value; the
    quartiles have one row per condition."""
    cents = scaled("fare_amount", CENTS)
    fares = silver.select(condition_recode().alias("_wc"), cents.alias("cents")).filter("cents IS NOT NULL")
    joined = fares.join(quartiles.drop("trips"), F.col("_wc").eqNullSafe(F.col("weather_condition")))
    names = ["q1", "median", "q3"]
    counts = joined.groupBy("_wc").agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.count_if(F.col("cents") < F.col(f"{q}_cents")).alias(f"{q}_below") for q in names],
        *[F.count_if(F.col("cents") <= F.col(f"{q}_cents")).alias(f"{q}_upto") for q in names])
    ok = [((F.col(f"{q}_below") <= (F.lit(p) + error) * F.col("trips"))
           & (F.col(f"{q}_upto") >= (F.lit(p) - error) * F.col("trips"))).alias(f"{q}_ok")
          for q, p in zip(names, QUARTILES)]
    return counts.select(F.col("_wc").alias("weather_condition"), "trips", *ok)


def distance_by_degree(silver: DataFrame) -> DataFrame:
    """Average distance per whole degree of temperature."""
    degree = F.floor(F.col("temperature_2m").cast("double")).cast("int")
    return (silver.filter(F.col("temperature_2m").isNotNull())
            .groupBy(degree.alias("temperature_degree"))
            .agg(F.count(F.lit(1)).alias("trip_count"),
                 avg_fine("trip_distance", DISTANCE_PLACES, 2).alias("avg_distance")))
