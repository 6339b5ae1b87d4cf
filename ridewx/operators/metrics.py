"""Gold aggregates over the enriched trips.

Each is one ``groupBy().agg()``: partial aggregation on the map side, so
a category or hour holding a third of all trips still ships one partial
row per task. Money, distance and temperature averages are exact HALF_UP
(see ``functions.exact``). Sorting is a presentation step (``ordered``),
as a stored table has no order.

``gold_state`` holds what the three gold tables need of the trips of each
date, in a form that adds up: counts and exact integer sums per hour and
its conditions. ``*_from_state`` finish a gold table from any set of such
rows, so a change of some dates costs only these dates' trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridewx.functions.classify import band_order, classify_code_coarse, temperature_band
from ridewx.functions.exact import (
    DISTANCE_PLACES,
    FINE,
    MONEY_PLACES,
    TEMPERATURE_PLACES,
    avg_exact,
    avg_fine,
    fine_sums,
    joined_sum,
    max_exact,
    mean_fine,
    mean_half_up,
    min_exact,
    scaled,
    sum_fine,
    total_fine,
)


def _trip_count():
    return F.count(F.lit(1)).alias("trip_count")


def _avg_fare():
    return avg_fine("fare_amount", MONEY_PLACES, 2).alias("avg_fare")


def _avg_distance():
    return avg_fine("trip_distance", DISTANCE_PLACES, 2).alias("avg_distance")


def _revenue():
    return sum_fine("fare_amount", MONEY_PLACES, 2).alias("total_revenue")


def weather_impact_summary(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per weather category: trips, average fare, distance, temperature and
    revenue. Trips without an observation form the NULL category."""
    out = silver.groupBy("weather_category").agg(
        _trip_count(), _avg_fare(), _avg_distance(),
        avg_exact("temperature_2m", TEMPERATURE_PLACES, 1).alias("avg_temperature"),
        _revenue(),
    )
    return out.orderBy(F.desc("trip_count")) if ordered else out


def hourly_weather_metrics(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """Per pickup hour and its observed conditions."""
    out = silver.groupBy(
        "pickup_date", "pickup_hour", "weather_category", "temperature_2m",
        "is_raining", "is_snowing",
    ).agg(_trip_count(), _avg_fare(), _revenue(), _avg_distance())
    return out.orderBy("pickup_date", "pickup_hour") if ordered else out


def temperature_band_analysis(silver: DataFrame, ordered: bool = True,
                              null_band: str | None = None) -> DataFrame:
    """Per temperature band. By default a trip without an observation is
    counted in the top band, as the reference does; ``null_band`` names a
    band of its own instead."""
    out = silver.withColumn(
        "temperature_band", temperature_band("temperature_2m", null_band)
    ).groupBy("temperature_band").agg(
        _trip_count(), _avg_fare(), _avg_distance(),
        min_exact("temperature_2m", TEMPERATURE_PLACES, 1).alias("min_temp"),
        max_exact("temperature_2m", TEMPERATURE_PLACES, 1).alias("max_temp"),
    )
    return out.orderBy(F.col("min_temp").asc(),
                       band_order("temperature_band")) if ordered else out


STATE_KEYS = ["pickup_date", "pickup_hour", "weather_category", "temperature_2m", "is_raining", "is_snowing"]


def gold_state(silver: DataFrame) -> DataFrame:
    """Mergeable state of the gold tables: per pickup hour and its observed
    conditions the trips, and the counts and sums of known fares and
    distances (``exact.fine_sums``). Rows of one key add up."""
    named = [column.alias(name) for measure, places, names in (
        ("fare_amount", MONEY_PLACES, ("fare_sum", "fare_rest", "fares")),
        ("trip_distance", DISTANCE_PLACES, ("distance_sum", "distance_rest", "distances")))
        for column, name in zip(fine_sums(measure, places), names)]
    return silver.groupBy(*STATE_KEYS).agg(F.count(F.lit(1)).alias("trips"), *named)


def _of_state() -> dict:
    return {"trip_count": F.sum("trips"),
            "avg_fare": mean_fine(F.sum("fare_sum"), F.sum("fare_rest"), F.sum("fares"), MONEY_PLACES, 2),
            "avg_distance": mean_fine(F.sum("distance_sum"), F.sum("distance_rest"), F.sum("distances"),
                                      DISTANCE_PLACES, 2),
            "total_revenue": total_fine(F.sum("fare_sum"), F.sum("fare_rest"), MONEY_PLACES, 2)}


def _finished(state: DataFrame, keys: list[str], columns: list[str], **more) -> DataFrame:
    known = {**_of_state(), **more}
    return state.groupBy(*keys).agg(*[known[c].alias(c) for c in columns])


def summary_from_state(state: DataFrame) -> DataFrame:
    """``weather_impact_summary`` of the trips behind ``state``. All trips of
    a state row share their temperature."""
    t = scaled("temperature_2m", TEMPERATURE_PLACES)
    mean = mean_half_up(F.sum(t * F.col("trips")), F.sum(F.when(t.isNotNull(), F.col("trips"))),
                        TEMPERATURE_PLACES, 1)
    return _finished(state, ["weather_category"],
                     ["trip_count", "avg_fare", "avg_distance", "avg_temperature", "total_revenue"],
                     avg_temperature=mean)


def hourly_from_state(state: DataFrame) -> DataFrame:
    """``hourly_weather_metrics`` of the trips behind ``state``."""
    return _finished(state, STATE_KEYS, ["trip_count", "avg_fare", "total_revenue", "avg_distance"])


def bands_from_state(state: DataFrame, null_band: str | None = None) -> DataFrame:
    """``temperature_band_analysis`` of the trips behind ``state``."""
    return _finished(state.withColumn("temperature_band", temperature_band("temperature_2m", null_band)),
                     ["temperature_band"], ["trip_count", "avg_fare", "avg_distance", "min_temp", "max_temp"],
                     min_temp=min_exact("temperature_2m", TEMPERATURE_PLACES, 1),
                     max_temp=max_exact("temperature_2m", TEMPERATURE_PLACES, 1))


def explore_summary(silver: DataFrame, ordered: bool = True) -> DataFrame:
    """The exploration's summary: coarse category, trips counted by known
    fares, everything rounded to two places; trips without an observation
    are left out (a NULL group key is dropped)."""
    cat = classify_code_coarse("weather_code", null_label=None)
    out = (silver.withColumn("weather_category", cat)
           .filter(F.col("weather_category").isNotNull())
           .groupBy("weather_category").agg(
               _avg_fare(),
               F.count("fare_amount").alias("trip_count"),
               _avg_distance(),
               avg_exact("temperature_2m", TEMPERATURE_PLACES, 2).alias("avg_temp"),
           ))
    return out.orderBy(F.desc("trip_count")) if ordered else out


def category_counts(weather: DataFrame, coarse: bool = True, ordered: bool = True) -> DataFrame:
    """Observations per category (value counts)."""
    cat = (classify_code_coarse("weather_code", null_label=None) if coarse
           else F.col("weather_category"))
    out = weather.groupBy(cat.alias("weather_category")).agg(
        F.count(F.lit(1)).alias("observations"))
    return out.orderBy(F.desc("observations"), "weather_category") if ordered else out


def _ratio_half_up(num, den, places: int):
    """HALF_UP of num/den (den > 0) to ``places``, exact, as a double."""
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n) * (2 * 10 ** places) + d, d * 2)
    return F.when(den > 0, F.signum(n) * q / float(10 ** places))


def condition_compare(silver: DataFrame, base: str = "Clear", other: str = "Rain") -> DataFrame:
    """Average fare under two conditions (coarse categories), their
    difference and the percent change, in one pass."""
    cat = classify_code_coarse("weather_code", null_label=None)
    known = silver.select(cat.alias("c"), F.col("fare_amount"))
    of = lambda name: F.when(F.col("c") == name, F.col("fare_amount"))
    base_sums, other_sums = fine_sums(of(base), MONEY_PLACES), fine_sums(of(other), MONEY_PLACES)
    sums = known.agg(base_sums[2].alias("nb"), joined_sum(*base_sums[:2]).alias("sb"),
                     other_sums[2].alias("no"), joined_sum(*other_sums[:2]).alias("so"))
    nb, sb, no, so = (F.col(c) for c in ("nb", "sb", "no", "so"))
    places = MONEY_PLACES + FINE
    # other/no - base/nb = (so*nb - sb*no) / (no*nb), in scaled units
    diff_num = so * nb - sb * no
    valid = (nb > 0) & (no > 0)
    return sums.select(
        F.lit(base).alias("base_condition"),
        F.lit(other).alias("other_condition"),
        nb.alias("base_trips"),
        no.alias("other_trips"),
        _ratio_half_up(sb, nb.cast("decimal(38,0)") * 10 ** places, 2).alias("base_avg_fare"),
        _ratio_half_up(so, no.cast("decimal(38,0)") * 10 ** places, 2).alias("other_avg_fare"),
        F.when(valid, _ratio_half_up(diff_num, no.cast("decimal(38,0)") * nb * 10 ** places, 2))
        .alias("fare_difference"),
        F.when(valid & (sb != 0),
               _ratio_half_up(diff_num * 100 * F.signum(sb).cast("int"),
                              F.abs(sb).cast("decimal(38,0)") * no, 1))
        .alias("pct_change"),
    )


def rainy_day_ridership(trips: DataFrame, hours: DataFrame,
                        time_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Do rainy days have more trips? A day is rainy when any of its hours
    saw rain, with or without a trip in that hour; days with trips but no
    observation form the NULL class. Both sides are counted per day before
    they are joined."""
    rain = hours.groupBy(F.col("date").alias("weather_date")).agg(F.bool_or("is_raining").alias("rainy_day"))
    per_day = (trips.groupBy(F.to_date(F.col(time_col)).alias("pickup_date"))
               .agg(F.count(F.lit(1)).alias("trips"))
               .join(rain, F.col("pickup_date") == F.col("weather_date"), "left"))
    return per_day.groupBy("rainy_day").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("trips").alias("total_trips"),
        mean_half_up(F.sum("trips"), F.count(F.lit(1)), 0, 2).alias("avg_trips_per_day"),
    )
