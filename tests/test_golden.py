"""Golden results, worked out by hand, for the 13 trips and 10 observations
of ``fixtures/``: every class, the class "Other", all six bands and one trip
without an observation."""

import pytest

from ridewx.operators import metrics
from ridewx.operators.enrich import check_trips, enrich_hourly
from ridewx.operators.observations import bronze_weather, hours_of, unique_hours
from ridewx.operators.quality import match_rate


@pytest.fixture(scope="module")
def silver(fixture_trips, fixture_weather_raw):
    hours = unique_hours(bronze_weather(fixture_weather_raw).df)
    out, checks = enrich_hourly(fixture_trips, hours)
    return out.cache(), checks


def test_bronze_typing(fixture_weather_raw):
    rows = {r.hour: r for r in bronze_weather(fixture_weather_raw).df.collect()}
    assert [rows[h].weather_category for h in sorted(rows)] == [
        "Snow", "Foggy", "Drizzle", "Partly Cloudy", "Clear", "Rain", "Rain Showers",
        "Thunderstorm", "Snow Showers", "Other"]
    assert [h for h in sorted(rows) if rows[h].is_raining] == [8, 15, 17, 18]
    assert [h for h in sorted(rows) if rows[h].is_snowing] == [6, 22]
    assert rows[7].temperature_2m == 4.25


def test_silver_keeps_every_trip(silver):
    df, checks = silver
    assert df.count() == 13
    assert len(df.columns) == 18
    m = {k: v for c in checks for k, v in c.metrics().items()}
    assert m["valid_fare"] == 0 and m["has_weather_data"] == 1


def test_weather_impact_summary(silver):
    got = {r.weather_category: tuple(r)[1:] for r in metrics.weather_impact_summary(silver[0]).collect()}
    assert got == {
        "Snow": (2, 11.25, 2.0, -7.5, 22.5),
        "Foggy": (1, 21.25, 5.5, 4.3, 21.25),
        "Drizzle": (1, 18.0, 4.25, 12.0, 18.0),
        "Partly Cloudy": (1, 6.0, 0.75, 18.0, 6.0),
        "Clear": (2, 17.0, 4.0, 21.5, 34.0),
        "Rain": (1, 30.5, 7.5, 26.8, 30.5),
        "Rain Showers": (1, 13.75, 3.25, 30.0, 13.75),
        "Thunderstorm": (1, 12.0, 2.5, 33.5, 12.0),
        "Snow Showers": (1, 9.0, 1.5, -1.0, 9.0),
        "Other": (1, 17.5, 4.0, 0.0, 17.5),
        None: (1, 11.0, 2.0, None, 11.0),
    }


def test_temperature_band_analysis(silver):
    rows = metrics.temperature_band_analysis(silver[0]).collect()
    assert [tuple(r) for r in rows] == [
        ("Freezing (<0°C)", 3, 10.5, 1.83, -7.5, -1.0),
        ("Cold (0-10°C)", 2, 19.38, 4.75, 0.0, 4.3),
        ("Cool (10-18°C)", 1, 18.0, 4.25, 12.0, 12.0),
        ("Comfortable (18-25°C)", 3, 13.33, 2.92, 18.0, 21.5),
        ("Warm (25-30°C)", 1, 30.5, 7.5, 26.8, 26.8),
        ("Hot (>30°C)", 3, 12.25, 2.58, 30.0, 33.5),
    ]


def test_hourly_weather_metrics(silver):
    rows = metrics.hourly_weather_metrics(silver[0]).collect()
    got = [(str(r.pickup_date), r.pickup_hour, r.weather_category, r.trip_count, r.avg_fare,
            r.total_revenue, r.avg_distance) for r in rows]
    assert got == [
        ("2021-03-02", 6, "Snow", 2, 11.25, 22.5, 2.0),
        ("2021-03-02", 7, "Foggy", 1, 21.25, 21.25, 5.5),
        ("2021-03-02", 8, "Drizzle", 1, 18.0, 18.0, 4.25),
        ("2021-05-11", 13, "Partly Cloudy", 1, 6.0, 6.0, 0.75),
        ("2021-05-11", 14, "Clear", 2, 17.0, 34.0, 4.0),
        ("2021-05-11", 15, "Rain", 1, 30.5, 30.5, 7.5),
        ("2021-08-19", 17, "Rain Showers", 1, 13.75, 13.75, 3.25),
        ("2021-08-19", 18, "Thunderstorm", 1, 12.0, 12.0, 2.5),
        ("2021-12-24", 22, "Snow Showers", 1, 9.0, 9.0, 1.5),
        ("2021-12-24", 23, "Other", 1, 17.5, 17.5, 4.0),
        ("2021-12-25", 0, None, 1, 11.0, 11.0, 2.0),
    ]


def test_match_rate(silver):
    r = match_rate(silver[0]).first()
    assert (r.total_trips, r.matched_trips, r.match_rate, r.meets_threshold) == (13, 12, 12 / 13, True)


def test_counts_add_up_across_gold(silver):
    df = silver[0]
    n = df.count()
    for g in (metrics.weather_impact_summary(df), metrics.hourly_weather_metrics(df),
              metrics.temperature_band_analysis(df)):
        assert sum(r.trip_count for r in g.collect()) == n


def test_condition_compare(silver):
    r = metrics.condition_compare(silver[0]).first()
    # Clear: 24.00, 10.00 -> 17; Rain and Rain Showers: 30.50, 13.75 -> 22.125
    assert (r.base_trips, r.other_trips) == (2, 2)
    assert (r.base_avg_fare, r.other_avg_fare) == (17.0, 22.13)
    assert r.fare_difference == 5.13       # 5.125, HALF_UP
    assert r.pct_change == 30.1            # (22.125 / 17 - 1) * 100 = 30.14...


def test_fare_boxplot(silver):
    from ridewx.operators.stats import fare_boxplot
    rows = {r.weather_condition: r for r in fare_boxplot(silver[0]).collect()}
    assert set(rows) == {"Rain", "Snow", "Foggy", "Partly Cloudy", "Clear", "Other", None}
    rain = rows["Rain"]  # fares 1200, 1375, 1800, 3050 cents
    assert (rain.trips, rain.q1_cents, rain.median_cents, rain.q3_cents) == (4, 1331.25, 1587.5, 2112.5)
    assert (rain.lower_fence_cents, rain.upper_fence_cents) == (159.375, 3284.375)
    assert (rain.lower_whisker, rain.upper_whisker, rain.outliers) == (12.0, 30.5, 0)


def test_rainy_day_ridership(fixture_trips, fixture_weather_raw):
    trips, hours = check_trips(fixture_trips).df, hours_of(fixture_weather_raw)
    got = {r.rainy_day: (r.days, r.total_trips, r.avg_trips_per_day)
           for r in metrics.rainy_day_ridership(trips, hours).collect()}
    assert got == {True: (3, 10, 3.33), False: (1, 2, 2.0), None: (1, 1, 1.0)}


def test_explore_summary_coarse_categories(silver):
    got = {r.weather_category: (r.trip_count, r.avg_fare) for r in
           metrics.explore_summary(silver[0]).collect()}
    assert got == {"Clear": (2, 17.0), "Partly Cloudy": (1, 6.0), "Rain": (2, 22.13), "Snow": (3, 10.5),
                   "Thunderstorm": (1, 12.0), "Other": (3, 18.92)}


def test_distance_trend_and_bins(silver):
    import numpy as np

    from ridewx.operators.stats import distance_by_degree, distance_trend
    temps = np.array([-7.5, -7.5, 4.25, 12.0, 18.0, 21.5, 21.5, 26.75, 30.0, 33.5, -1.0, 0.0])
    dist = np.array([3.0, 1.0, 5.5, 4.25, 0.75, 6.0, 2.0, 7.5, 3.25, 2.5, 1.5, 4.0])
    slope, intercept = np.polyfit(temps, dist, 1)
    r2 = np.corrcoef(temps, dist)[0, 1] ** 2
    t = distance_trend(silver[0]).first()
    assert t.pairs == 12
    assert abs(t.slope - slope) < 1e-9 and abs(t.intercept - intercept) < 1e-9
    assert abs(t.r2 - r2) < 1e-9
    bins = {r.temperature_degree: (r.trip_count, r.avg_distance)
            for r in distance_by_degree(silver[0]).collect()}
    assert bins == {
        -8: (2, 2.0), -1: (1, 1.5), 0: (1, 4.0), 4: (1, 5.5), 12: (1, 4.25), 18: (1, 0.75),
        21: (2, 4.0), 26: (1, 7.5), 30: (1, 3.25), 33: (1, 2.5)}


def test_profile_and_category_counts(fixture_weather_raw):
    from ridewx.operators.observations import type_observations
    from ridewx.operators.stats import profile_weather
    w = type_observations(fixture_weather_raw)
    p = profile_weather(w).first()
    assert (p.records, str(p.first_date), str(p.last_date)) == (10, "2021-03-02", "2021-12-24")
    assert (p.min_temperature, p.max_temperature) == (-7.5, 33.5)
    counts = {r.weather_category: r.observations for r in metrics.category_counts(w).collect()}
    assert counts == {"Clear": 1, "Partly Cloudy": 1, "Rain": 2, "Snow": 2, "Thunderstorm": 1, "Other": 3}


def test_stream_windows_on_fixture(spark, fixture_trips, fixture_weather_raw, tmp_dir):
    import os

    from ridewx.streaming.enrich_stream import (
        check_trip_stream,
        enrich_stream,
        hourly_stream_metrics,
        read_file_stream,
        run_available,
    )
    folder = os.path.join(tmp_dir, "trips")
    fixture_trips.coalesce(1).write.parquet(folder)
    hours = unique_hours(bronze_weather(fixture_weather_raw).df)
    stream = check_trip_stream(read_file_stream(spark, folder))
    out = os.path.join(tmp_dir, "out")
    run_available(hourly_stream_metrics(enrich_stream(stream, hours)), out, os.path.join(tmp_dir, "chk"))
    got = sorted((str(r.window_start), r.weather_category, r.trip_count, r.avg_fare)
                 for r in spark.read.parquet(out).collect())
    # latest pickup 2021-12-25 00:10, watermark 23:10: the last two windows stay open
    assert got == [
        ("2021-03-02 06:00:00", "Snow", 2, 11.25),
        ("2021-03-02 07:00:00", "Foggy", 1, 21.25),
        ("2021-03-02 08:00:00", "Drizzle", 1, 18.0),
        ("2021-05-11 13:00:00", "Partly Cloudy", 1, 6.0),
        ("2021-05-11 14:00:00", "Clear", 2, 17.0),
        ("2021-05-11 15:00:00", "Rain", 1, 30.5),
        ("2021-08-19 17:00:00", "Rain Showers", 1, 13.75),
        ("2021-08-19 18:00:00", "Thunderstorm", 1, 12.0),
        ("2021-12-24 22:00:00", "Snow Showers", 1, 9.0),
    ]


def test_enrich_daily_on_fixture(fixture_trips, fixture_weather_raw):
    from ridewx.operators.enrich import enrich_daily
    from ridewx.operators.observations import daily_weather, type_observations
    days = daily_weather(type_observations(fixture_weather_raw))
    rows = enrich_daily(fixture_trips, days).collect()
    assert len(rows) == 12
    march = {(r.observations, r.day_avg_temperature, r.day_min_temperature, r.day_max_temperature,
              r.day_precipitation, r.day_had_rain, r.day_had_snow)
             for r in rows if str(r.pickup_date) == "2021-03-02"}
    assert march == {(3, 2.9, -7.5, 12.0, 3.0, True, True)}
    december = {(r.day_avg_temperature, r.day_precipitation, r.day_had_snow)
                for r in rows if str(r.pickup_date) == "2021-12-24"}
    assert december == {(-0.5, 0.5, True)}


def test_rain_in_an_hour_without_a_trip_makes_the_day_rainy(spark):
    trips = spark.sql("SELECT TIMESTAMP_NTZ'2022-02-02 10:00:00' AS tpep_pickup_datetime")
    hours = spark.sql("""SELECT * FROM VALUES (DATE'2022-02-02', 10, false), (DATE'2022-02-02', 3, true)
                         AS h(date, hour, is_raining)""")
    assert [r.rainy_day for r in metrics.rainy_day_ridership(trips, hours).collect()] == [True]
