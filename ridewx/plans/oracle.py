"""DuckDB SQL for every catalog query, over the raw driver tables.

Used to check the Spark queries with an independent engine. The stand-in
derivation, labels, code lists, checks and every query are restated in SQL;
only the queries' parameters (dates, row counts) are shared.
"""

from __future__ import annotations

from ridewx.plans import catalog

# ---------------------------------------------------------------------------
# Labels, code sets, bands and checks as published.
CLASSES = {
    "Clear": "0", "Partly Cloudy": "1, 2, 3", "Foggy": "45, 48", "Drizzle": "51, 53, 55, 56, 57",
    "Rain": "61, 63, 65, 66, 67", "Snow": "71, 73, 75, 77", "Rain Showers": "80, 81, 82",
    "Snow Showers": "85, 86", "Thunderstorm": "95, 96, 99"}
COARSE_CLASSES = {
    "Clear": "0", "Partly Cloudy": "1, 2, 3", "Rain": "61, 63, 65, 80, 81, 82",
    "Snow": "71, 73, 75, 85, 86", "Thunderstorm": "95, 96, 99"}
COARSE_CODES = "0, 1, 2, 3, 61, 63, 65, 80, 81, 82, 71, 73, 75, 85, 86, 95, 96, 99"
RAIN_CODES = "51, 53, 55, 56, 57, 61, 63, 65, 66, 67, 80, 81, 82"
SNOW_CODES = "71, 73, 75, 77, 85, 86"
# (name, action, the row is good)
BRONZE_CHECKS = [
    ("valid_datetime", "warn", "datetime IS NOT NULL"),
    ("reasonable_temperature", "warn", "temperature_2m IS NOT NULL AND temperature_2m >= -50 AND temperature_2m <= 50"),
    ("valid_humidity", "warn",
     "relative_humidity_2m IS NOT NULL AND relative_humidity_2m >= 0 AND relative_humidity_2m <= 100"),
]
WEATHER_CHECKS = [
    ("temperature_in_range", "warn", "temperature_2m IS NULL OR (temperature_2m >= -50 AND temperature_2m <= 50)"),
    ("humidity_in_range", "warn",
     "relative_humidity_2m IS NULL OR (relative_humidity_2m >= 0 AND relative_humidity_2m <= 100)"),
    ("precipitation_non_negative", "warn", "precipitation IS NULL OR precipitation >= 0"),
    ("category_present", "warn", "weather_category IS NOT NULL AND weather_category <> ''"),
    ("rain_flag_consistent", "warn", "is_raining IS NOT DISTINCT FROM (rain > 0)"),
]
TRIP_CHECKS = [
    ("fare_non_negative", "warn", "fare_amount IS NOT NULL AND fare_amount >= 0"),
    ("distance_non_negative", "warn", "trip_distance IS NOT NULL AND trip_distance >= 0"),
    ("pickup_before_dropoff", "warn", "coalesce(tpep_pickup_datetime < tpep_dropoff_datetime, false)"),
    ("tpep_pickup_datetime_present", "warn", "tpep_pickup_datetime IS NOT NULL"),
    ("tpep_dropoff_datetime_present", "warn", "tpep_dropoff_datetime IS NOT NULL"),
    ("pickup_zip_present", "warn", "pickup_zip IS NOT NULL"),
    ("dropoff_zip_present", "warn", "dropoff_zip IS NOT NULL"),
    ("trip_distance_present", "warn", "trip_distance IS NOT NULL"),
    ("fare_amount_present", "warn", "fare_amount IS NOT NULL"),
]
SILVER_CHECKS = [
    ("valid_pickup_datetime", "fail", "tpep_pickup_datetime IS NOT NULL"),
    ("valid_fare", "drop", "fare_amount IS NOT NULL AND fare_amount >= 0"),
    ("has_weather_data", "warn", "temperature_2m IS NOT NULL"),
    ("reasonable_temp", "warn", "temperature_2m IS NOT NULL AND temperature_2m >= -50 AND temperature_2m <= 50"),
]
# ---------------------------------------------------------------------------


def category(code: str, classes=CLASSES, null_label: str | None = "Other") -> str:
    arms = " ".join(f"WHEN {code} IN ({codes}) THEN '{label}'" for label, codes in classes.items())
    tail = f" ELSE '{null_label}'" if null_label else ""
    return f"CASE {arms} WHEN {code} IS NOT NULL THEN 'Other'{tail} END"


def band(t: str) -> str:
    return (f"CASE WHEN {t} < 0 THEN 'Freezing (<0°C)' WHEN {t} < 10 THEN 'Cold (0-10°C)'"
            f" WHEN {t} < 18 THEN 'Cool (10-18°C)' WHEN {t} < 25 THEN 'Comfortable (18-25°C)'"
            f" WHEN {t} < 30 THEN 'Warm (25-30°C)' ELSE 'Hot (>30°C)' END")


def scaled(col: str, places: int = 4) -> str:
    return f"CAST(round(CAST({col} AS DOUBLE) * {10 ** places}) AS BIGINT)"


def mean(total: str, n: str, in_p: int, out_p: int) -> str:
    up, down = 10 ** max(out_p - in_p, 0), 10 ** max(in_p - out_p, 0)
    return (f"CASE WHEN {n} > 0 THEN sign({total}) * ((abs({total}) * {2 * up} + {n} * {down})"
            f" // ({n} * {2 * down})) / {float(10 ** out_p)} END")


def rnd(v: str, in_p: int, out_p: int) -> str:
    step = 10 ** (in_p - out_p)
    return f"sign({v}) * ((abs({v}) * 2 + {step}) // {2 * step}) / {float(10 ** out_p)}"


def ratio(num: str, den: str, places: int) -> str:
    return (f"sign({num}) * ((abs({num}) * {2 * 10 ** places} + {den}) // (2 * ({den})))"
            f" / {float(10 ** places)}")


RAIN_AMOUNT = f"CASE WHEN k IN ({RAIN_CODES}) THEN c / 100.0 ELSE 0.0 END"
SNOW_AMOUNT = f"CASE WHEN k IN ({SNOW_CODES}) THEN c / 100.0 ELSE 0.0 END"

BASE = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, props,
         CAST(round(value * 100) AS BIGINT) AS c,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
raw AS (
  SELECT ts AS datetime,
         (c - 3000) / 100.0 AS temperature_2m,
         CAST(k AS DOUBLE) AS relative_humidity_2m,
         ({RAIN_AMOUNT}) + ({SNOW_AMOUNT}) AS precipitation,
         {RAIN_AMOUNT} AS rain,
         {SNOW_AMOUNT} AS snowfall,
         c / 1000.0 AS wind_speed_10m,
         k AS weather_code
  FROM ev WHERE event_type = 'error'),
wx AS (
  SELECT datetime,
         CAST(temperature_2m AS FLOAT) AS temperature_2m,
         CAST(relative_humidity_2m AS FLOAT) AS relative_humidity_2m,
         CAST(precipitation AS FLOAT) AS precipitation,
         CAST(rain AS FLOAT) AS rain,
         CAST(snowfall AS FLOAT) AS snowfall,
         CAST(wind_speed_10m AS FLOAT) AS wind_speed_10m,
         CAST(weather_code AS INTEGER) AS weather_code,
         CAST(datetime AS DATE) AS date,
         CAST(hour(datetime) AS INTEGER) AS hour,
         rain > 0 AS is_raining,
         snowfall > 0 AS is_snowing,
         {category('weather_code')} AS weather_category
  FROM raw),
hours AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY datetime) AS rn FROM wx WHERE datetime IS NOT NULL)
  WHERE rn = 1),
trips AS (
  SELECT ts AS tpep_pickup_datetime,
         ts + to_minutes(k) AS tpep_dropoff_datetime,
         CAST(user_id + 10000 AS VARCHAR) AS pickup_zip,
         CAST(k + 10000 AS VARCHAR) AS dropoff_zip,
         k / 10.0 AS trip_distance,
         (c - 500) / 100.0 AS fare_amount
  FROM ev WHERE event_type <> 'error'),
checked AS (SELECT * FROM trips WHERE fare_amount >= 0),
silver AS (
  SELECT t.*, h.temperature_2m, h.relative_humidity_2m, h.precipitation, h.rain,
         h.snowfall, h.wind_speed_10m, h.weather_code, h.weather_category,
         h.is_raining, h.is_snowing,
         CAST(t.tpep_pickup_datetime AS DATE) AS pickup_date,
         CAST(hour(t.tpep_pickup_datetime) AS INTEGER) AS pickup_hour
  FROM checked t LEFT JOIN hours h
    ON h.date = CAST(t.tpep_pickup_datetime AS DATE)
   AND h.hour = hour(t.tpep_pickup_datetime))"""


def _with(body: str) -> str:
    return f"WITH {BASE}\n{body}"


def _report(checks, dataset: str, table: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS expectation, '{action}' AS action,"
        f" count(*) AS checked_rows, count(*) FILTER (WHERE NOT ({good})) AS violations FROM {table}"
        for name, action, good in checks)


def _keys(t: str = "t") -> str:
    return (f"CAST({t}.tpep_pickup_datetime AS DATE) AS pickup_date, "
            f"CAST(hour({t}.tpep_pickup_datetime) AS INTEGER) AS pickup_hour")


_HOUR_MATCH = ("SELECT 1 FROM hours h WHERE h.date = CAST(t.tpep_pickup_datetime AS DATE)"
               " AND h.hour = hour(t.tpep_pickup_datetime)")

_SCALED_SILVER = (f"SELECT *, {scaled('fare_amount')} AS f, {scaled('trip_distance')} AS d,"
                  f" {scaled('temperature_2m')} AS t FROM silver")


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_events"] = "SELECT * FROM events"
    cols = ", ".join(catalog.SAMPLE_COLUMNS)
    q["sample_trips"] = _with(f"""
SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
       pickup_zip, dropoff_zip, trip_distance, fare_amount
FROM trips
WHERE tpep_pickup_datetime BETWEEN TIMESTAMP '{catalog.SAMPLE_FROM}' AND TIMESTAMP '{catalog.SAMPLE_TO}'
ORDER BY {cols} LIMIT {catalog.SAMPLE_ROWS}""")
    q["preview_trips"] = _with(f"""
SELECT * FROM trips
ORDER BY tpep_pickup_datetime, tpep_dropoff_datetime, pickup_zip, dropoff_zip,
         trip_distance, fare_amount
LIMIT {catalog.PREVIEW_ROWS}""")
    q["ingest_hourly"] = _with("""
SELECT datetime, temperature_2m, relative_humidity_2m,
       precipitation, rain, snowfall, wind_speed_10m, weather_code,
       CAST(datetime AS DATE) AS date, CAST(hour(datetime) AS INTEGER) AS hour,
       rain > 0 AS is_raining, snowfall > 0 AS is_snowing
FROM raw""")
    n = catalog.WINDOW_DAYS
    q["plan_windows"] = _with(f"""
, b AS (SELECT CAST(min(tpep_pickup_datetime) AS DATE) AS s,
               CAST(max(tpep_pickup_datetime) AS DATE) AS e FROM trips),
w AS (SELECT e, CAST(unnest(generate_series(s, e, INTERVAL {n} DAY)) AS DATE) AS ws FROM b)
SELECT CAST(row_number() OVER (ORDER BY ws) - 1 AS INTEGER) AS window_index,
       ws AS window_start, least(ws + {n - 1}, e) AS window_end,
       CAST(least(ws + {n - 1}, e) - ws + 1 AS INTEGER) AS days
FROM w""")
    q["union_chunks"] = _with("SELECT * FROM wx")
    q["bronze_weather"] = _with("SELECT * FROM wx")
    q["classify_code"] = _with(
        f"SELECT event_id, k AS weather_code, {category('k', null_label='Unknown')} AS weather_category FROM ev")
    q["classify_code_coarse"] = _with(
        f"SELECT event_id, k AS weather_code, {category('k', COARSE_CLASSES)} AS weather_category FROM ev")
    q["temperature_bands"] = _with(
        f"SELECT datetime, temperature_2m, {band('temperature_2m')} AS temperature_band FROM wx")
    q["condition_recode"] = _with("""
SELECT tpep_pickup_datetime, weather_category, is_raining, is_snowing,
       CASE WHEN is_raining THEN 'Rain' WHEN is_snowing THEN 'Snow' ELSE weather_category END
         AS weather_condition
FROM silver""")
    q["expect_warn_report"] = _with(
        ", joined AS (SELECT t.*, h.temperature_2m FROM trips t LEFT JOIN hours h"
        " ON h.date = CAST(t.tpep_pickup_datetime AS DATE)"
        " AND h.hour = hour(t.tpep_pickup_datetime))\n"
        + _report(BRONZE_CHECKS + WEATHER_CHECKS, "weather_hourly", "wx")
        + "\nUNION ALL\n" + _report(TRIP_CHECKS, "trips", "trips")
        + "\nUNION ALL\n" + _report(SILVER_CHECKS, "taxi_weather_joined", "joined"))
    q["staged_checks"] = _with(f"""
, staged AS (SELECT * EXCLUDE (is_raining, weather_category),
                    precipitation > 0 AS is_raining,
                    CASE WHEN weather_code IN ({COARSE_CODES}) THEN 'known' END AS weather_category
             FROM (SELECT *, NULL AS is_raining, NULL AS weather_category FROM raw))
""" + _report(WEATHER_CHECKS, "weather_raw", "staged"))
    q["guard_report"] = _with("""
SELECT count(*) AS observations, count(*) - count(datetime) AS without_time,
       count(DISTINCT (CAST(datetime AS DATE), hour(datetime))) FILTER (WHERE datetime IS NOT NULL) AS hours,
       count(datetime) - count(DISTINCT (CAST(datetime AS DATE), hour(datetime)))
                           FILTER (WHERE datetime IS NOT NULL) AS dropped
FROM raw""")
    q["expect_drop"] = _with("SELECT * FROM checked")
    q["expect_fail_pass"] = _with("SELECT * FROM trips")
    q["match_rate"] = _with("""
SELECT count(*) AS total_trips, count(temperature_2m) AS matched_trips,
       count(*) - count(temperature_2m) AS unmatched_trips,
       count(temperature_2m) / count(*) AS match_rate,
       count(temperature_2m) >= count(*) * CAST(0.9 AS DOUBLE) AS meets_threshold
FROM silver""")
    q["unique_hours"] = _with("SELECT * FROM hours")
    q["enrich_hourly"] = _with("SELECT * FROM silver")
    q["csv_read_back"] = _with("SELECT * FROM trips")
    q["json_read_back"] = _with("SELECT * FROM wx")
    q["clustered_read_back"] = _with("SELECT * FROM wx")
    q["refresh_silver"] = _with("SELECT * FROM silver")
    q["unit_names"] = _with("""
SELECT datetime, temperature_2m AS temperature_c, relative_humidity_2m, precipitation AS precipitation_mm,
       rain AS rain_mm, snowfall, wind_speed_10m AS wind_speed_kmh, weather_code, date, hour,
       is_raining, is_snowing, weather_category FROM wx""")
    q["merge_hourly"] = _with(f"""
SELECT t.*, {_keys()}, h.date, h.hour, h.temperature_2m AS temperature_c, h.precipitation AS precipitation_mm,
       CASE WHEN h.date IS NOT NULL THEN {category('h.weather_code', COARSE_CLASSES, None)} END AS weather_category
FROM trips t LEFT JOIN hours h
  ON h.date = CAST(t.tpep_pickup_datetime AS DATE) AND h.hour = hour(t.tpep_pickup_datetime)""")
    q["enrich_daily"] = _with(f"""
, d AS (
  SELECT date AS weather_date, count(*) AS observations,
         {mean('sum(t100)', 'count(t100)', 2, 1)} AS day_avg_temperature,
         {rnd('min(t100)', 2, 1)} AS day_min_temperature,
         {rnd('max(t100)', 2, 1)} AS day_max_temperature,
         sum(p100) / 100.0 AS day_precipitation,
         bool_or(is_raining) AS day_had_rain,
         bool_or(is_snowing) AS day_had_snow
  FROM (SELECT *, {scaled('temperature_2m', 2)} AS t100, {scaled('precipitation', 2)} AS p100 FROM wx)
  GROUP BY date)
SELECT t.*, CAST(t.tpep_pickup_datetime AS DATE) AS pickup_date, d.* EXCLUDE (weather_date)
FROM checked t JOIN d ON d.weather_date = CAST(t.tpep_pickup_datetime AS DATE)""")
    q["matched_semi"] = _with(f"SELECT t.*, {_keys()} FROM checked t WHERE EXISTS ({_HOUR_MATCH})")
    q["unmatched_anti"] = _with(f"SELECT t.*, {_keys()} FROM checked t WHERE NOT EXISTS ({_HOUR_MATCH})")
    q["weather_impact_summary"] = _with(f"""
SELECT weather_category, count(*) AS trip_count,
       {mean('sum(f)', 'count(f)', 4, 2)} AS avg_fare,
       {mean('sum(d)', 'count(d)', 4, 2)} AS avg_distance,
       {mean('sum(t)', 'count(t)', 4, 1)} AS avg_temperature,
       {rnd('sum(f)', 4, 2)} AS total_revenue
FROM ({_SCALED_SILVER}) GROUP BY weather_category""")
    q["hourly_weather_metrics"] = _with(f"""
SELECT pickup_date, pickup_hour, weather_category, temperature_2m, is_raining, is_snowing,
       count(*) AS trip_count,
       {mean('sum(f)', 'count(f)', 4, 2)} AS avg_fare,
       {rnd('sum(f)', 4, 2)} AS total_revenue,
       {mean('sum(d)', 'count(d)', 4, 2)} AS avg_distance
FROM ({_SCALED_SILVER})
GROUP BY pickup_date, pickup_hour, weather_category, temperature_2m, is_raining, is_snowing""")
    q["temperature_band_analysis"] = _with(f"""
SELECT {band('temperature_2m')} AS temperature_band, count(*) AS trip_count,
       {mean('sum(f)', 'count(f)', 4, 2)} AS avg_fare,
       {mean('sum(d)', 'count(d)', 4, 2)} AS avg_distance,
       {rnd('min(t)', 4, 1)} AS min_temp,
       {rnd('max(t)', 4, 1)} AS max_temp
FROM ({_SCALED_SILVER}) GROUP BY 1""")
    coarse = category("weather_code", COARSE_CLASSES, None)
    q["explore_summary"] = _with(f"""
SELECT weather_category,
       {mean('sum(f)', 'count(f)', 4, 2)} AS avg_fare,
       count(fare_amount) AS trip_count,
       {mean('sum(d)', 'count(d)', 4, 2)} AS avg_distance,
       {mean('sum(t)', 'count(t)', 4, 2)} AS avg_temp
FROM (SELECT * EXCLUDE (weather_category), {coarse} AS weather_category
      FROM ({_SCALED_SILVER}))
WHERE weather_category IS NOT NULL
GROUP BY weather_category""")
    q["profile_weather"] = _with(f"""
SELECT count(*) AS records, min(date) AS first_date, max(date) AS last_date,
       {rnd('min(t)', 4, 1)} AS min_temperature, {rnd('max(t)', 4, 1)} AS max_temperature
FROM (SELECT *, {scaled('temperature_2m')} AS t FROM wx)""")
    q["category_counts"] = _with(f"""
SELECT {coarse} AS weather_category, count(*) AS observations FROM wx GROUP BY 1""")
    diff = "(so * nb - sb * no)"
    q["condition_compare"] = _with(f"""
, s AS (
  SELECT count(*) FILTER (WHERE cc = 'Clear' AND cents IS NOT NULL) AS nb,
         sum(cents) FILTER (WHERE cc = 'Clear') AS sb,
         count(*) FILTER (WHERE cc = 'Rain' AND cents IS NOT NULL) AS no,
         sum(cents) FILTER (WHERE cc = 'Rain') AS so
  FROM (SELECT {coarse} AS cc, {scaled('fare_amount')} AS cents FROM silver))
SELECT 'Clear' AS base_condition, 'Rain' AS other_condition,
       nb AS base_trips, no AS other_trips,
       {mean('sb', 'nb', 4, 2)} AS base_avg_fare,
       {mean('so', 'no', 4, 2)} AS other_avg_fare,
       CASE WHEN nb > 0 AND no > 0 THEN {ratio(diff, 'no * nb * 10000', 2)} END AS fare_difference,
       CASE WHEN nb > 0 AND no > 0 AND sb <> 0
            THEN {ratio(diff + ' * 100 * sign(sb)', 'abs(sb) * no', 1)} END AS pct_change
FROM s""")
    q["fare_boxplot"] = _with(f"""
, r AS (
  SELECT CASE WHEN is_raining THEN 'Rain' WHEN is_snowing THEN 'Snow' ELSE weather_category END
           AS weather_condition,
         {scaled('fare_amount', 2)} AS cents
  FROM silver WHERE fare_amount IS NOT NULL),
qs AS (SELECT weather_condition, count(*) AS trips,
              quantile_cont(cents, [0.25, 0.5, 0.75]) AS q FROM r GROUP BY 1),
f AS (SELECT weather_condition, trips, q[1] AS q1_cents, q[2] AS median_cents, q[3] AS q3_cents,
             q[1] - (q[3] - q[1]) * CAST(1.5 AS DOUBLE) AS lower_fence_cents,
             q[3] + (q[3] - q[1]) * CAST(1.5 AS DOUBLE) AS upper_fence_cents FROM qs),
w AS (SELECT r.weather_condition AS wc,
             min(cents) FILTER (WHERE cents BETWEEN lower_fence_cents AND upper_fence_cents) / 100.0
               AS lower_whisker,
             max(cents) FILTER (WHERE cents BETWEEN lower_fence_cents AND upper_fence_cents) / 100.0
               AS upper_whisker,
             count(*) FILTER (WHERE NOT (cents BETWEEN lower_fence_cents AND upper_fence_cents))
               AS outliers
      FROM r JOIN f ON r.weather_condition IS NOT DISTINCT FROM f.weather_condition
      GROUP BY r.weather_condition)
SELECT f.*, w.lower_whisker, w.upper_whisker, w.outliers
FROM f LEFT JOIN w ON f.weather_condition IS NOT DISTINCT FROM w.wc""")
    q["distance_trend"] = _with("""
SELECT CAST(regr_count(y, x) AS BIGINT) AS pairs,
       round(regr_slope(y, x), 10) AS slope,
       round(regr_intercept(y, x), 10) AS intercept,
       round(regr_r2(y, x), 10) AS r2
FROM (SELECT CAST(trip_distance AS DOUBLE) AS y, CAST(temperature_2m AS DOUBLE) AS x FROM silver)""")
    q["distance_by_degree"] = _with(f"""
SELECT CAST(floor(CAST(temperature_2m AS DOUBLE)) AS INTEGER) AS temperature_degree,
       count(*) AS trip_count,
       {mean('sum(d)', 'count(d)', 4, 2)} AS avg_distance
FROM ({_SCALED_SILVER}) WHERE temperature_2m IS NOT NULL GROUP BY 1""")
    q["rainy_day_ridership"] = _with(f"""
, d AS (SELECT pickup_date, count(*) AS trips,
              (SELECT bool_or(is_raining) FROM hours h WHERE h.date = t.pickup_date) AS rainy_day
        FROM (SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_date FROM checked) t GROUP BY pickup_date)
SELECT rainy_day, count(*) AS days, CAST(sum(trips) AS BIGINT) AS total_trips,
       {mean('sum(trips)', 'count(*)', 0, 2)} AS avg_trips_per_day
FROM d GROUP BY rainy_day""")
    q["stream_enrich"] = _with("SELECT * FROM silver")
    q["stream_hourly_metrics"] = _with(f"""
SELECT date_trunc('hour', tpep_pickup_datetime) AS window_start,
       date_trunc('hour', tpep_pickup_datetime) + INTERVAL 1 HOUR AS window_end,
       weather_category, count(*) AS trip_count,
       {mean('sum(f)', 'count(f)', 4, 2)} AS avg_fare,
       {rnd('sum(f)', 4, 2)} AS total_revenue,
       {mean('sum(d)', 'count(d)', 4, 2)} AS avg_distance
FROM ({_SCALED_SILVER})
WHERE date_trunc('hour', tpep_pickup_datetime) + INTERVAL 1 HOUR
      <= (SELECT max(tpep_pickup_datetime) FROM checked) - INTERVAL 1 HOUR
GROUP BY 1, 2, 3""")
    q["refresh_gold"] = q["weather_impact_summary"]
    q["refresh_gold_bands"] = q["temperature_band_analysis"]
    passed = "date_trunc('hour', tpep_pickup_datetime) + INTERVAL 1 HOUR"
    q["stream_late_weather"] = _with(f"""
SELECT * FROM silver WHERE {passed} <= least((SELECT max(tpep_pickup_datetime) FROM checked),
                                             (SELECT max(datetime) FROM raw)) - INTERVAL 1 HOUR""")
    q["stream_match_rate"] = _with(f"""
, h AS (SELECT {passed} AS window_end, count(*) AS n, count(temperature_2m) AS m FROM silver
        WHERE {passed} <= (SELECT max(tpep_pickup_datetime) FROM checked) - INTERVAL 1 HOUR GROUP BY 1),
w AS (SELECT window_end, CAST(sum(n) OVER last_day AS BIGINT) AS trips, CAST(sum(m) OVER last_day AS BIGINT) AS matched,
             count(*) OVER last_day AS hours
      FROM h WINDOW last_day AS (ORDER BY window_end RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW))
SELECT *, matched / trips AS match_rate, matched < trips * CAST(0.9 AS DOUBLE) AS alert FROM w""")
    loads = """
, first_raw AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY CAST(datetime AS DATE), hour(datetime) ORDER BY datetime) AS rn
    FROM raw WHERE datetime IS NOT NULL) WHERE rn = 1),
u AS (SELECT CAST(datetime AS DATE) AS date, CAST(hour(datetime) AS INTEGER) AS hour, day(datetime) AS d, * FROM first_raw),
feed AS (
  SELECT date, hour, 'inserted' AS kind, '' AS changed FROM u WHERE d = 11 AND hour < 6
  UNION ALL SELECT date, hour, 'updated', 'temperature_2m' FROM u WHERE d = 12 AND hour < 12
  UNION ALL SELECT date, hour, 'deleted', '' FROM u WHERE d = 13 AND hour >= 18)"""
    q["weather_changes"] = _with(f"{loads}\nSELECT * FROM feed")
    gone = "day(tpep_pickup_datetime) = 13 AND hour(tpep_pickup_datetime) >= 18"
    measures = ", ".join(f"CASE WHEN NOT ({gone}) THEN {c} END AS {c}" for c in (
        "temperature_2m", "relative_humidity_2m", "precipitation", "rain", "snowfall", "wind_speed_10m",
        "weather_code", "weather_category", "is_raining", "is_snowing"))
    q["refresh_changed"] = _with(f"SELECT * REPLACE ({measures}) FROM silver")
    bad = {"valid_fare": "fare_amount < 0", "pickup_before_dropoff": "NOT (tpep_pickup_datetime < tpep_dropoff_datetime)",
           "fare_not_over_100": "fare_amount > 100"}
    any_bad = " OR ".join(f"({b})" for b in bad.values())
    reasons = "\nUNION ALL ".join(
        f"SELECT 'reason', '{name}', count(*) FROM trips WHERE {b} HAVING count(*) > 0" for name, b in bad.items())
    q["quarantine_counts"] = _with(f"""
SELECT 'kept' AS outcome, CAST(NULL AS VARCHAR) AS expectation, count(*) AS rows FROM trips WHERE NOT ({any_bad})
UNION ALL SELECT 'rejected', NULL, count(*) FROM trips WHERE {any_bad}
UNION ALL {reasons}""")
    listed = ", ".join(f"CASE WHEN {b} THEN '{name}' END" for name, b in bad.items())
    q["quarantined_trips"] = _with(f"SELECT *, concat_ws(',', {listed}) AS violations FROM trips WHERE {any_bad}")
    q["distance_smooth"] = _with(f"""
, b AS (SELECT CAST(round(t / 1000.0) AS BIGINT) AS bin, t - 1000 * CAST(round(t / 1000.0) AS BIGINT) AS x, d AS y
        FROM ({_SCALED_SILVER}) WHERE t IS NOT NULL AND d IS NOT NULL),
m AS (SELECT bin, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM b GROUP BY bin),
r AS (SELECT *, CAST(unnest(generate_series(CAST(ceil(bin / 10.0 - 5) AS BIGINT), CAST(floor(bin / 10.0 + 5) AS BIGINT))) AS INTEGER) AS p FROM m),
w AS (SELECT *, (bin - p * 10) / CAST(10 AS DOUBLE) AS a, pow(1 - pow(abs((bin - p * 10) / CAST(10 AS DOUBLE)) / 5, 3), 3) AS w FROM r),
s AS (SELECT p, min(abs(a)) AS nearest, CAST(sum(n) AS BIGINT) AS trips, sum(w * n) AS s0, sum(w * (a * n + sx / 1e4)) AS s1,
             sum(w * (a * a * n + 2 * a * sx / 1e4 + sxx / 1e8)) AS s2, sum(w * sy / 1e4) AS t0,
             sum(w * (a * sy / 1e4 + sxy / 1e8)) AS t1 FROM w GROUP BY p)
SELECT p AS temperature_degree, trips,
       round(CASE WHEN s0 * s2 - s1 * s1 > 1e-9 * s0 * s0 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) ELSE t0 / s0 END, 6)
         AS smooth_distance
FROM s WHERE nearest <= 1 AND s0 > 0""")
    q["fare_sketch_check"] = _with("""
SELECT CASE WHEN is_raining THEN 'Rain' WHEN is_snowing THEN 'Snow' ELSE weather_category END AS weather_condition,
       count(*) AS trips, true AS q1_ok, true AS median_ok, true AS q3_ok
FROM silver WHERE fare_amount IS NOT NULL GROUP BY 1""")
    shift = f"INTERVAL {catalog.CLOCK_SHIFT_DAYS} DAY"
    q["repeated_hour"] = _with(f"""
, o AS (SELECT * EXCLUDE (rn) FROM (SELECT date_trunc('hour', datetime + {shift}) AS h, temperature_2m, weather_code,
          row_number() OVER (PARTITION BY date_trunc('hour', datetime) ORDER BY datetime) AS rn FROM raw) WHERE rn = 1)
SELECT tpep_pickup_datetime + {shift} AS pickup_utc,
       tpep_pickup_datetime + {shift} - CASE WHEN tpep_pickup_datetime + {shift} < TIMESTAMP '2024-11-03 06:00:00'
                                             THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS pickup_local,
       fare_amount, temperature_2m, weather_code,
       CASE WHEN o.h = TIMESTAMP '2024-11-03 05:00:00' THEN 'first' WHEN o.h = TIMESTAMP '2024-11-03 06:00:00' THEN 'second'
            WHEN o.h IS NOT NULL THEN 'plain' END AS clock
FROM trips LEFT JOIN o ON o.h = date_trunc('hour', tpep_pickup_datetime + {shift})""")
    q["stream_ingest"] = q["ingest_hourly"]
    q["missing_windows"] = _with(f"""
, b AS (SELECT CAST(min(tpep_pickup_datetime) AS DATE) AS s, CAST(max(tpep_pickup_datetime) AS DATE) AS e FROM trips),
w AS (SELECT CAST(row_number() OVER (ORDER BY ws) - 1 AS INTEGER) AS window_index, ws AS window_start,
             least(ws + {n - 1}, e) AS window_end
      FROM (SELECT e, CAST(unnest(generate_series(s, e, INTERVAL {n} DAY)) AS DATE) AS ws FROM b)),
d AS (SELECT *, CAST(unnest(generate_series(window_start, window_end, INTERVAL 1 DAY)) AS DATE) AS day FROM w)
SELECT window_index, window_start, window_end, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS missing_days
FROM d WHERE NOT EXISTS (SELECT 1 FROM raw WHERE CAST(datetime AS DATE) = d.day AND day(datetime) < 22)
GROUP BY 1, 2, 3""")
    q["qualified_read"] = q["namespace_read"] = _with("SELECT * FROM trips")
    q["table_handle"] = _with("SELECT tpep_pickup_datetime, fare_amount FROM trips WHERE fare_amount >= 0")
    q["code_lookup"] = _with(f"""
SELECT event_id, weather_code, CASE WHEN label <> 'Other' THEN label END AS label
FROM (SELECT event_id, k AS weather_code, {category('k')} AS label FROM ev)""")
    q["rejected_documents"] = _with("""
, d AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM ev WHERE event_type = 'error')
SELECT CASE user_id % 7 WHEN 0 THEN 'Invalid response: missing ''hourly'' data'
                        WHEN 1 THEN 'Invalid response: missing ''time'' in hourly data'
                        WHEN 2 THEN 'Invalid response: hourly arrays differ in length' END AS problem,
       count(*) AS documents FROM d GROUP BY 1""")
    return q


ORACLE_SQL = _queries()
