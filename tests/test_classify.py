import pytest
from pyspark.sql import functions as F

from ridewx.functions.classify import (
    LIBRARY_NULL_LABEL,
    classify_code,
    classify_code_coarse,
    condition_recode,
    temperature_band,
)

CASES = [
    (0, "Clear"), (1, "Partly Cloudy"), (2, "Partly Cloudy"), (3, "Partly Cloudy"),
    (45, "Foggy"), (48, "Foggy"), (61, "Rain"), (63, "Rain"), (65, "Rain"),
    (71, "Snow"), (73, "Snow"), (95, "Thunderstorm"), (999, "Other"),
    # codes the reference never tested
    (51, "Drizzle"), (53, "Drizzle"), (55, "Drizzle"), (56, "Drizzle"), (57, "Drizzle"),
    (66, "Rain"), (67, "Rain"), (75, "Snow"), (77, "Snow"),
    (80, "Rain Showers"), (81, "Rain Showers"), (82, "Rain Showers"),
    (85, "Snow Showers"), (86, "Snow Showers"), (96, "Thunderstorm"), (99, "Thunderstorm"),
]


def _classify(spark, codes, fn):
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    return [r[0] for r in df.select(fn(F.col("code"))).collect()]


def test_detailed_codes(spark):
    got = _classify(spark, [c for c, _ in CASES], classify_code)
    assert got == [label for _, label in CASES]


def test_null_code_pipeline_and_library_form(spark):
    assert _classify(spark, [None], classify_code) == ["Other"]
    assert _classify(spark, [None], lambda c: classify_code(c, null_label=LIBRARY_NULL_LABEL)) == ["Unknown"]
    assert _classify(spark, [None], lambda c: classify_code(c, null_label=None)) == [None]


@pytest.mark.parametrize("code,label", [
    (0, "Clear"), (2, "Partly Cloudy"), (61, "Rain"), (80, "Rain"), (82, "Rain"),
    (71, "Snow"), (85, "Snow"), (86, "Snow"), (95, "Thunderstorm"),
    (51, "Other"), (45, "Other"), (66, "Other"), (77, "Other"),
])
def test_coarse_codes(spark, code, label):
    assert _classify(spark, [code], classify_code_coarse) == [label]


def test_temperature_bands_including_quirks(spark):
    temps = [-0.1, 0.0, 9.99, 10.0, 17.9, 18.0, 24.9, 25.0, 29.9, 30.0, 30.1, None]
    df = spark.createDataFrame([(t,) for t in temps], "t float")
    got = [r[0] for r in df.select(temperature_band("t")).collect()]
    assert got == ["Freezing (<0°C)", "Cold (0-10°C)", "Cold (0-10°C)", "Cool (10-18°C)",
                   "Cool (10-18°C)", "Comfortable (18-25°C)", "Comfortable (18-25°C)",
                   "Warm (25-30°C)", "Warm (25-30°C)",
                   # exactly 30 and a missing reading both land in the top band
                   "Hot (>30°C)", "Hot (>30°C)", "Hot (>30°C)"]
    labelled = [r[0] for r in df.select(temperature_band("t", null_band="Unknown")).collect()]
    assert labelled[-1] == "Unknown"


def test_condition_recode(spark):
    df = spark.createDataFrame(
        [(True, True, "Rain"), (False, True, "Snow Showers"), (False, False, "Clear"),
         (None, None, None), (False, False, "Foggy")],
        "is_raining boolean, is_snowing boolean, weather_category string")
    got = [r[0] for r in df.select(condition_recode()).collect()]
    assert got == ["Rain", "Snow", "Clear", None, "Foggy"]
