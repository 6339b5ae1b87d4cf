"""ridewx: enrich event records with hourly observations and measure how
conditions affect them, as plain functions over Spark DataFrames.

Typical use::

    from ridewx import (type_observations, unique_hours, enrich_hourly,
                        weather_impact_summary)
    hours = unique_hours(type_observations(staged_observations))
    silver, checks = enrich_hourly(trips, hours)
    weather_impact_summary(silver).show()
"""

from ridewx.functions.classify import (
    classify_code,
    classify_code_coarse,
    condition_recode,
    temperature_band,
)
from ridewx.operators.enrich import enrich_daily, enrich_hourly, join_hours
from ridewx.operators.metrics import (
    category_counts,
    condition_compare,
    explore_summary,
    hourly_weather_metrics,
    rainy_day_ridership,
    temperature_band_analysis,
    weather_impact_summary,
)
from ridewx.operators.observations import (
    bronze_weather,
    daily_weather,
    type_observations,
    unique_hours,
)
from ridewx.operators.quality import (
    apply_expectations,
    expect,
    expect_or_drop,
    expect_or_fail,
    match_rate,
    quality_report,
)
from ridewx.operators.stats import (
    distance_by_degree,
    distance_trend,
    fare_boxplot,
    profile_weather,
)
from ridewx.operators.sampling import first_rows_by_time
from ridewx.sources.responses import (
    parse_response_text,
    plan_windows,
    read_responses,
    union_chunks,
    with_category,
)

__version__ = "0.1.0"

__all__ = [
    "apply_expectations", "bronze_weather", "category_counts", "classify_code",
    "classify_code_coarse", "condition_compare", "condition_recode", "daily_weather",
    "distance_by_degree", "distance_trend", "enrich_daily", "enrich_hourly", "expect",
    "expect_or_drop", "expect_or_fail", "explore_summary", "fare_boxplot",
    "first_rows_by_time", "with_category",
    "hourly_weather_metrics", "join_hours", "match_rate", "parse_response_text",
    "plan_windows", "profile_weather", "quality_report", "rainy_day_ridership",
    "read_responses", "temperature_band", "temperature_band_analysis",
    "type_observations", "union_chunks", "unique_hours", "weather_impact_summary",
]
