"""Column functions (native expressions only)."""

from ridewx.functions.classify import (
    classify_code,
    classify_code_coarse,
    condition_recode,
    is_positive,
    temperature_band,
)
from ridewx.functions.exact import (
    avg_exact,
    max_exact,
    mean_half_up,
    min_exact,
    scaled,
    sum_exact,
)
from ridewx.functions.timecols import (
    between_inclusive,
    date_key,
    format_local_minute,
    hour_key,
    hour_start,
    ntz_literal,
    parse_local_time,
    within_days,
)

__all__ = [
    "avg_exact", "between_inclusive", "classify_code", "classify_code_coarse",
    "condition_recode", "date_key", "format_local_minute", "hour_key", "hour_start",
    "is_positive", "max_exact", "mean_half_up", "min_exact", "ntz_literal",
    "parse_local_time", "scaled", "sum_exact", "temperature_band", "within_days",
]
