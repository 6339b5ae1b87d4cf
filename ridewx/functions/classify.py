"""Column functions that classify observations: weather codes, flags,
temperature bands and the plotting recode.

All are native ``CASE WHEN`` expressions, so they stay inside whole-stage
code generation; none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# They must equal the reference's labels and code sets.
# WMO weather codes, detailed rule set (pipeline and library form), in order.
WEATHER_CODE_CLASSES = [
    ("Clear", [0]),
    ("Partly Cloudy", [1, 2, 3]),
    ("Foggy", [45, 48]),
    ("Drizzle", [51, 53, 55, 56, 57]),
    ("Rain", [61, 63, 65, 66, 67]),
    ("Snow", [71, 73, 75, 77]),
    ("Rain Showers", [80, 81, 82]),
    ("Snow Showers", [85, 86]),
    ("Thunderstorm", [95, 96, 99]),
]
# Coarse rule set used by the exploration notebook, in order.
WEATHER_CODE_CLASSES_COARSE = [
    ("Clear", [0]),
    ("Partly Cloudy", [1, 2, 3]),
    ("Rain", [61, 63, 65, 80, 81, 82]),
    ("Snow", [71, 73, 75, 85, 86]),
    ("Thunderstorm", [95, 96, 99]),
]
OTHER_LABEL = "Other"
# Null code: "Other" in the pipeline tables, "Unknown" in the library form.
PIPELINE_NULL_LABEL = "Other"
LIBRARY_NULL_LABEL = "Unknown"

# Temperature bands: (exclusive upper bound in °C, label), tested in order;
# everything else (including NULL and exactly 30) falls in the last label.
TEMPERATURE_BANDS = [
    (0, "Freezing (<0°C)"),
    (10, "Cold (0-10°C)"),
    (18, "Cool (10-18°C)"),
    (25, "Comfortable (18-25°C)"),
    (30, "Warm (25-30°C)"),
]
TEMPERATURE_BAND_TOP = "Hot (>30°C)"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_code(code: str | Column,
                  classes: list[tuple[str, list[int]]] = WEATHER_CODE_CLASSES,
                  null_label: str | None = PIPELINE_NULL_LABEL) -> Column:
    """Map a WMO weather code to a category with an ordered rule set.

    ``null_label`` decides what a NULL code becomes (quirk Q1); ``None``
    keeps it NULL.
    """
    code = _col(code)
    expr = None
    for label, codes in classes:
        cond = code == codes[0] if len(codes) == 1 else code.isin(*codes)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.when(code.isNotNull(), OTHER_LABEL)
    if null_label is not None:
        expr = expr.otherwise(null_label)
    return expr


def classify_code_coarse(code: str | Column,
                         null_label: str | None = PIPELINE_NULL_LABEL) -> Column:
    return classify_code(code, WEATHER_CODE_CLASSES_COARSE, null_label)


def is_positive(amount: str | Column) -> Column:
    """``amount > 0``; a NULL amount gives a NULL flag (quirk Q2)."""
    return _col(amount) > 0


def temperature_band(temperature: str | Column,
                     null_band: str | None = None) -> Column:
    """Half-open temperature bands tested in order.

    By default a NULL temperature falls through to the top band, as the
    reference does (quirk Q4); pass ``null_band="Unknown"`` to label it.
    """
    t = _col(temperature)
    expr = None
    if null_band is not None:
        expr = F.when(t.isNull(), null_band)
    for upper, label in TEMPERATURE_BANDS:
        expr = F.when(t < upper, label) if expr is None else expr.when(t < upper, label)
    return expr.otherwise(TEMPERATURE_BAND_TOP)


def band_order(band: str | Column) -> Column:
    """Sort position of a band label (for presentation without min_temp)."""
    b = _col(band)
    expr = None
    for i, (_, label) in enumerate(TEMPERATURE_BANDS):
        expr = F.when(b == label, i) if expr is None else expr.when(b == label, i)
    return expr.when(b == TEMPERATURE_BAND_TOP, len(TEMPERATURE_BANDS)).otherwise(None)


def condition_recode(is_raining: str | Column = "is_raining",
                     is_snowing: str | Column = "is_snowing",
                     category: str | Column = "weather_category") -> Column:
    """Rain wins over snow, snow over the category (the plotting recode)."""
    return (F.when(_col(is_raining), "Rain")
            .when(_col(is_snowing), "Snow")
            .otherwise(_col(category)))
