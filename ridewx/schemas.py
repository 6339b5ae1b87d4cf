"""Declared schema of each layer and a check used at layer boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The seven hourly variables of an observation response, in
# response order (they name the arrays of a response and the columns).
HOURLY_VARIABLES = [
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "rain",
    "snowfall",
    "wind_speed_10m",
    "weather_code",
]
MEASURES = HOURLY_VARIABLES[:-1]

# A landed response document: parallel arrays keyed by variable.
RESPONSE_SCHEMA = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        # Elements are read as text and cast one by one, so that one bad
        # element does not lose its array.
        + [T.StructField(v, T.ArrayType(T.StringType())) for v in MEASURES + ["weather_code"]]
    )),
])

# Fixed values below: the column names and order of each layer (the
# reference's table schemas), so existing queries keep working.

# Staged observations (the load step's output, before typing).
WEATHER_RAW_SCHEMA = T.StructType(
    [T.StructField("datetime", T.TimestampNTZType())]
    + [T.StructField(v, T.DoubleType()) for v in MEASURES]
    + [T.StructField("weather_code", T.IntegerType())]
)

# Bronze: typed hourly observations.
WEATHER_HOURLY_SCHEMA = T.StructType(
    [T.StructField("datetime", T.TimestampNTZType())]
    + [T.StructField(v, T.FloatType()) for v in MEASURES]
    + [
        T.StructField("weather_code", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("is_raining", T.BooleanType()),
        T.StructField("is_snowing", T.BooleanType()),
        T.StructField("weather_category", T.StringType()),
    ]
)

TRIP_SCHEMA = T.StructType([
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("pickup_zip", T.StringType()),
    T.StructField("dropoff_zip", T.StringType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
])

# Weather columns carried onto each trip, in output order.
WEATHER_JOIN_COLUMNS = MEASURES + [
    "weather_code", "weather_category", "is_raining", "is_snowing",
]

# Silver: 6 trip + 10 weather + 2 derived columns.
SILVER_SCHEMA = T.StructType(
    list(TRIP_SCHEMA.fields)
    + [WEATHER_HOURLY_SCHEMA[name] for name in WEATHER_JOIN_COLUMNS]
    + [T.StructField("pickup_date", T.DateType()),
       T.StructField("pickup_hour", T.IntegerType())]
)


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, expected: T.StructType, *, exact_order: bool = True,
                 what: str = "table") -> DataFrame:
    """Raise if names or types differ from ``expected`` (nullability ignored)."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if not exact_order:
        got, want = sorted(got, key=lambda x: x[0]), sorted(want, key=lambda x: x[0])
    if got != want:
        missing = sorted({n for n, _ in want} - {n for n, _ in got})
        extra = sorted({n for n, _ in got} - {n for n, _ in want})
        raise SchemaMismatch(
            f"{what}: schema differs; missing={missing} extra={extra} "
            f"got={[(n, t.simpleString()) for n, t in got]}")
    return df

