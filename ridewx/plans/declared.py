"""The layers as declared datasets for Spark's declarative pipelines.

``declare()`` registers bronze, silver and the three gold tables as
materialized views with ``pyspark.pipelines`` (the batch decorator; a
``table`` there would be a streaming table). Call it from a pipeline
definition file run by the ``spark-pipelines`` command; each query
function reads its inputs by table name from the active session.

The open-source decorators have no expectations, so the query functions
apply them inline (fail → counters → drop), as everywhere else here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridewx.operators import metrics
from ridewx.operators.enrich import enrich_hourly
from ridewx.operators.observations import bronze_weather, hours_of

# Table names of the sources and of each declared layer.
STAGED_OBSERVATIONS = "weather_raw"
TRIPS = "trips"
BRONZE, SILVER = "weather_hourly", "taxi_weather_joined"
GOLD = ("weather_impact_summary", "hourly_weather_metrics", "temperature_band_analysis")


def _spark() -> SparkSession:
    return SparkSession.active()


def bronze() -> DataFrame:
    return bronze_weather(_spark().table(STAGED_OBSERVATIONS)).df


def _silver(trips_table: str):
    def silver() -> DataFrame:
        spark = _spark()
        # No size check: a flow function only declares, it runs no job.
        return enrich_hourly(spark.table(trips_table), hours_of(spark.table(BRONZE)),
                             max_broadcast_rows=None)[0]
    return silver


def _gold(fn):
    def query() -> DataFrame:
        return fn(_spark().table(SILVER), ordered=False)
    query.__name__ = fn.__name__
    return query


def declare(trips_table: str = TRIPS) -> None:
    """Register the five layers with the active pipeline definition."""
    from pyspark import pipelines as dp

    dp.materialized_view(bronze, name=BRONZE, comment="Typed hourly observations",
                         table_properties={"quality": "bronze"}, partition_cols=["date"])
    dp.materialized_view(_silver(trips_table), name=SILVER,
                         comment="Trips enriched with the hour's observation",
                         table_properties={"quality": "silver"}, partition_cols=["pickup_date"])
    for name, fn in zip(GOLD, (metrics.weather_impact_summary, metrics.hourly_weather_metrics,
                               metrics.temperature_band_analysis)):
        dp.materialized_view(_gold(fn), name=name, table_properties={"quality": "gold"})
