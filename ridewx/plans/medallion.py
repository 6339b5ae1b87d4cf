"""The layer graph as plain functions: staged → bronze → silver → gold.

Each dataset is a function of named inputs; ``build`` resolves them lazily
in dependency order and returns DataFrames (one plan each, no action).
``write_all`` materializes the layers, which is where the expectation
counters are filled. Gold is finished from a state table that adds up
(``metrics.gold_state``), made in one pass over the written silver.

``refresh`` replaces the dates of a range: it joins the trips of these
dates, makes their state from what was just written, and finishes gold from
the state of all dates, a few rows per hour; the rest of silver is not read.

Under a root path silver, state and gold are published as snapshots
(``sources.snapshots``): a load is written, judged by its counters, and only
then named, so readers see the old rows until all is well. Under a schema
name the tables are written in place; there a fail check stops the write.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridewx.operators import metrics
from ridewx.operators.changes import change_feed, date_runs
from ridewx.operators.enrich import enrich_hourly
from ridewx.operators.observations import bronze_weather, hours_of
from ridewx.operators.quality import Checked
from ridewx.schemas import SILVER_SCHEMA
from ridewx.sources import snapshots
from ridewx.sources.sinks import is_path, member, replace_dates, write_clustered, write_table
from ridewx.sources.tables import read_table


@dataclass
class Dataset:
    name: str
    fn: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    quality: str


@dataclass
class Layers:
    frames: dict[str, DataFrame] = field(default_factory=dict)
    checks: dict[str, list[Checked]] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]

    def expectation_metrics(self) -> dict[str, dict]:
        return {name: {k: v for c in cs for k, v in c.metrics().items()}
                for name, cs in self.checks.items()}


def _bronze(layers: Layers, weather_raw: DataFrame) -> DataFrame:
    checked = bronze_weather(weather_raw)
    layers.checks["weather_hourly"] = [checked]
    return checked.df


def _silver(layers: Layers, trips: DataFrame, weather_hourly: DataFrame) -> DataFrame:
    # No size check here: it would run a job while the layers are only built.
    return _silver_of(layers, trips, hours_of(weather_hourly))


def _silver_of(layers: Layers, trips: DataFrame, hours: DataFrame) -> DataFrame:
    silver, checks = enrich_hourly(trips, hours, max_broadcast_rows=None)
    layers.checks["taxi_weather_joined"] = checks
    return silver


# name → (function, inputs, quality). Sources ("trips", "weather_raw") are given.
GRAPH = [
    Dataset("weather_hourly", _bronze, ("weather_raw",), "bronze"),
    Dataset("taxi_weather_joined", _silver, ("trips", "weather_hourly"), "silver"),
    Dataset("weather_impact_summary",
            lambda _, s: metrics.weather_impact_summary(s, ordered=False),
            ("taxi_weather_joined",), "gold"),
    Dataset("hourly_weather_metrics",
            lambda _, s: metrics.hourly_weather_metrics(s, ordered=False),
            ("taxi_weather_joined",), "gold"),
    Dataset("temperature_band_analysis",
            lambda _, s: metrics.temperature_band_analysis(s, ordered=False),
            ("taxi_weather_joined",), "gold"),
]


def build(trips: DataFrame, weather_raw: DataFrame) -> Layers:
    """All layers as lazy DataFrames."""
    layers = Layers(frames={"trips": trips, "weather_raw": weather_raw})
    for ds in GRAPH:
        layers.frames[ds.name] = ds.fn(layers, *[layers.frames[i] for i in ds.inputs])
    return layers


def load_observations(spark, landing_path: str, target: str, fmt: str = "parquet") -> DataFrame:
    """The load step: landed response documents → typed, classified
    observations written (overwrite) to ``target`` (a table name or a path),
    clustered by time: the staged table in its 13-column form.

    Replaces the serial fetch-and-concatenate loop: every landed document
    is parsed where it lies, and the write replaces the whole table.
    """
    from ridewx.operators.observations import type_observations
    from ridewx.sources.responses import read_responses

    typed = type_observations(read_responses(spark, landing_path))
    write_clustered(typed, target, "date", "datetime", fmt=fmt, partition_by_date=False)
    return read_table(spark, target, fmt)


def _write_bronze(layers: Layers, weather_raw: DataFrame, target: str, fmt: str) -> DataFrame:
    bronze = _bronze(layers, weather_raw)
    name = member(target, "weather_hourly")
    # A few rows per date: no date folders.
    write_clustered(bronze, name, "date", "datetime", fmt=fmt, partition_by_date=False)
    layers.frames["weather_hourly"] = read_table(bronze.sparkSession, name, fmt)
    return layers["weather_hourly"]


#: Gold tables and how each is finished from the state.
GOLD = {
    "weather_impact_summary": metrics.summary_from_state,
    "hourly_weather_metrics": metrics.hourly_from_state,
    "temperature_band_analysis": metrics.bands_from_state,
}
SILVER, STATE = "taxi_weather_joined", "gold_state"
#: Gold tables have no date; a snapshot of one is a single folder.
WHOLE, WHOLE_COLUMN = "all", "part"


def read_layer(spark, target: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A written layer: of a root path its published rows, of a schema the
    table."""
    path = member(target, name)
    if not is_path(target) or name == "weather_hourly":
        out = read_table(spark, path, fmt)
    elif name in GOLD:
        return snapshots.read(spark, path, WHOLE_COLUMN, fmt).drop(WHOLE_COLUMN)
    else:
        out = snapshots.read(spark, path, "pickup_date", fmt)
    # A folder column is read back last.
    return out.select(*SILVER_SCHEMA.names) if name == SILVER else out


def read_silver(spark, target: str, fmt: str = "parquet") -> DataFrame:
    """Written silver in its own column order."""
    return read_layer(spark, target, SILVER, fmt)


def _finish_gold(layers: Layers, spark, target: str, fmt: str) -> None:
    """Gold from the state of all dates."""
    state = read_layer(spark, target, STATE, fmt)
    layers.frames[STATE] = state
    for name, finish in GOLD.items():
        out, path = finish(state), member(target, name)
        if is_path(target):
            load = snapshots.stage(out.withColumn(WHOLE_COLUMN, F.lit(WHOLE)), path, WHOLE_COLUMN, out.columns[0], fmt)
            snapshots.publish(spark, load)
        else:
            write_table(out, path, fmt=fmt)
        layers.frames[name] = read_layer(spark, target, name, fmt)


def _load(layers: Layers, trips: DataFrame, hours: DataFrame, target: str, fmt: str,
          first: str | None = None, last: str | None = None,
          max_share: dict[str, float] | None = None) -> None:
    """Silver, state and gold of ``trips``: the dates ``first`` to ``last``,
    or everything."""
    spark = trips.sparkSession
    silver_path, state_path = member(target, SILVER), member(target, STATE)
    if is_path(target):
        silver, checks = enrich_hourly(trips, hours, max_broadcast_rows=None, stop=False)
        layers.checks[SILVER] = checks
        load = snapshots.stage(silver, silver_path, "pickup_date", "tpep_pickup_datetime", fmt)
        snapshots.audit(checks, max_share)
        changed = load.read(spark)
        state = snapshots.stage(metrics.gold_state(changed), state_path, "pickup_date", "pickup_hour", fmt)
        snapshots.publish(spark, load, first, last)
        snapshots.publish(spark, state, first, last)
    else:
        silver = _silver_of(layers, trips, hours)
        if first is None:
            write_clustered(silver, silver_path, "pickup_date", "tpep_pickup_datetime", fmt=fmt)
        else:
            replace_dates(silver, silver_path, "pickup_date", "tpep_pickup_datetime", first, last, fmt)
        changed = read_silver(spark, target, fmt)
        if first is None:
            write_clustered(metrics.gold_state(changed), state_path, "pickup_date", "pickup_hour", fmt=fmt)
        else:
            changed = changed.filter(F.col("pickup_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
            replace_dates(metrics.gold_state(changed), state_path, "pickup_date", "pickup_hour", first, last, fmt)
    #: The silver rows that the state was made from.
    layers.frames["changed_silver"] = changed
    layers.frames[SILVER] = read_silver(spark, target, fmt)
    _finish_gold(layers, spark, target, fmt)


def write_all(trips: DataFrame, weather_raw: DataFrame, target: str, fmt: str = "parquet",
              max_share: dict[str, float] | None = None) -> Layers:
    """Write every layer under ``target``, a root path or a schema name; each
    later layer reads the written one. Bronze and silver are clustered by
    time. ``max_share`` (root paths): the share of rows that may violate a
    warn expectation, by name; a load beyond it is not published."""
    layers = Layers(frames={"trips": trips, "weather_raw": weather_raw})
    bronze = _write_bronze(layers, weather_raw, target, fmt)
    _load(layers, trips, hours_of(bronze), target, fmt, max_share=max_share)
    return layers


def _in_dates(time_col: str, first: str, last: str) -> Column:
    """Whether the time lies on the dates ``first`` to ``last``; a range of
    the column itself, so that it reaches the scan."""
    t = F.col(time_col)
    start = F.lit(first).cast("date").cast("timestamp_ntz")
    end = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return (t >= start) & (t < end)


def refresh(trips: DataFrame, weather_raw: DataFrame, target: str, first: str, last: str,
            fmt: str = "parquet", max_share: dict[str, float] | None = None) -> Layers:
    """Bring layers written by ``write_all`` up to date for the dates
    ``first`` to ``last``: only the trips of these dates are read and joined,
    and only these dates of silver and state are replaced; gold is finished
    from the state. Bronze, a few rows per hour, is written anew. A date left
    without any trip is emptied. Trips without a pickup time lie in no range;
    they are checked with every refresh, so one of them stops it."""
    layers = Layers(frames={"trips": trips, "weather_raw": weather_raw})
    bronze = _write_bronze(layers, weather_raw, target, fmt)
    in_range = _in_dates("tpep_pickup_datetime", first, last) | F.col("tpep_pickup_datetime").isNull()
    hours = hours_of(bronze.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    _load(layers, trips.filter(in_range), hours, target, fmt, first, last, max_share)
    return layers


def refresh_changed(trips: DataFrame, old: DataFrame, new: DataFrame, target: str, fmt: str = "parquet",
                    max_share: dict[str, float] | None = None) -> Layers:
    """Bring layers written from the observations ``old`` up to those of
    ``new`` (one row per ``date`` and ``hour`` on either side): only dates
    with an inserted, updated or deleted hour are refreshed, a run of
    consecutive dates at a time. Without a change the layers stay as they
    are."""
    spark, raw = trips.sparkSession, new.drop("date", "hour")
    runs = date_runs(change_feed(old, new, ["date", "hour"]), "date")
    layers = Layers(frames={"trips": trips, "weather_raw": raw})
    for first, last in runs:
        layers = refresh(trips, raw, target, first, last, fmt, max_share)
    if not runs:
        for name in (SILVER, STATE, *GOLD):
            layers.frames[name] = read_layer(spark, target, name, fmt)
    return layers
