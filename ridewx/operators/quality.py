"""Named expectations on rows: warn (count), drop (count and remove), fail
(stop the job).

Compiled onto a DataFrame in a fixed order: fail filters, then one
``observe`` holding every counter, then drop filters. ``observe`` is a
barrier the optimizer does not push filters through; without it a pushed-
down drop predicate can skip whole parquet row groups before the fail check
sees them, and a bad row would pass silently. The same ordering makes a
fail check see rows that a drop would remove.

A NULL predicate result counts as a violation unless the expectation says
``null_passes`` (used for ranges where a missing reading is allowed).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = WARN
    null_passes: bool = False

    def __post_init__(self):
        if self.action not in (WARN, DROP, FAIL):
            raise ValueError(f"unknown action {self.action!r}")

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(self.null_passes))


def expect(name: str, predicate: str, null_passes: bool = False) -> Expectation:
    return Expectation(name, predicate, WARN, null_passes)


def expect_or_drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, DROP)


def expect_or_fail(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, FAIL)


class ExpectationFailed(RuntimeError):
    pass


@dataclass
class Checked:
    """A checked DataFrame and its counters (filled after the first action)."""
    df: DataFrame
    observation: Observation | None
    expectations: list[Expectation] = field(default_factory=list)

    def metrics(self, wait: float = 10.0) -> dict:
        """The counters; empty when no action has run ``wait`` seconds on
        (they arrive shortly after the action that filled them)."""
        if self.observation is None:
            return {}
        arrived = self.observation._jo.future()
        until = time.monotonic() + wait
        while not arrived.isCompleted():
            if time.monotonic() > until:
                return {}
            time.sleep(0.02)
        return dict(self.observation.get)

    def warnings(self) -> dict[str, int]:
        m = self.metrics()
        return {e.name: m[e.name] for e in self.expectations
                if e.action == WARN and m.get(e.name)}


def _fail_filter(e: Expectation) -> Column:
    message = F.lit(f"Expectation '{e.name}' failed: {e.predicate}")
    return F.when(e.passes(), F.lit(True)).otherwise(F.raise_error(message))


def apply_expectations(df: DataFrame, expectations: list[Expectation],
                       label: str = "dataset", stop: bool = True) -> Checked:
    """Fail filters → one observe with all counters → drop filters.
    ``stop=False`` leaves the fail filters out: their violations are only
    counted, for a staged write that is judged before it is published
    (``snapshots.audit``)."""
    if not expectations:
        return Checked(df, None, [])
    for e in expectations:
        if e.action == FAIL and stop:
            df = df.filter(_fail_filter(e))
    obs = Observation(f"{label}_{uuid.uuid4().hex[:8]}")
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(~e.passes()).alias(e.name) for e in expectations]
    df = df.observe(obs, *counters)
    for e in expectations:
        if e.action == DROP:
            df = df.filter(e.passes())
    return Checked(df, obs, list(expectations))


def quality_report(df: DataFrame, expectations: list[Expectation], dataset: str) -> DataFrame:
    """Violations per expectation as a query (one aggregate pass).

    Rows: dataset, expectation, action, checked_rows, violations. Counters
    from ``observe`` exist only after an action, so a report that is itself
    a result is a plain aggregate.
    """
    return quality_reports(df, {dataset: expectations})


def quality_reports(df: DataFrame, datasets: dict[str, list[Expectation]]) -> DataFrame:
    """``quality_report`` for several datasets that have the same rows, such
    as events and the same events enriched by a left join, in one pass."""
    items = [(dataset, e) for dataset, es in datasets.items() for e in es]
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(~e.passes()).alias(f"_v{i}") for i, (_, e) in enumerate(items)])
    rows = F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(e.name).alias("expectation"),
                 F.lit(e.action).alias("action"), F.col("_rows").alias("checked_rows"),
                 F.col(f"_v{i}").cast("bigint").alias("violations"))
        for i, (dataset, e) in enumerate(items)
    ])
    return agg.select(F.inline(rows))


def violations(expectations: list[Expectation]) -> Column:
    """Names of the drop and fail expectations that a row violates, in the
    order given."""
    named = F.array(*[F.when(~e.passes(), F.lit(e.name)) for e in expectations if e.action != WARN])
    return F.array_compact(named).cast("array<string>")


def quarantine(df: DataFrame, expectations: list[Expectation], path: str, label: str = "dataset",
               fmt: str = "parquet") -> tuple[DataFrame, DataFrame, Checked]:
    """Split rows by their drop and fail expectations in one pass, losing
    none: rows that violate one go to ``path``/rejected=true with the names
    of all they violate, the others to ``path``/rejected=false. Warn
    expectations are counted only. Returns (good rows, rejected rows with
    ``violations``, the checks with their counters)."""
    if "violations" in df.columns or "rejected" in df.columns:
        raise ValueError("the rows have a column named violations or rejected")
    checked = apply_expectations(df, [e if e.action == WARN else Expectation(e.name, e.predicate, FAIL, e.null_passes)
                                      for e in expectations], label, stop=False)
    tagged = checked.df.withColumn("violations", violations(expectations))
    (tagged.withColumn("rejected", F.size("violations") > 0).write.mode("overwrite").format(fmt)
     .partitionBy("rejected").save(path))
    written = df.sparkSession.read.schema(tagged.schema.add("rejected", "boolean")).format(fmt).load(path)
    return (written.filter(~F.col("rejected")).select(*df.columns),
            written.filter("rejected").select(*df.columns, "violations"),
            Checked(checked.df, checked.observation, list(expectations)))


def quarantine_report(good: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows per outcome: ``kept``, ``rejected`` (each row once), and one
    ``reason`` row for each expectation with the rows that violate it."""
    count = F.count(F.lit(1)).alias("rows")
    whole = lambda df, outcome: df.agg(count).select(
        F.lit(outcome).alias("outcome"), F.lit(None).cast("string").alias("expectation"), "rows")
    reasons = rejected.select(F.explode("violations").alias("expectation")).groupBy("expectation").agg(count)
    return (whole(good, "kept").unionByName(whole(rejected, "rejected"))
            .unionByName(reasons.select(F.lit("reason").alias("outcome"), "expectation", "rows")))


def match_rate(enriched: DataFrame, probe_col: str = "temperature_2m",
               threshold: float = 0.9) -> DataFrame:
    """Share of rows that found an observation, with the threshold check."""
    total = F.count(F.lit(1))
    matched = F.count(F.col(probe_col))
    return enriched.agg(total.alias("total_trips"), matched.alias("matched_trips")).select(
        "total_trips", "matched_trips",
        (F.col("total_trips") - F.col("matched_trips")).alias("unmatched_trips"),
        F.try_divide(F.col("matched_trips"), F.col("total_trips")).alias("match_rate"),
        (F.col("matched_trips") >= F.col("total_trips") * threshold).alias("meets_threshold"),
    )


class MatchRateWarning(UserWarning):
    pass


def check_match_rate(enriched: DataFrame, threshold: float = 0.9, fail: bool = False,
                     probe_col: str = "temperature_2m"):
    """Run the match-rate aggregate (one row) and warn, or raise with
    ``fail=True``, when fewer than ``threshold`` of the rows found an
    observation. Returns the row."""
    import warnings

    row = match_rate(enriched, probe_col, threshold).first()
    if row.total_trips and not row.meets_threshold:
        msg = (f"only {row.matched_trips} of {row.total_trips} rows "
               f"({row.match_rate:.1%}) found an observation; expected {threshold:.0%}")
        if fail:
            raise ExpectationFailed(msg)
        warnings.warn(msg, MatchRateWarning, stacklevel=2)
    return row


# ---------------------------------------------------------------------------
# The reference's declared expectations, by layer.
BRONZE_EXPECTATIONS = [
    expect("valid_datetime", "datetime IS NOT NULL"),
    expect("reasonable_temperature", "temperature_2m BETWEEN -50 AND 50"),
    expect("valid_humidity", "relative_humidity_2m BETWEEN 0 AND 100"),
]
TRIP_EXPECTATIONS = [
    expect_or_fail("valid_pickup_datetime", "tpep_pickup_datetime IS NOT NULL"),
    expect_or_drop("valid_fare", "fare_amount >= 0"),
]
SILVER_EXPECTATIONS = [
    expect("has_weather_data", "temperature_2m IS NOT NULL"),
    expect("reasonable_temp", "temperature_2m BETWEEN -50 AND 50"),
]
# The reference's fixture tests, as row checks.
WEATHER_ROW_CHECKS = [
    expect("temperature_in_range", "temperature_2m BETWEEN -50 AND 50", null_passes=True),
    expect("humidity_in_range", "relative_humidity_2m BETWEEN 0 AND 100", null_passes=True),
    expect("precipitation_non_negative", "precipitation >= 0", null_passes=True),
    expect("category_present", "weather_category IS NOT NULL AND length(weather_category) > 0"),
    expect("rain_flag_consistent", "is_raining IS NOT DISTINCT FROM (rain > 0)"),
]
TRIP_ROW_CHECKS = [
    expect("fare_non_negative", "fare_amount >= 0"),
    expect("distance_non_negative", "trip_distance >= 0"),
    expect("pickup_before_dropoff", "tpep_pickup_datetime < tpep_dropoff_datetime"),
] + [
    expect(f"{c}_present", f"{c} IS NOT NULL")
    for c in ["tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_zip",
              "dropoff_zip", "trip_distance", "fare_amount"]
]
# ---------------------------------------------------------------------------
