"""Local observation hours as instants: the hour that a clock change repeats
and the one it leaves out.

Observations come as local wall-clock times, in order inside a document. On
the day the clocks go back one hour is there twice with the same text; only
its place in the document tells the two apart. ``resolve_instants`` gives
every row its instant, ``unique_instants`` keeps one observation for each
hour that really passed, and ``join_on_instant`` joins trips whose pickup is
an instant, so both hours keep their own observation and their own trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridewx.functions.timecols import wall_clock
from ridewx.operators.enrich import DEFAULT_MAX_BROADCAST_ROWS, size_checked
from ridewx.operators.observations import earliest_per_group
from ridewx.streaming.enrich_stream import wall_clock_instant

PLAIN, FIRST, SECOND, GAP = "plain", "first", "second", "gap"
#: Length of the repeated (and of the missing) time.
OVERLAP_MINUTES = 60


def hour_instant(instant: Column, zone: str) -> Column:
    """When the local hour that holds ``instant`` began."""
    into = F.pmod(F.unix_micros(F.from_utc_timestamp(instant, zone)), F.lit(3_600_000_000))
    return F.timestamp_micros(F.unix_micros(instant) - into)


def resolve_instants(rows: DataFrame, zone: str, document: list[str], position: str = "position",
                     time_col: str = "datetime", overlap_minutes: int = OVERLAP_MINUTES) -> DataFrame:
    """``rows`` with ``instant`` (TIMESTAMP) and ``clock``: plain, first or
    second (of a repeated time) or gap (a time no clock showed; it counts
    from the change on, as if the clock had not been moved).

    A repeated time is the second one once the times of its document have
    stopped rising on that date; a document that holds only one pass cannot
    show which it is and gets the first. Rows without a time have no
    instant. A document is sorted by one task: give the columns that name
    one response, not a station's whole history."""
    shown = wall_clock_instant(F.col(time_col))
    first = F.to_utc_timestamp(shown, zone)
    second = F.timestamp_add("MINUTE", F.lit(overlap_minutes), first)
    repeated = F.from_utc_timestamp(second, zone) == shown
    ordered = Window.partitionBy(*document).orderBy(position)
    # Stopped rising: this row or an earlier repeated one is not after its predecessor.
    same_date = Window.partitionBy(*document, F.to_date(time_col)).orderBy(position).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = (rows.withColumns({"_repeated": repeated, "_back": F.col(time_col) <= F.lag(time_col).over(ordered)})
           .withColumn("_again", F.coalesce(F.col("_repeated"), F.lit(False)) & F.coalesce(
               F.bool_or(F.col("_repeated") & F.col("_back")).over(same_date), F.lit(False))))
    clock = (F.when(shown.isNull(), F.lit(None).cast("string")).when(F.col("_again"), SECOND)
             .when(F.col("_repeated"), FIRST).when(F.from_utc_timestamp(first, zone) != shown, GAP).otherwise(PLAIN))
    return out.withColumns({"instant": F.when(F.col("_again"), second).otherwise(first), "clock": clock}).drop(
        "_repeated", "_back", "_again")


def unique_instants(rows: DataFrame, zone: str) -> DataFrame:
    """The earliest observation of every local hour that passed, with the
    hour's beginning as ``hour_instant``. Rows without an instant belong to
    no hour."""
    timed = rows.filter(F.col("instant").isNotNull())
    return earliest_per_group(timed, [hour_instant(F.col("instant"), zone).alias("hour_instant")], "instant")


def join_on_instant(trips: DataFrame, hours: DataFrame, pickup: str, zone: str, columns: list[str],
                    how: str = "left", max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Trips joined to the observation of the hour that their ``pickup`` (a
    TIMESTAMP) lies in; ``hours`` must be unique on ``hour_instant``. The
    hour table is broadcast within the size bound of ``join_hours``."""
    keyed = trips.withColumn("hour_instant", hour_instant(F.col(pickup), zone))
    side = size_checked(hours.select("hour_instant", *columns), "instants", max_broadcast_rows).df
    return keyed.join(side, "hour_instant", how)
