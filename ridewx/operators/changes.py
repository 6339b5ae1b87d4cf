"""What changed between two loads of a keyed table.

One shuffle on the key brings a key's old and new row together; whole rows
are compared by value (nulls equal nulls), so no change hides behind a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERTED, UPDATED, DELETED = "inserted", "updated", "deleted"


def change_feed(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose row differs: the key columns, ``kind`` (inserted,
    updated or deleted) and ``changed``, the names of the columns that
    differ (empty unless updated). Keys must be unique on either side; null
    keys are keys like others. Columns are matched by name, and one that only
    one side has counts as null on the other."""
    values = sorted({c for c in old.columns + new.columns} - set(keys))
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    row = F.struct(*[F.col(c) for c in values])
    pairs = both.groupBy(*keys).agg(
        F.count_if(F.col("_new") == 0).alias("_olds"), F.count_if(F.col("_new") == 1).alias("_news"),
        F.max(F.when(F.col("_new") == 0, row)).alias("_was"), F.max(F.when(F.col("_new") == 1, row)).alias("_is"))
    single = F.when((F.col("_olds") > 1) | (F.col("_news") > 1), F.raise_error(F.lit("a key has several rows")).cast("boolean")).otherwise(True)
    differs = F.array_compact(F.array(*[
        F.when(~F.col("_was")[c].eqNullSafe(F.col("_is")[c]), F.lit(c)) for c in values])).cast("array<string>")
    kind = (F.when(F.col("_olds") == 0, INSERTED).when(F.col("_news") == 0, DELETED)
            .when(~F.col("_was").eqNullSafe(F.col("_is")), UPDATED))
    return (pairs.filter(single).withColumn("kind", kind).filter("kind IS NOT NULL")
            .select(*keys, "kind", F.when(F.col("kind") == UPDATED, differs)
                    .otherwise(F.array().cast("array<string>")).alias("changed")))


def date_runs(dates: DataFrame, date_col: str) -> list[tuple[str, str]]:
    """Distinct dates as runs of consecutive days (first, last). The driver
    holds one entry for each changed date."""
    days = sorted(r[0] for r in dates.select(F.col(date_col)).filter(F.col(date_col).isNotNull()).distinct().collect())
    runs: list[list] = []
    for d in days:
        if runs and (d - runs[-1][1]).days == 1:
            runs[-1][1] = d
        else:
            runs.append([d, d])
    return [(a.isoformat(), b.isoformat()) for a, b in runs]
