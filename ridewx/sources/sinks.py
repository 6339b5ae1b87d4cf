"""Writing layers: overwrite a table, and a time-clustered write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewx.sources.tables import read_table


def is_path(name_or_path: str) -> bool:
    """Paths are recognised by a slash (a URI has one); the rest are names."""
    return "/" in name_or_path


def member(target: str, name: str) -> str:
    """Table ``name`` of ``target``, a root path or a schema name."""
    return f"{target.rstrip('/')}/{name}" if is_path(target) else f"{target}.{name}"


def write_table(df: DataFrame, name_or_path: str, fmt: str = "parquet",
                mode: str = "overwrite", partition_by: list[str] | None = None, **options: str) -> None:
    """Save ``df`` as a catalog table (unqualified or qualified name) or to
    a path. Overwrite replaces the table atomically per the format's rules."""
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(name_or_path):
        writer.save(name_or_path)
    else:
        writer.saveAsTable(name_or_path)


def _files_of_dates(spark: SparkSession, name_or_path: str, date_col: str, first: str, last: str,
                    fmt: str) -> dict[str, str]:
    """One file of every date of the range that holds rows."""
    day = F.col(date_col)
    rows = (read_table(spark, name_or_path, fmt)
            .filter(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
            .select(day.cast("string").alias("day"), F.col("_metadata.file_path").alias("file"))
            .distinct().groupBy("day").agg(F.min("file").alias("file")).collect())
    return {r["day"]: r["file"] for r in rows}


def replace_dates(df: DataFrame, name_or_path: str, date_col: str, time_col: str,
                  first: str, last: str, fmt: str = "parquet") -> None:
    """Replace the dates ``first`` to ``last``, of which ``df`` holds the
    rows, in a table written by ``write_clustered``; the folders of all other
    dates are not touched. A date of which ``df`` has no row is emptied,
    after the others are written. File names are unique to a write, so such
    a date is one that still has a file of before. The driver holds one name
    for each date of the range.
    """
    spark = df.sparkSession
    before = _files_of_dates(spark, name_or_path, date_col, first, last, fmt)
    out = df.hint("rebalance", date_col).sortWithinPartitions(date_col, time_col)
    if is_path(name_or_path):
        (out.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
         .partitionBy(date_col).save(name_or_path))
    else:
        # Inserts go by position. The table was saved with dynamic overwrite.
        columns = spark.read.table(name_or_path).columns
        out.select(*columns).write.insertInto(name_or_path, overwrite=True)
    after = _files_of_dates(spark, name_or_path, date_col, first, last, fmt)
    gone = sorted(day for day, file in before.items() if after.get(day) == file)
    if is_path(name_or_path):
        # A file without rows, not a missing folder: the last date's file also holds the schema.
        empty = spark.createDataFrame([], df.drop(date_col).schema)
        for day in gone:
            write_table(empty, f"{name_or_path.rstrip('/')}/{date_col}={day}", fmt)
    elif gone:
        spark.sql(f"ALTER TABLE {name_or_path} DROP IF EXISTS "
                  + ", ".join(f"PARTITION ({date_col} = DATE'{day}')" for day in gone))


def write_clustered(df: DataFrame, name_or_path: str, date_col: str, time_col: str,
                    fmt: str = "parquet", partition_by_date: bool = True) -> None:
    """Write a table or path clustered by time: one folder per date, files
    sorted by time. Without date folders (for tables of a few rows per date)
    the files hold ranges of dates.

    ``REBALANCE`` hashes rows by date and lets AQE split a date that holds
    far more rows than the rest into several tasks (and merge small ones),
    in one pass: unlike range partitioning it runs no sampling job, so the
    upstream plan (and any expectation counters in it) is evaluated once.
    Readers filtering on a time range skip whole date folders (partition
    pruning) and row groups (min/max statistics on the sorted time).
    """
    if partition_by_date:
        out = df.hint("rebalance", date_col).sortWithinPartitions(date_col, time_col)
        write_table(out, name_or_path, fmt, partition_by=[date_col], partitionOverwriteMode="dynamic")
    else:
        out = df.hint("rebalance").sortWithinPartitions(date_col, time_col)
        write_table(out, name_or_path, fmt)
