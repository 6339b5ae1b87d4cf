"""Helpers shared by the operators: row keys, lineage cuts, batch slicing.

Rules all operators follow:

* Inputs are read by column name; other columns of the input, whatever
  their names, are never touched and never clash.
* ``text`` null counts as empty unless an operator says otherwise.
* A row is identified by ``row``, its place in the scan, so repeated rows
  and repeated or null ids stay separate. The input must therefore be a
  scan of files (or another source that returns the same rows in the same
  order when it is read again). Scans are split by the session's settings
  and, unless ``spark.sql.files.minPartitionNum`` is set, by the executors
  alive at that moment; ``fix_splits`` sets it, so a lost or added executor
  cannot move rows to other places between two reads.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridewx.session import scratch_path

#: One run of white space, and one word, as the contracts define them.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text a Python worker handles at a time.
SLICE_BYTES = 1 << 20


def fix_splits(spark: SparkSession) -> None:
    """Split scans alike for the rest of the session (a value the user has
    set stays)."""
    name = "spark.sql.files.minPartitionNum"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(spark.sparkContext.defaultParallelism))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``row`` and the named columns (text null → empty)."""
    fix_splits(docs.sparkSession)
    cols = [F.coalesce(docs[c], F.lit("")).alias("text") if c == "text"
            else docs[c].alias(c) for c in columns]
    return docs.select(F.monotonically_increasing_id().alias("row"), *cols)


def cut(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back:
    a lost executor then re-reads files instead of recomputing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(docs: DataFrame) -> list:
    """The columns of ``docs``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def without_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows whose ``row`` key is in ``rows``."""
    fix_splits(docs.sparkSession)
    key = free_name(docs, "_row")
    drop = cut(rows.select(F.col("row").alias(key)), "dropped")
    return (docs.withColumn(key, F.monotonically_increasing_id())
            .join(drop, key, "left_anti").select(*own_columns(docs)))


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` holds about ``limit`` bytes in
    each piece (one longer text makes a piece of its own)."""
    import numpy as np

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
        offs = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
        at = 0
        while at < n:
            to = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
            to = min(n, max(to, at + 1))
            yield batch.slice(at, to - at)
            at = to
    # Workers are reused: hand back what this task's batches took.
    pa.default_memory_pool().release_unused()
