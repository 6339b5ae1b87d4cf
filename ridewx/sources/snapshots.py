"""Write, audit, publish: a table by path whose readers see one snapshot.

    <root>/data/load=<id>/<date column>=<date>/   what one load wrote; never changed
    <root>/snapshots/version=<n>/                 one small JSON file: the load that holds each date

A load is written first (``stage``), judged by the counters of that write
(``audit``), and only then named by a new snapshot (``publish``), which is
the single step that readers see. A load that fails on the way leaves the
published snapshot as it was. ``read`` reads the newest snapshot, or an
older one until ``vacuum`` drops it. Replacing dates writes these dates
only: all others stay with the loads that hold them.

A snapshot's file has one row for each date, and one without a date that
names the table's schema, so an empty table can be read. Two publishers of
the same next version cannot both succeed: the second finds its folder taken
and raises. A publisher that was interrupted leaves such a folder behind;
``vacuum`` removes it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridewx.operators.quality import FAIL, Checked, ExpectationFailed

_SNAPSHOT = "day string, load string, schema string"


@dataclass(frozen=True)
class Load:
    """Rows written under a table's root, not yet published."""
    root: str
    load: str
    date_col: str
    schema: T.StructType
    fmt: str

    @property
    def path(self) -> str:
        return f"{self.root}/data/load={self.load}"

    def read(self, spark: SparkSession) -> DataFrame:
        """The load's own rows, published or not."""
        return spark.read.schema(self.schema).format(self.fmt).load(self.path)


def _fs(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, oldest first. A version exists once its file does."""
    out = []
    for name in _names(spark, f"{root.rstrip('/')}/snapshots"):
        if name.startswith("version=") and any(
                f.startswith("part-") for f in _names(spark, f"{root.rstrip('/')}/snapshots/{name}")):
            out.append(int(name[len("version="):]))
    return sorted(out)


def _unfinished(spark: SparkSession, root: str, known: list[int]) -> list[str]:
    """Version folders without a snapshot's file."""
    done = {f"version={v}" for v in known}
    return [n for n in _names(spark, f"{root}/snapshots") if n.startswith("version=") and n not in done]


def _snapshot(spark: SparkSession, root: str, version: int) -> tuple[dict[str, str], T.StructType]:
    rows = spark.read.schema(_SNAPSHOT).json(f"{root}/snapshots/version={version}").collect()
    schema = next(r["schema"] for r in rows if r["day"] is None)
    return {r["day"]: r["load"] for r in rows if r["day"] is not None}, T.StructType.fromJson(json.loads(schema))


def stage(df: DataFrame, root: str, date_col: str, time_col: str, fmt: str = "parquet") -> Load:
    """Write ``df`` as a load of its own, clustered by date and time."""
    load = Load(root.rstrip("/"), uuid.uuid4().hex, date_col, df.schema, fmt)
    (df.hint("rebalance", date_col).sortWithinPartitions(date_col, time_col)
     .write.format(fmt).partitionBy(date_col).save(load.path))
    return load


def audit(checks: Iterable[Checked], max_share: dict[str, float] | None = None) -> dict[str, int]:
    """Judge a staged load by the counters of its write: every fail
    expectation must have none, and an expectation named in ``max_share`` at
    most that share of the rows. Returns the counters; raises
    ``ExpectationFailed`` naming every check that is broken."""
    counted: dict[str, int] = {}
    broken = []
    for check in checks:
        metrics = check.metrics()
        if check.expectations and not metrics:
            raise ExpectationFailed("the load has no counters: it was not written")
        rows = metrics.get("rows", 0)
        for e in check.expectations:
            bad = metrics[e.name]
            allowed = 0 if e.action == FAIL else (max_share or {}).get(e.name, 1.0) * rows
            if bad > allowed:
                broken.append(f"Expectation '{e.name}' failed: {bad} of {rows} rows violate {e.predicate}")
        counted.update(metrics)
    if broken:
        raise ExpectationFailed("; ".join(broken))
    return counted


def publish(spark: SparkSession, load: Load, first: str | None = None, last: str | None = None) -> int:
    """Name ``load`` in a new snapshot: it replaces the dates ``first`` to
    ``last`` (dates it holds no row of are emptied), or the whole table.
    Returns the version."""
    known = versions(spark, load.root)
    if pending := _unfinished(spark, load.root, known):
        raise RuntimeError(f"{load.root}: {pending[0]} exists without a snapshot: another publisher is at work, "
                           "or one was interrupted (then run vacuum)")
    days: dict[str, str] = {}
    if known and first is not None:
        old, schema = _snapshot(spark, load.root, known[-1])
        if schema.simpleString() != load.schema.simpleString():
            raise ValueError(f"the load's schema differs from the table's: {load.schema.simpleString()}")
        days = {d: name for d, name in old.items() if not first <= d <= last}
    prefix = f"{load.date_col}="
    mine = [n[len(prefix):] for n in _names(spark, load.path) if n.startswith(prefix)]
    days |= {d: load.load for d in mine}
    rows = [(d, name, None) for d, name in sorted(days.items())] + [(None, None, load.schema.json())]
    version = known[-1] + 1 if known else 1
    (spark.createDataFrame(rows, _SNAPSHOT).coalesce(1).write.mode("error")
     .json(f"{load.root}/snapshots/version={version}"))
    return version


def read(spark: SparkSession, root: str, date_col: str, fmt: str = "parquet", version: int | None = None) -> DataFrame:
    """The newest published rows, or those of an older ``version``. Only the
    folders of dates that the snapshot names are listed."""
    root = root.rstrip("/")
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{root} has no published version" + ("" if version is None else f" {version}"))
    days, schema = _snapshot(spark, root, known[-1] if version is None else version)
    if not days:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/load={load}/{date_col}={day}" for day, load in sorted(days.items())]
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return (spark.read.option("basePath", f"{root}/data").schema(full).format(fmt).load(paths)
            .select(*schema.names))


def vacuum(spark: SparkSession, root: str, date_col: str, keep: int = 2) -> list[str]:
    """Delete what the last ``keep`` snapshots don't name: older and
    unfinished snapshots, date folders that were replaced, and loads that were
    never published.
    Run it when no load is under way. Returns the deleted folders' names."""
    root = root.rstrip("/")
    known = versions(spark, root)
    used = {(load, day) for v in known[-keep:] for day, load in _snapshot(spark, root, v)[0].items()}
    gone = []

    def delete(folder: str) -> None:
        fs, path = _fs(spark, f"{root}/{folder}")
        fs.delete(path, True)
        gone.append(folder)

    for name in _unfinished(spark, root, known) + [f"version={v}" for v in known[:-keep]]:
        delete(f"snapshots/{name}")
    for name in _names(spark, f"{root}/data"):
        days = [d for d in _names(spark, f"{root}/data/{name}") if d.startswith(f"{date_col}=")]
        live = [d for d in days if (name[len("load="):], d[len(date_col) + 1:]) in used]
        if not live:
            delete(f"data/{name}")
        else:
            for d in set(days) - set(live):
                delete(f"data/{name}/{d}")
    return gone
