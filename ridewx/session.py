"""Session settings and the shared folder used to cut lineage.

The library never creates a session behind the caller's back except in
``local_session`` (tests, bench). Everything else takes the session the
caller already has and reads its configuration.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings the library relies on. ``spark.sql.session.timeZone`` is pinned
# because observation times are local wall-clock hours (naive timestamps);
# the typed layers keep them as TIMESTAMP_NTZ, but streaming watermarks need
# TIMESTAMP and then the zone must be fixed.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Streaming window state in RocksDB (off-heap, spills to local disk,
    # checkpointed as changelogs) instead of executor heap maps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def cluster_conf(cores: int, shuffled_bytes: int = 0, target_partition_bytes: int = 256 << 20,
                 max_partitions: int = 50_000) -> dict:
    """Settings for a cluster of ``cores``: about ``target_partition_bytes``
    per scan split and per shuffle partition.

    Shuffle partitions follow the bytes the largest shuffle moves (a partial
    aggregate's rows, or both sides of a shuffle join), not the bytes read:
    the driver tracks one size per map task and partition, so partitions
    that stay empty are not free. AQE merges small ones and splits skewed
    ones; above ``max_partitions`` partitions grow instead, and spill.
    """
    partitions = max(cores, min(-(-shuffled_bytes // target_partition_bytes), max_partitions))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "ridewx") -> SparkSession:
    """A local session for tests and the bench.

    On a cluster build the session with the platform's launcher and apply
    ``RECOMMENDED_CONF``; size ``spark.sql.shuffle.partitions`` to the data
    (AQE coalesces small partitions at runtime).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def app_id(spark: SparkSession) -> str:
    """The application id (classic sessions) or the session id (Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return spark.conf.get("spark.app.id", None) or spark.sessionId


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a fresh temporary folder;
    on a cluster a missing setting is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: configuration only
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc is not None:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder (HDFS, "
            "object store) so intermediate tables survive executor loss")
    folder = tempfile.mkdtemp(prefix="ridewx-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the checkpoint folder."""
    app = "".join(ch if ch.isalnum() or ch in "-_" else "_" for ch in str(app_id(spark)))
    return f"{checkpoint_dir(spark).rstrip('/')}/ridewx/{app}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> bool:
    """Delete this application's scratch folder (written layers, hour
    tables, stream sinks and checkpoints).

    Call it when the application is done with them; returns False when the
    file system cannot be reached from this session (Spark Connect).
    """
    root = scratch_root(spark)
    try:
        jvm, hconf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Spark Connect: no JVM handle
        return False
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(hconf)
    return bool(fs.delete(path, True)) if fs.exists(path) else True


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the files instead of
    recomputing the whole upstream plan) and gives the optimizer the real
    on-disk size of the result. Use it for small, reused intermediate
    tables such as the hour table before a size-checked broadcast.
    """
    return materialize_counted(df, label)[0]


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """``materialize`` that also returns the rows and about the bytes they
    take in memory (text by its length, other columns by their width; nested
    ones as JSON text), from counters on the write itself (no second job)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    obs = Observation(f"{label}_rows_{uuid.uuid4().hex[:8]}")
    size = F.lit(8).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(df[f.name]), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(df[f.name]))), F.lit(0))
        else:
            size = size + 16
    df.observe(obs, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")
               ).write.mode("overwrite").parquet(path)
    counted = obs.get
    return spark.read.parquet(path), int(counted["rows"]), int(counted["bytes"])


def source_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
