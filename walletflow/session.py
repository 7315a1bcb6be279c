"""Session settings the operators rely on, and the shared scratch area."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings needed for exact JSON semantics. They are session
# settings, so they are applied to whatever session the caller hands in.
REQUIRED_CONF = {
    # inner duplicate keys keep the last value instead of nulling the document
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Writer options of the files that only this package reads back: documents and what is carried from
# step to step take about half the room that they take in Parquet's default.
COMPACT = {"compression": "zstd"}

# Steps that write so much wait until the files of their shuffles are let go.
RELEASE_BYTES = 64 << 20

# Larger than any file: a scan that counts this much for opening a file puts one file into each task.
_ONE_FILE = str(1 << 40)


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session (``spark.checkpoint.dir`` / the context's
    checkpoint dir).  Only when nothing is configured (local runs and
    tests) a private folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="walletflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/walletflow/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession, written: str) -> None:
    """Have the files of finished shuffles removed after a step that has ``written`` much.  Spark removes what
    nothing refers to any more after the driver's garbage collection, which a driver with memory to
    spare starts every 30 minutes only.  Python's references reach the driver's JVM about a second late."""
    from walletflow.sinks.csv import path_size

    if path_size(spark, written) < RELEASE_BYTES:
        return
    gc.collect()
    for _ in range(3):
        time.sleep(1.0)
        spark.sparkContext._jvm.System.gc()


def one_file_a_task(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings whose scans give every file a task of its own."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", _ONE_FILE)
    own.conf.set("spark.sql.files.openCostInBytes", _ONE_FILE)
    return own


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench (local mode, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("walletflow")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.speculation", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
