"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE re-plans at runtime: it coalesces
# tiny shuffle partitions, splits skewed join partitions and turns a join
# into a broadcast only when the measured shuffle output is small.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # ANSI casts: an uncastable distance or temperature fails the ingest
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # JS objects keep the last duplicate key; variant parsing does too with this.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a listing of many shard or range folders takes some hundred tasks, not one a folder (up to 10,000):
    # a folder is listed in less time than a task is started in
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested additions for a large cluster (100 TB of NDJSON, ~1000 executors).
# Splits of 256 MB keep a task's JSON parse a few seconds long; the initial
# shuffle width is generous and AQE coalesces it toward 256 MB partitions, or
# splits a partition 3x the median (and over 512 MB) when a join key is hot.
CLUSTER_SETTINGS = {
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tackroom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are only for local runs; on a cluster
    the submitter decides both and this leaves them alone.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("TACKROOM_DRIVER_MEM", "16g"))
        # one local JVM: list shard folders on the driver instead of launching a
        # distributed listing job (on a cluster the default parallel listing stays)
        b = b.config("spark.sql.sources.parallelPartitionDiscovery.threshold", "4096")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in SESSION_DEFAULTS.items():
        if k not in ("spark.ui.enabled", "spark.ui.showConsoleProgress"):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the submitter sets it to shared storage and we only read it.
    When it is unset on a local master (tests and benches) we create one folder
    per application and register it; on a cluster that is an error, since the
    driver's disk is not the executors'.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = sc.applicationId
        if app not in _LOCAL_ROOT:
            _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="tackroom-ckpt-")
        root = _LOCAL_ROOT[app]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_parallel(df, min_partitions: int | None = None):
    """Give CPU-heavy row work (JSON parsing, nested rebuilds) every core.

    A scan of a few small files can come out as fewer splits than there are
    cores; then a round-robin repartition spreads the rows. A large input
    already has at least that many splits and passes through untouched, so
    this never adds a shuffle at scale.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want)
