"""Session helpers.

Operators never create or stop a session; they use the one their input
DataFrame belongs to. ``local_session`` is for tests, benchmarks and
one-machine runs. ``scratch_dir`` gives the shared folder used to cut
lineage (``DataFrame.checkpoint``) and for intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession

# Settings that matter for every plan in this library, at any scale:
# adaptive execution re-plans joins from measured sizes, splits skewed
# shuffle partitions and merges small ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Sizing for a large cluster (applied by the batch jobs' entry point where
# the cluster has not set a value): 256 MiB scan splits and post-shuffle
# partitions keep task counts in the hundreds of thousands at 100 TB rather
# than near a million.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
}

# Shuffle partitions to start from. Adaptive execution merges small ones but
# does not split an even one, so their number follows the input's size; a
# shuffle keeps an index entry per task and partition, which bounds it from
# above (at 100 TB: 1.6 GB a partition for a shuffle of whole rows, which only
# the global sort of ``row_id`` and rebalanced writes make, and the latter split
# their partitions by size).
PARTITION_BYTES = 256 << 20
MIN_PARTITIONS, MAX_PARTITIONS = 200, 65536


def cluster_conf(input_bytes: int) -> dict[str, str]:
    """``CLUSTER_CONF`` with the shuffle partitions that an input of this size needs."""
    n = min(MAX_PARTITIONS, max(MIN_PARTITIONS, -(-input_bytes // PARTITION_BYTES)))
    return {**CLUSTER_CONF, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n)}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, asked from the file system its path names."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    return sum(fs.getContentSummary(f.getPath()).getLength() for f in fs.globStatus(at) or [])


def apply_defaults(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set each SQL setting only where the session does not have one yet."""
    for k, v in conf.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


# Context-level settings for sessions this library starts itself: remove a
# checkpoint's files once its DataFrame is garbage-collected on the driver.
CONTEXT_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(app_name: str = "facetspark", cores: int | str = "*",
                  shuffle_partitions: int = 8, extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured like the cluster one (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FACETSPARK_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**SCALE_CONF, **CONTEXT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM only; local-cluster has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder.

    Uses the folder the cluster names (``spark.checkpoint.dir``, or one set
    on the SparkContext). Only a local-mode session without one gets a fresh
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of a node. A session
    without a SparkContext (Spark Connect) must have the setting.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder (HDFS/S3/...)")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder (HDFS/S3/...) "
            "so that materialised intermediates survive executor loss")
    path = tempfile.mkdtemp(prefix="facetspark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def spread_target(df) -> int | None:
    """Partition count to spread ``df`` to for ``"auto"``: the default
    parallelism when ``df`` has fewer partitions, else None (leave it). None
    too when the session cannot tell (no SparkContext, as in Spark Connect).
    Meant for scans: on a frame with a shuffle, adaptive execution runs the
    shuffle stages to learn the partition count."""
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):
        return None
    return want if have < want else None


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"
