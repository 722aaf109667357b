"""Session helpers: recommended runtime settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid as _uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

# Runtime settings the reports rely on. Applied with ``tune`` only where the
# cluster has not set them already.
RECOMMENDED_CONF = {
    # Adaptive execution: coalesce small shuffle partitions, split skewed ones,
    # and turn joins whose measured side is small into broadcast joins.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key of a join although a grouping on the same key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession, overwrite: bool = False) -> SparkSession:
    """Apply ``RECOMMENDED_CONF`` where unset (or everywhere with ``overwrite``).

    The session time zone is left alone: every calendar computation of the
    library is epoch arithmetic in UTC (days = floor(seconds / 86400)), so
    results do not depend on it. Writers set partition-overwrite per write."""
    for key, value in RECOMMENDED_CONF.items():
        if overwrite or spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, largest_shuffle_bytes: int,
                  partition_bytes: int = 256 << 20) -> int:
    """Set the shuffle partition count so that the largest shuffle of a run
    (for the reports: the access log by file name, at most the bytes of its
    four columns) lands in partitions of about ``partition_bytes`` at any
    input size; AQE then coalesces the smaller shuffles towards the same
    advisory size. Returns the count set."""
    n = -(-int(largest_shuffle_bytes) // int(partition_bytes))
    n = max(spark.sparkContext.defaultParallelism, n)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    return n


TASK_BYTES = 16 << 20
# What AQE joins small partitions up to in the reports: a task that joins and groups the replicas
# takes some forty times as much memory (its sorts and hash tables).
JOINED_BYTES = 8 << 20
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def bound_tasks(spark: SparkSession, largest_shuffle_bytes: int, task_bytes: int = TASK_BYTES,
                joined_bytes: int | None = None) -> int:
    """Keep what one task sorts and groups at about ``task_bytes`` of shuffled data at any input
    size (in memory that is some forty times as much): raises the shuffle partition count as
    needed, never lowers it, and AQE coalesces, splits and deals skewed keys to that size, or to
    ``joined_bytes`` if given: the count comes from the most that the rows can take, so partitions
    turn out smaller and need not be joined again up to ``task_bytes``. Scans are split to
    ``task_bytes`` as well (never to more than is set): above
    ``spark.shuffle.sort.bypassMergeThreshold`` partitions a task holds the rows that it deals
    until they are written. Returns the count."""
    joined_bytes = joined_bytes or task_bytes
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(largest_shuffle_bytes) // int(task_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(joined_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(2 * joined_bytes))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(SPLIT_BYTES))
    spark.conf.set(SPLIT_BYTES, str(min(split, int(task_bytes))))
    return n


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "coldspot", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster and read here. Only when it is
    unset (tests, local runs) a folder of our own is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="coldspot-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/coldspot-{label}-{_uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []  # scratch paths handed out by this driver


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this driver has written; call it once their
    frames are no longer read. Returns how many there were."""
    n = len(_SCRATCH)
    while _SCRATCH:
        p, fs = _filesystem(spark, _SCRATCH.pop())
        fs.delete(p, True)
    return n


def input_bytes(spark: SparkSession, *paths: str | Sequence[str]) -> int:
    """Bytes of the files below the paths (globs and lists of paths allowed)."""
    total = 0
    for path in (p for some in paths for p in ([some] if isinstance(some, str) else some)):
        p, fs = _filesystem(spark, path)
        for status in fs.globStatus(p) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def fingerprint(spark: SparkSession, path: str) -> int:
    """Changes when a file right below ``path`` (or a table folder there) is added, replaced or
    removed: names, sizes and modification times."""
    p, fs = _filesystem(spark, path)
    return hash(tuple(sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p))))


__all__ = ["tune", "size_shuffles", "bound_tasks", "TASK_BYTES", "JOINED_BYTES", "SPLIT_BYTES", "local_session", "checkpoint_dir", "scratch_path",
           "clear_scratch", "input_bytes", "fingerprint", "RECOMMENDED_CONF"]
