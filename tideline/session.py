"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults for a session of our own.  ``shuffle.partitions`` is deliberately
# absent: on a cluster it is sized from the data (AQE coalesces from there).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tideline", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime settings our results depend on, on a session made elsewhere.

    Calendar columns are computed by shifting from UTC to an explicit ``tz``
    argument, so the session zone has to be UTC; keyed streaming state needs
    the RocksDB provider.
    """
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.adaptive.forceOptimizeSkewedJoin",
        "spark.sql.streaming.stateStore.providerClass",
    ):
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def partitions_for(spark: SparkSession, *paths: str, target_mb: int = 256, expansion: float = 3.0) -> int:
    """Number of shuffle partitions for the input files.

    Compressed columns grow by about ``expansion`` as rows.
    """
    needed = math.ceil(_size(spark, paths) * expansion / (target_mb * 1024 * 1024))
    return max(needed, spark.sparkContext.defaultParallelism)


def parts_for(spark: SparkSession, *paths: str, target_mb: int = 256) -> int:
    """Number of parts of the input files' keys, of which a job works on one after the other."""
    return max(math.ceil(_size(spark, paths) / (target_mb * 1024 * 1024)), 1)


def _size(spark: SparkSession, paths: Sequence[str]) -> int:
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    total = 0
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        total += folder.getFileSystem(jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return total


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the files of a shuffle are deleted as soon as the action that made them ends.

    Otherwise they stay until the driver collects garbage, which may be never:
    a job of many actions then needs disk for the shuffles of all of them.
    Streams started inside keep the setting.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def size_shuffle(spark: SparkSession, *paths: str, target_mb: int = 256, expansion: float = 3.0) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the size of the input files.

    AQE merges partitions that turn out small, so the number only has to be
    high enough.
    """
    partitions = partitions_for(spark, *paths, target_mb=target_mb, expansion=expansion)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def grow_shuffle(spark: SparkSession, *paths: str, target_mb: int = 64) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to what the input files need, so that a task's share does not grow with them.

    A larger number that is already set stays.
    """
    name = "spark.sql.shuffle.partitions"
    partitions = max(int(spark.conf.get(name)), partitions_for(spark, *paths, target_mb=target_mb))
    spark.conf.set(name, str(partitions))
    return partitions


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir``.  Only a local session without that
    setting falls back to a temporary folder; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tideline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created or deleted."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
