"""SparkSession settings the operators assume.

* ``spark.sql.session.timeZone=UTC``: every timestamp column is a UTC wall
  clock (``timestamp_ntz``); Paris time is derived explicitly, never from the
  session zone.
* AQE on, with skew-join splitting and partition coalescing: dimension joins
  are left to AQE's runtime size check (broadcast below the threshold,
  sort-merge above it), hot keys of big joins are split at run time.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast only below a measured size (Spark's default
    # 10 MB); never by hint on data that grows.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "linefold", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the settings above.

    On a cluster pass ``master=None`` and let the launcher decide; size
    ``shuffle_partitions`` to the data (about 128-256 MB of shuffle per task).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate may return a running session: pin the zone anyway.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


#: bytes of (compressed) input files for which a shuffle gets one more partition
BYTES_A_PARTITION = 4 << 20


def size_shuffles(spark: SparkSession, paths: Iterable[str], bytes_each: int = BYTES_A_PARTITION) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to the size of the input files, so
    that what a task sorts or groups in memory does not grow with the input;
    AQE joins the small partitions. A larger setting stays. Returns the setting."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        total += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bytes_each))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


#: bytes of (compressed) shuffle files up to which AQE joins partitions into one task
BYTES_A_TASK = 16 << 20


def bound_tasks(spark: SparkSession, most: int = BYTES_A_TASK) -> int:
    """Lower ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` to ``most``: a
    stage of wide lines sorts several times its (compressed) shuffle files in
    memory, and tasks of Spark's 64 MB write that to disk. A smaller setting
    stays. Returns the setting."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    n = min(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)), most)
    spark.conf.set(key, str(n))
    return n


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset (local tests) a fresh folder is made and set.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if not cur:
        cur = spark.sparkContext.getCheckpointDir()
    if cur:
        return cur
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="linefold-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


__all__ = ["build_session", "size_shuffles", "bound_tasks", "checkpoint_root", "is_local", "DEFAULT_CONF"]
