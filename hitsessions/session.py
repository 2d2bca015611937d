"""Session settings and the shared work folder.

Intermediate tables (staging of an upsert, checkpoints) live under the
folder the cluster names in ``spark.checkpoint.dir``. Only when that is
unset and Spark runs in local mode (tests, benchmarks) is a scratch
folder created here.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job here relies on. ANSI keeps integer overflow and bad
# dates as errors, like the original warehouse; AQE re-plans partition
# counts and skewed joins at run time.
JOB_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Batches that go to Python workers, whatever the size of a row.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    # Call-site capture for error messages costs several py4j calls per
    # Column function; off for jobs (read once per Python process).
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "hitsessions",
                  extra: dict | None = None) -> SparkSession:
    """A session with the settings of :data:`JOB_CONF`.

    What the submitter set stays: the master and the number of shuffle
    partitions are only set here when given, and without a submitted
    master the session is a local one (with few partitions).
    """
    SparkContext._ensure_initialized()  # what was submitted is known to the JVM only
    submitted = SparkConf()
    b = (SparkSession.builder.appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC"))
    if master is None and not submitted.contains("spark.master"):
        master = "local[*]"
    if master is not None:
        b = b.master(master)
        if shuffle_partitions is None and master.startswith("local") \
                and not submitted.contains("spark.sql.shuffle.partitions"):
            shuffle_partitions = 8
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared work folder: ``spark.checkpoint.dir`` when set."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    # Local mode only: a scratch folder on this machine is the shared folder.
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="hitsessions-"))
    return sc.getCheckpointDir().rstrip("/")


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder.

    A ``file:`` scheme is dropped only where plain paths are local files
    too, so that the path means the same place under any default file
    system.
    """
    root = shared_dir(spark)
    if root.startswith("file:") and spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
        root = root[len("file:"):]
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a work folder that is no longer needed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
