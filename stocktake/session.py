"""Session construction and shared-folder settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (a side
# becomes a broadcast only once its shuffle output is measured below the
# threshold) and splits skewed sort-merge partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    # Delete reliable checkpoints (dense keys, split percentiles) once their
    # frames are garbage-collected, so the shared folder does not grow per job.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "stocktake", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle partition count should then be sized to the data (about
    128-256 MB of shuffle output per partition), not to the core count, and
    ``spark.sql.files.maxPartitionBytes`` (default 128 MB) bounds each scan
    task; AQE coalesces small shuffle partitions and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder used to cut lineage and stage files.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session. Only a local-mode session (tests, a laptop) without the setting
    gets a private temporary folder; a cluster session without it is an error,
    because a machine-local folder is not visible to other executors.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder (HDFS/S3/ABFS) "
                "for checkpoints and staged files")
        configured = tempfile.mkdtemp(prefix="stocktake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged files."""
    base = checkpoint_dir(spark)
    token = os.urandom(6).hex()
    return f"{base.rstrip('/')}/stocktake-{name}-{token}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop has them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    files, at = hadoop_path(spark, path)
    return files.exists(at)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder of ours."""
    files, at = hadoop_path(spark, path)
    files.delete(at, True)
