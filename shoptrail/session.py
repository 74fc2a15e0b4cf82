"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans shuffles at runtime (partition
# coalescing, skew-join splitting), and the session time zone is pinned so
# that DATE(ts) means the same day on every executor.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "shoptrail",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the library defaults.

    On a cluster the master and memory come from spark-submit; ``master`` is
    only used for local runs and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    and the master is one local JVM is a private scratch folder created; on a
    cluster an unset folder is an error, as executors would not share it.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="shoptrail-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of its file system; errors other than
    a missing path rise."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for written intermediates (landed tables, stream inputs,
    checkpoints, staging) under the shared checkpoint folder, grouped per
    application: ``<checkpoint dir>/shoptrail/<application id>/<name>``, so
    one application's scratch data can be dropped as a unit."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/shoptrail/{spark.sparkContext.applicationId}/{name}"
