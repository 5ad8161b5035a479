"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.scheduler.mode": "FAIR",  # jobs of concurrent threads share the slots; one thread's run in order
}


def build_session(master: str | None = None, app: str = "spark_recs",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; this only fills in what is unset.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM on this machine; local-cluster has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Reliable checkpoint directory shared by all executors.

    Taken from ``spark.checkpoint.dir`` when the cluster names one.  Only a
    local-mode session without that setting (tests, the bench) gets a
    private temporary directory; on a cluster an unset value is an error,
    because a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        conf = tempfile.mkdtemp(prefix="spark-recs-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint root for written tables / models."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
