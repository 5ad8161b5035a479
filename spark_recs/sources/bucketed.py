"""The canonical log as a bucketed table: written once, so that what reads it by
its bucket columns needs no shuffle of the listens.

Buckets are by (user, day).  Numbering a user's listens works on (user, day)
cells, so the windows read the buckets as they are; per-user totals exchange one
row per cell, never a listen.  A bucket by user alone would save that too, but a
user who holds a third of the log would be one task; ``by`` allows it where no
user is that heavy.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_recs.session import scratch_path

BY = ("user_id", "timestamp")


def write_bucketed_log(canon: DataFrame, buckets: int | None = None, by: tuple[str, ...] = BY, path: str | None = None) -> str:
    """Writes ``canon`` and returns the table's name.  Its files lie under
    ``path`` (default: the shared folder); one task writes one bucket, sorted."""
    spark = canon.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, "bucketed_log")
    name = f"canonical_log_{uuid.uuid4().hex[:12]}"
    order = [c for c in ("user_id", "timestamp", "recording_msid", "recording_mbid") if c in canon.columns]
    (canon.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*order).option("path", path).saveAsTable(name))
    return name


def read_bucketed_log(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def user_counts(log: DataFrame) -> DataFrame:
    """(user_id, n_listens): counted per (user, day) where the buckets are, then
    added; one row per cell travels."""
    cells = log.groupBy("user_id", "timestamp").agg(F.count(F.lit(1)).alias("_n"))
    return cells.groupBy("user_id").agg(F.sum("_n").alias("n_listens"))
