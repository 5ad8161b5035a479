"""Dense integer ids, encoding / decoding, and known-id filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.operators.sequence import dense_ids
from spark_recs.sources import schemas


def item_id_map(seq: DataFrame, item: str = "recording_mbid", out: str = "track_id",
                num_partitions: int | None = None) -> DataFrame:
    """(track_id, recording_mbid): 1..n in item order."""
    return dense_ids(seq.filter(F.col(item).isNotNull()), item, out, 1, num_partitions)


def item_id_map_sql(seq: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """The same map through SQL text over a view of the frame (bound to the
    statement, so that concurrent calls don't share a name).  The statement
    selects the distinct items; numbering uses the ranged offsets rather
    than ``row_number() over (order by ...)``, which needs one partition."""
    spark = seq.sparkSession
    distinct = spark.sql("SELECT DISTINCT recording_mbid FROM {tracks_df} WHERE recording_mbid IS NOT NULL",
                         tracks_df=seq.select("recording_mbid"))
    return dense_ids(distinct, "recording_mbid", "track_id", 1, num_partitions)


def user_id_map(df: DataFrame, user: str = "user_id", out: str = "user_idx",
                start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """(user_idx, user_id): dense from ``start`` in user-id order."""
    return dense_ids(df.filter(F.col(user).isNotNull()), user, out, start, num_partitions)


def encode(df: DataFrame, id_map: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach dense ids by joining the map on ``key``.  ``how="inner"``
    drops rows whose key is not in the map (cold items)."""
    return df.join(id_map, key, how)


def decode(df: DataFrame, id_map: DataFrame, id_col: str) -> DataFrame:
    return df.join(id_map, id_col, "left")


def known_only(df: DataFrame, reference: DataFrame, user: str = "user_id",
               item: str = "recording_mbid") -> DataFrame:
    """Rows whose user AND item both occur in ``reference`` (two semi joins
    against distinct keys)."""
    users = reference.select(user).distinct()
    items = reference.select(item).distinct()
    return df.join(users, user, "left_semi").join(items, item, "left_semi")


# ------------------------------------------------------------- growing map
class BatchGap(ValueError):
    """A batch out of turn."""


_BATCHES = T.StructType([T.StructField("n_new", T.LongType()), T.StructField("batch", T.IntegerType())])


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """The growing map stored under ``path``: (id, key, batch)."""
    return spark.read.parquet(f"{path}/map")


def grow_id_map(df: DataFrame, path: str, batch: int, key: str = "recording_mbid", out: str = "track_id", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Adds the keys of ``df`` that the map under ``path`` lacks, numbered in key
    order after its largest id, and returns the map (out, key, batch).

    Batches are numbered from 0, and each is a partition of the map.  A batch
    looks at earlier ones only, so that repeating the last one writes the same
    rows again: ids never move and stay dense.  A batch is refused while one
    before it is missing or once another followed."""
    spark = df.sparkSession
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    if batch:
        done = {r["batch"]: r["n_new"] for r in spark.read.schema(_BATCHES).parquet(f"{path}/batches").collect()}  # one row per batch
        if set(range(batch)) - set(done) or max(done) > batch:
            raise BatchGap(f"{path} holds the batches {sorted(done)}, so {batch} can't be next")
        start += sum(n for b, n in done.items() if b < batch)
        keys = keys.join(read_id_map(spark, path).filter(F.col("batch") < batch).select(key), key, "left_anti")
    new = dense_ids(keys, key, out, start, num_partitions).withColumn("batch", F.lit(batch))
    schemas.replace_partitions(new, f"{path}/map", ["batch"])
    n_new = read_id_map(spark, path).filter(F.col("batch") == batch).count()
    schemas.replace_partitions(spark.createDataFrame([(n_new, batch)], _BATCHES).coalesce(1), f"{path}/batches", ["batch"])
    return read_id_map(spark, path)
