"""Exact distinct listeners that merge: bitmaps over dense user ids.

A user is a bit: of bucket ``id div 64``, at ``id mod 64``.  The bitmaps of an
(item, day) are stored by day, one long per bucket that has a listener; those of
several days are OR-ed per (item, bucket), and an item's distinct listeners are
the set bits over its buckets.  A new day adds its own rows and reads no old
listen.  The work per item is split by bucket, so an item that everybody hears is
as many rows as there are buckets of users.

There are never more rows than listens, whatever the number of users; an item
with many listeners a day costs a row per 64 users.  Ids must be dense
(``ids.user_id_map`` or a growing map) so that buckets are full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.sources import daily


BUCKET_USERS = 64             # users of a bucket: the bits of a long


def day_bitmaps(listens: DataFrame, item: str = "recording_mbid", user_idx: str = "user_idx", day: str = "timestamp") -> DataFrame:
    """(item, bucket, listeners, day): one row per item, day and bucket of users."""
    idx = F.col(user_idx).cast("long")
    bits = listens.select(F.col(item), F.col(day).cast("date").alias("day"), F.shiftright(idx, 6).alias("bucket"),
                          F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(idx, F.lit(BUCKET_USERS)).cast("int")).alias("_bit"))
    return (bits.groupBy(item, "bucket", "day").agg(F.bit_or("_bit").alias("listeners"))
                .select(item, "bucket", "listeners", "day"))


def add_days(listens: DataFrame, path: str, item: str = "recording_mbid", user_idx: str = "user_idx", day: str = "timestamp",
             unit: str = "day", tasks_per_day: int = 1) -> T.StructType:
    """Stores the bitmaps of the days of ``listens`` under ``path``; ``unit`` and
    ``tasks_per_day`` as for ``daily.write_days``.  Returns the schema to read them with."""
    rows = day_bitmaps(listens, item, user_idx, day)
    daily.write_days(rows, path, "day", tasks_per_day, unit)
    return rows.schema


def stored_bitmaps(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return daily.read_days(spark, path, schema)


def distinct_users(bitmaps: DataFrame, item: str = "recording_mbid") -> DataFrame:
    """(item, n_users) over all days of ``bitmaps``."""
    merged = bitmaps.groupBy(item, "bucket").agg(F.bit_or("listeners").alias("_all"))
    return merged.groupBy(item).agg(F.coalesce(F.sum(F.bit_count("_all").cast("long")), F.lit(0)).alias("n_users"))
