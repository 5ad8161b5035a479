"""A daily table that can be written again: one partition per day, replaced as a
whole, with its row count kept beside it and checked on read.

A write replaces the days that it holds and no other (dynamic partition
overwrite), so a repeated or late run of a day leaves it once.  The write
observes how many rows it hands to the files; what the files then hold, counted
per day, must add up to that.  The counts are appended after the data, the last
one of a day holds, so that a run that died between the two is found on read,
as is a day that lost or gained files.

``unit``: days too small for files of their own are kept by month or year, and
then a month or year is what a write replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.sources.schemas import replace_partitions

_COUNTS = T.StructType([T.StructField("part_day", T.DateType()), T.StructField("n_rows", T.LongType()), T.StructField("written", T.TimestampType())])


class DayMismatch(ValueError):
    """Days whose rows differ from what was written."""


def _per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("part_day").agg(F.count(F.lit(1)).alias("n_rows"))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("part_day", T.DateType())])).parquet(f"{path}/rows")


def write_days(df: DataFrame, path: str, day: str = "timestamp", tasks_per_day: int = 1, unit: str = "day") -> dict:
    """Replaces the days of ``df`` (by its column ``day``) under ``path`` and
    returns {day: rows}.  A row without a day is an error.  A day is written by
    ``tasks_per_day`` tasks."""
    spark = df.sparkSession
    held = F.date_trunc(unit, F.col(day)).cast("date")
    rows = df.withColumn("part_day", F.when(held.isNotNull(), held).otherwise(F.raise_error(F.lit("a row has no day")).cast("date")))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(tasks_per_day))
    seen = Observation()
    rows = rows.repartition("part_day", salt).observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set("part_day").alias("days"))
    replace_partitions(rows, f"{path}/rows", ["part_day"])
    days = seen.get["days"]
    counts = _per_day(_stored(spark, path, df.schema).filter(F.col("part_day").isin(days))).collect() if days else []  # one row per day
    if sum(r["n_rows"] for r in counts) != seen.get["n"]:
        raise DayMismatch(f"{seen.get['n']} rows were written to {path}, its files hold {sum(r['n_rows'] for r in counts)}")
    told = spark.createDataFrame([(r["part_day"], r["n_rows"]) for r in counts], T.StructType(_COUNTS.fields[:2]))
    told.withColumn("written", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/counts")
    return {r["part_day"]: r["n_rows"] for r in counts}


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: Sequence | None = None) -> DataFrame:
    """The rows of ``days`` (default: all) in the columns of ``schema``, once
    each day's files hold the rows that were written."""
    rows, told = _stored(spark, path, schema), spark.read.schema(_COUNTS).parquet(f"{path}/counts")
    if days is not None:
        rows, told = (x.filter(F.col("part_day").isin(list(days))) for x in (rows, told))
    told = told.groupBy("part_day").agg(F.max_by("n_rows", "written").alias("told"))
    held = _per_day(rows).withColumnRenamed("n_rows", "held")
    wrong = held.join(told, "part_day", "full").filter(~F.col("held").eqNullSafe(F.col("told"))).orderBy("part_day").limit(5).collect()
    if wrong:
        raise DayMismatch(f"{path}: " + ", ".join(f"{r['part_day']} holds {r['held']} rows, {r['told']} were written" for r in wrong))
    return rows.select(*[f.name for f in schema.fields])
