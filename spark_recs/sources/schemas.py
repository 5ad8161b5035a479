"""Explicit schemas for every dataset and checked Parquet / CSV I/O.

``spark.read.parquet(path, schema=...)`` silently ignores the schema, so
reads here either pass a StructType to ``read.schema`` or read the footer
and check it against the expected fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("user_name", T.StringType()),
])

TRACKS = T.StructType([
    T.StructField("recording_msid", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("recording_mbid", T.StringType()),
])

INTERACTIONS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("recording_msid", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# canonical log, one row per listen, day resolution
CANONICAL = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("recording_msid", T.StringType()),
    T.StructField("timestamp", T.DateType()),
    T.StructField("recording_mbid", T.StringType()),
])

SEQUENCED = T.StructType(CANONICAL.fields + [
    T.StructField("count", T.LongType()),
    T.StructField("row_number", T.LongType()),
])

RECS_LONG = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("rank", T.LongType()),
    T.StructField("item_id", T.LongType()),
])

FACTORS = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.FloatType())),
])


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, expected: T.StructType, strict_types: bool = False) -> DataFrame:
    """Select the expected columns, failing loudly when one is missing.

    With ``strict_types`` a type difference is an error; otherwise the
    column is cast to the declared type (as the declared DDL intends).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in expected.fields if f.name not in have]
    if missing:
        raise SchemaMismatch(f"missing columns {missing}; found {sorted(have)}")
    cols = []
    for f in expected.fields:
        if have[f.name] != f.dataType:
            if strict_types:
                raise SchemaMismatch(f"{f.name}: {have[f.name]} != {f.dataType}")
            cols.append(df[f.name].cast(f.dataType).alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def read_parquet(spark: SparkSession, path: str, expected: T.StructType | None = None,
                 strict_types: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    return check_schema(df, expected, strict_types) if expected is not None else df


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: list[str] | None = None) -> str:
    """Parquet sink; the default mode refuses to overwrite, like the source."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> str:
    """Writes the partitions that ``df`` holds in place of those under ``path``;
    other partitions stay (dynamic partition overwrite)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint root and read it
    back: lineage is cut (a lost executor re-reads instead of recomputing
    joins and shuffles), and later consumers get pruned columnar reads."""
    from spark_recs.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
