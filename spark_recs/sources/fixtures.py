"""Views of /root/testdata shaped like the recommender's inputs.

The TPC-H-like tables stand in for the listening log (see FIXTURES.md):
``part`` -> tracks, ``orders`` x ``lineitem`` -> interactions,
``customer`` -> users, ``events`` -> a second interaction source and
``embeddings`` -> latent factor vectors.  Each view is defined twice, as a
DataFrame and as DuckDB SQL text, and the two must agree.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_recs.sources import schemas

# Fixed values of the fixture mapping (FIXTURES.md part B).
NULL_NAME_MOD = 13          # key % 13 == 0 -> null track_name
MBID_MOD, MBID_BELOW = 10, 7  # key % 10 < 7 -> mbid present, shared by key pairs
TEST_CUTOFF = dt.datetime(2000, 6, 1)  # listens on/after this day form the test set


#: What is read of each table; a declared schema saves a job over the footers per read.
COLUMNS = {
    "part": "p_partkey long, p_name string, p_brand string",
    "customer": "c_custkey long, c_name string",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long",
    "events": "user_id long, props string, ts timestamp_ntz",
    "embeddings": "vec_id long, embedding array<float>",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    key = F.col("p_partkey")
    out = p.select(F.concat(F.lit("ms-"), key.cast("string")).alias("recording_msid"),
                   F.col("p_brand").alias("artist_name"),
                   F.when(key % NULL_NAME_MOD == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("p_name")).alias("track_name"),
                   F.when(key % MBID_MOD < MBID_BELOW,
                          F.concat(F.lit("mb-"), (key - key % 2).cast("string")))
                    .alias("recording_mbid"))
    return schemas.check_schema(out, schemas.TRACKS, strict_types=True)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))
    return schemas.check_schema(out, schemas.USERS, strict_types=True)


def all_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    out = (o.join(li, o.o_orderkey == li.l_orderkey)
            .select(F.col("o_custkey").alias("user_id"),
                    F.concat(F.lit("ms-"), F.col("l_partkey").cast("string")).alias("recording_msid"),
                    F.col("o_orderdate").alias("timestamp")))
    return schemas.check_schema(out, schemas.INTERACTIONS, strict_types=True)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training log (listens before the cutoff): train + validation."""
    return all_interactions(spark, sf_dir).filter(F.col("timestamp") < F.lit(TEST_CUTOFF))


def interactions_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out listens on or after the cutoff."""
    return all_interactions(spark, sf_dir).filter(F.col("timestamp") >= F.lit(TEST_CUTOFF))


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second source: (user_id, item_id, ts) from the ``events`` table."""
    ev = table(spark, sf_dir, "events").select("user_id", "props", "ts")
    return ev.select("user_id",
                     F.get_json_object("props", "$.k").cast("long").alias("item_id"),
                     "ts")


def factor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latent vectors (id, features array<float>) from ``embeddings``.

    Every vector is both a query and a candidate item; a query never
    matches itself.
    """
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


# Fixed bias rule for the biased scorer (FIXTURES.md part B).
USER_BIAS_MOD, ITEM_BIAS_MOD = 7, 11


def user_bias(id_col: str = "id"):
    return (F.col(id_col) % USER_BIAS_MOD) / F.lit(100.0)


def item_bias(id_col: str = "id"):
    return (F.col(id_col) % ITEM_BIAS_MOD) / F.lit(100.0)


# ---------------------------------------------------------------- SQL side
SQL_VIEWS = f"""
tracks AS (
  SELECT 'ms-' || CAST(p_partkey AS VARCHAR) AS recording_msid,
         p_brand AS artist_name,
         CASE WHEN p_partkey % {NULL_NAME_MOD} = 0 THEN NULL ELSE p_name END AS track_name,
         CASE WHEN p_partkey % {MBID_MOD} < {MBID_BELOW}
              THEN 'mb-' || CAST(p_partkey - p_partkey % 2 AS VARCHAR) END AS recording_mbid
  FROM part),
users_v AS (SELECT c_custkey AS user_id, c_name AS user_name FROM customer),
all_interactions AS (
  SELECT o_custkey AS user_id, 'ms-' || CAST(l_partkey AS VARCHAR) AS recording_msid,
         o_orderdate AS "timestamp"
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
interactions_v AS (SELECT * FROM all_interactions WHERE "timestamp" < TIMESTAMP '{TEST_CUTOFF:%Y-%m-%d}'),
interactions_test_v AS (SELECT * FROM all_interactions WHERE "timestamp" >= TIMESTAMP '{TEST_CUTOFF:%Y-%m-%d}'),
event_interactions AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts FROM events),
factors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)
"""
