"""A training-data pipeline over `documents`: quality rules, near-duplicate
removal, benchmark decontamination, surrogates for personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes as Parquet to the folder that all executors share and reads again as the
next stage's docs.  All stages but the last return the columns of documents.

Defined results: an empty table gives no rows; null and blank texts are rejected
by the quality rules; a null doc_id passes the second stage (linked with
nothing) and the others like any; rows repeated as a whole share their doc_id
and go or stay together; further columns of documents, whatever their names, are
kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spark_recs.llm import decontaminate, neardup, packing, pii, quality
from spark_recs.llm.queries import KEY, trusted
from spark_recs.llm.store import materialize
from spark_recs.llm.tokens import vocabulary_path

#: SQL can't express the token ids, the embedding or the surrogates.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep(docs, trusted(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (five-word shingles, a similarity of 0.8 or
    more) stays, the one with the smallest doc_id."""
    return neardup.keep_first(docs, k=5, num=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets become surrogates."""
    return pii.pseudonymize(docs, KEY)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its sequence and its place there."""
    return packing.pack_documents(docs, vocabulary_path(packing.VOCABULARY))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
