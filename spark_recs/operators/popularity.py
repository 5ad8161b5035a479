"""Popularity baselines: interactions, distinct listeners, damped ratio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values (as in the source): list length 100, damping beta 1000.
DEFAULT_K = 100
DEFAULT_BETA = 1000


def item_stats(df: DataFrame, item: str = "recording_mbid", user: str = "user_id") -> DataFrame:
    """(item, n_interactions, n_users) in one aggregation pass."""
    return (df.select(item, user).groupBy(item)
              .agg(F.count(item).alias("n_interactions"),
                   F.countDistinct(user).alias("n_users")))


def _score(stats: DataFrame, kind: str, beta: float, item: str) -> DataFrame:
    if kind == "interactions":
        s = F.col("n_interactions").cast("double")
    elif kind == "distinct_users":
        s = F.col("n_users").cast("double")
    elif kind == "damped":
        s = F.col("n_interactions") / (F.col("n_users") + F.lit(beta))
    else:
        raise ValueError(f"unknown popularity kind {kind!r}")
    return stats.select(item, s.alias("score"))


def top_k(scored: DataFrame, k: int = DEFAULT_K, item: str = "recording_mbid",
          partition: Sequence[str] = ()) -> DataFrame:
    """Best ``k`` by score (ties: smaller item id first), with a 1-based
    rank.  The row_number filter is planned as a partial per-task limit
    (WindowGroupLimit) before the exchange, so at most k rows per task and
    per partition key are shuffled."""
    w = Window.partitionBy(*partition).orderBy(F.desc("score"), F.asc(item))
    return (scored.withColumn("rank", F.row_number().over(w).cast("long"))
                  .filter(F.col("rank") <= k))


def popularity(df: DataFrame, kind: str = "interactions", k: int = DEFAULT_K,
               beta: float = DEFAULT_BETA, item: str = "recording_mbid",
               user: str = "user_id") -> DataFrame:
    """Top-k ranked list (item, score, rank) for one popularity score."""
    if kind == "interactions":
        stats = df.select(item).groupBy(item).agg(F.count(item).alias("n_interactions"))
    elif kind == "distinct_users":
        stats = df.select(item, user).groupBy(item).agg(F.countDistinct(user).alias("n_users"))
    else:
        stats = item_stats(df, item, user)
    return top_k(_score(stats, kind, beta, item), k, item)


def from_stats(stats: DataFrame, kind: str, k: int = DEFAULT_K, beta: float = DEFAULT_BETA,
               item: str = "recording_mbid") -> DataFrame:
    """Top-k ranked list from item statistics made elsewhere (``n_interactions``
    and / or ``n_users`` per item)."""
    return top_k(_score(stats, kind, beta, item), k, item)


def beta_sweep(df: DataFrame, betas: Sequence[float], k: int = DEFAULT_K,
               item: str = "recording_mbid", user: str = "user_id") -> DataFrame:
    """Damped top-k for several betas from one pass of item statistics:
    the beta list is exploded as a column (no join), then a per-beta
    top-k."""
    stats = item_stats(df, item, user)
    per_beta = stats.withColumn("beta", F.explode(F.array(*[F.lit(float(b)) for b in betas])))
    scored = per_beta.select("beta", item,
                             (F.col("n_interactions") / (F.col("n_users") + F.col("beta"))).alias("score"))
    return top_k(scored, k, item, partition=["beta"])


def as_list(ranked: DataFrame, item: str = "recording_mbid") -> DataFrame:
    """The ranked list (bounded by k) gathered into one ordered array, rank
    kept: one row (n_items, items)."""
    srt = F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col(item).alias("item"))))
    return ranked.agg(srt.alias("_s")).select(
        F.size("_s").cast("long").alias("n_items"),
        F.transform("_s", lambda s: s["item"]).alias("items"))
