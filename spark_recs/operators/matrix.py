"""Count matrices, label sets, matrix shape and the COO interaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_matrix(df: DataFrame, keys=("track_id", "user_id"), out: str = "interactions_count",
                 counted: str | None = None) -> DataFrame:
    """``count(*)`` (or ``count(counted)``) per key tuple — partial
    aggregation before the shuffle, so a hot pair costs one row per task."""
    agg = F.count(F.lit(1)) if counted is None else F.count(counted)
    return df.groupBy(*keys).agg(agg.alias(out))


def label_rows(df: DataFrame, user: str = "user_id", item: str = "recording_mbid") -> DataFrame:
    """Label sets as rows: distinct (user, item) with the set size
    ``n_labels``.  Rows rather than one array per user, so a heavy user's
    set is never gathered into one value."""
    pairs = df.select(user, item).filter(F.col(item).isNotNull()).distinct()
    sizes = pairs.groupBy(user).agg(F.count(F.lit(1)).alias("n_labels"))
    return pairs.join(sizes, user)


def matrix_shape(df: DataFrame, user: str = "user_id", item: str = "recording_mbid",
                 approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row: number of distinct users and items."""
    if approx:
        f = lambda c: F.approx_count_distinct(c, rsd)
    else:
        f = F.countDistinct
    return df.agg(f(user).alias("num_users"), f(item).alias("num_items"))


def coo(df: DataFrame, user_map: DataFrame, item_map: DataFrame, user: str = "user_id",
        item: str = "recording_mbid", user_idx: str = "user_idx", item_idx: str = "item_idx",
        weight: str | None = None) -> DataFrame:
    """(user_idx, item_idx, weight): the sparse interaction matrix.

    Without ``weight`` every distinct pair weighs its number of listens;
    with it the weights are summed."""
    w = F.count(F.lit(1)) if weight is None else F.sum(weight)
    pairs = df.groupBy(user, item).agg(w.alias("weight"))
    return (pairs.join(user_map, user).join(item_map, item)
                 .select(user_idx, item_idx, "weight"))
