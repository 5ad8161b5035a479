"""Per-user sequences and train / validation / test splits, plus sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.functions.columns import hash_key, hash_unit, split_is_train, split_is_val
from spark_recs.operators.sequence import sequence_within, with_quantile_cells
from spark_recs.sources import schemas

SEQUENCE_COLUMNS = ["user_id", "recording_msid", "timestamp", "recording_mbid", "count", "row_number"]
# Fixed values (as in the source): random-split seed 2023, 80 % of each
# user's rows to train.
RANDOM_SEED = 2023
TRAIN_PERCENT = 80


def _sequenced(canon: DataFrame, order: list, cell, materialize: bool) -> DataFrame:
    # a null user has no per-user count and belongs to no split
    rows = canon.filter(F.col("user_id").isNotNull())
    seq = sequence_within(rows, ["user_id"], order, cell)
    seq = seq.select(*SEQUENCE_COLUMNS)
    # written only for callers that read it several times
    return schemas.materialize(seq, "sequenced") if materialize else seq


def temporal_sequence(canon: DataFrame, materialize: bool = False) -> DataFrame:
    """Number each user's listens by day; ties broken by every other column
    so the numbering is reproducible."""
    return _sequenced(canon, ["timestamp", "recording_msid", "recording_mbid"], F.col("timestamp"), materialize)


def temporal_sequence_by_quantiles(canon: DataFrame, cell_rows: int = 1_000_000) -> DataFrame:
    """``temporal_sequence`` where one user's listens of one day may be many:
    such a day is cut into parts by sampled quantiles of the listens' order."""
    order = ["recording_msid", "recording_mbid"]
    rows = with_quantile_cells(canon.filter(F.col("user_id").isNotNull()), ["user_id"], "timestamp", order, "_part", cell_rows)
    return sequence_within(rows, ["user_id"], ["timestamp", *order], F.col("_part")).select(*SEQUENCE_COLUMNS)


def random_sequence(canon: DataFrame, seed: int = RANDOM_SEED,
                    materialize: bool = False) -> DataFrame:
    """Number each user's listens in a seeded pseudo-random order (md5 of
    seed and row keys), independent of partitioning."""
    key = hash_key(seed, ["user_id", "recording_msid", "timestamp"])
    return _sequenced(canon.withColumn("_h", key),
                      ["_h", "recording_msid", "timestamp", "recording_mbid"], F.substring("_h", 1, 3), materialize)


def train_split(seq: DataFrame, pct: int = TRAIN_PERCENT) -> DataFrame:
    """First ``floor(pct% * count)`` rows of each user."""
    return seq.filter(split_is_train(pct=pct))


def val_split(seq: DataFrame, pct: int = TRAIN_PERCENT) -> DataFrame:
    return seq.filter(split_is_val(pct=pct))


def val_by_anti_join(seq: DataFrame, train: DataFrame) -> DataFrame:
    """Validation as everything not in train, keyed by (user_id, row_number)."""
    keys = train.select("user_id", "row_number")
    return seq.join(keys, ["user_id", "row_number"], "left_anti").select(*seq.columns)


def with_split_column(seq: DataFrame, pct: int = TRAIN_PERCENT) -> DataFrame:
    """Tag rows 'train' / 'val' so a write can partition by split and reads
    prune to one side."""
    return seq.withColumn("split", F.when(split_is_train(pct=pct), F.lit("train")).otherwise(F.lit("val")))


def cutoff_split(df: DataFrame, ts: str, cutoff) -> tuple[DataFrame, DataFrame]:
    """(before, on-or-after) a timestamp cutoff."""
    c = F.lit(cutoff)
    return df.filter(F.col(ts) < c), df.filter(F.col(ts) >= c)


def sample(df: DataFrame, percent: int, seed: int, by: str = "row",
           row_keys: Sequence[str] = ("user_id", "recording_msid", "timestamp"),
           user_col: str = "user_id") -> DataFrame:
    """Reproducible ``percent`` % subsample by a seeded hash bucket —
    of rows (``by="row"``) or of whole users (``by="user"``).  A map-only
    filter: no shuffle, no dependence on partitioning."""
    if by not in ("row", "user"):
        raise ValueError("by must be 'row' or 'user'")
    cols = list(row_keys) if by == "row" else [user_col]
    return df.filter(hash_unit(seed, cols, 100) < percent)
