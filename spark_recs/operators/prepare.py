"""Canonical log and the profile of the log (EDA)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.functions.columns import canonical_item, day

# Fixed percentile grid of the profile: 1-5 %, 10-95 % by 5, 95-100 %
# (the 95 % point appears once here; the source printed it twice).
PERCENTILES = [1, 2, 3, 4, 5] + list(range(10, 100, 5)) + [96, 97, 98, 99, 100]


def percentile_columns() -> list[str]:
    return [f"p{p:02d}" for p in PERCENTILES]


def canonical_log(interactions: DataFrame, tracks: DataFrame) -> DataFrame:
    """Listens joined to their track (inner: listens without a track row are
    dropped), day resolution, canonical item id in ``recording_mbid``."""
    t = tracks.select("recording_msid", "recording_mbid")
    return (interactions.select("user_id", "recording_msid", "timestamp")
            .join(t, "recording_msid")
            .select("user_id", "recording_msid", day("timestamp").alias("timestamp"),
                    canonical_item().alias("recording_mbid")))


def user_interaction_counts(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """Per known user: number of listens with a track id (``count(col)``).

    Equal to joining users with listens and counting, but both sides are
    aggregated to one row per user first (map-side combine), so a heavy
    user never skews the join; a user listed twice counts twice, as in the
    join."""
    listens = (interactions.groupBy("user_id")
               .agg(F.count("recording_msid").alias("_n")))
    known = users.groupBy("user_id").agg(F.count(F.lit(1)).alias("_m"))
    return listens.join(known, "user_id").select(
        "user_id", (F.col("_n") * F.col("_m")).alias("interaction_count"))


def item_interaction_counts(interactions: DataFrame, tracks: DataFrame) -> DataFrame:
    """Per canonical item: listens whose track has a name (``count`` skips
    null names).  Listens are counted per msid before the join, so a hot
    track costs one row per task."""
    listens = interactions.groupBy("recording_msid").agg(F.count(F.lit(1)).alias("_n"))
    t = tracks.select("recording_msid", "recording_mbid", "track_name")
    named = F.when(F.col("track_name").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    return (listens.join(t, "recording_msid")
            .groupBy(canonical_item().alias("recording_mbid"))
            .agg(F.sum(named).cast("long").alias("interaction_count")))


def percentile_profile(counts: DataFrame, col: str = "interaction_count",
                       accuracy: int = 10_000) -> DataFrame:
    """One row, one column per grid point, via ``percentile_approx`` (a
    mergeable sketch: partial aggregates per task, no global sort)."""
    qs = [p / 100.0 for p in PERCENTILES]
    arr = counts.agg(F.percentile_approx(col, qs, accuracy).alias("_p"))
    return arr.select(*[F.col("_p")[i].cast("long").alias(name)
                        for i, name in enumerate(percentile_columns())])
