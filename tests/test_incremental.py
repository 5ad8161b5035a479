"""Stored tables that grow: daily sink, day sketches, bitmaps, id map, bucketed log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spark_recs.operators import bitmaps, ids, profiles, split
from spark_recs.plans.inspect import executed_plan
from spark_recs.session import scratch_path
from spark_recs.sources import bucketed, daily

D = [dt.date(2024, 1, d) for d in range(1, 9)]
LOG = "user_id long, recording_mbid string, timestamp date"


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def test_a_day_written_twice_is_there_once(spark):
    path = scratch_path(spark, "days")
    first = _log(spark, [(u, f"i{u}", D[u % 3]) for u in range(30)])
    assert daily.write_days(first, path) == {D[0]: 10, D[1]: 10, D[2]: 10}
    daily.write_days(first.filter(F.col("timestamp") == D[1]), path)
    assert sorted(daily.read_days(spark, path, first.schema).collect()) == sorted(first.collect())
    late = _log(spark, [(99, "late", D[1]), (98, None, D[5])])
    daily.write_days(late, path, tasks_per_day=3)
    kept = first.filter(F.col("timestamp") != D[1]).unionByName(late)
    assert sorted(map(str, daily.read_days(spark, path, first.schema).collect())) == sorted(map(str, kept.collect()))
    assert daily.read_days(spark, path, first.schema, [D[5]]).collect() == [(98, None, D[5])]
    with pytest.raises(Exception, match="a row has no day"):
        daily.write_days(_log(spark, [(1, "x", None)]), path)
    assert daily.write_days(first.limit(0), path) == {}


def test_a_day_that_lost_or_gained_rows_is_refused(spark):
    path = scratch_path(spark, "days")
    log = _log(spark, [(u, "i", D[u % 2]) for u in range(10)])
    daily.write_days(log, path)
    log.limit(1).withColumn("part_day", F.lit(D[0])).write.mode("append").partitionBy("part_day").parquet(f"{path}/rows")
    with pytest.raises(daily.DayMismatch, match="2024-01-01 holds 6 rows, 5 were written"):
        daily.read_days(spark, path, log.schema)
    assert daily.read_days(spark, path, log.schema, [D[1]]).count() == 5
    daily.write_days(log, path)
    assert daily.read_days(spark, path, log.schema).count() == 10


def test_day_sketches_merge_within_the_rank_error(spark):
    path = scratch_path(spark, "sketches")
    rows = spark.range(60_000).select((F.col("id") % 9_000).alias("user_id"), F.lit("i").alias("recording_mbid"),
                                      F.element_at(F.array(*[F.lit(d) for d in D]), (F.pmod(F.xxhash64("id"), F.lit(8)) + 1).cast("int")).alias("timestamp"))
    rows = rows.unionByName(rows.filter("user_id < 300"))
    profiles.add_days(rows.filter(F.col("timestamp") < D[6]), path, k=256)
    before = {r["day"]: bytes(r["sketch"]) for r in profiles.stored_sketches(spark, path).collect()}
    profiles.add_days(rows.filter(F.col("timestamp") >= D[6]), path, k=256)
    after = {r["day"]: bytes(r["sketch"]) for r in profiles.stored_sketches(spark, path).collect()}
    assert set(before) == set(D[:6]) and {d: after[d] for d in before} == before and set(after) == set(D)
    counts = profiles.user_day_counts(rows)
    merged = profiles.merged_profile(profiles.stored_sketches(spark, path), k=256)
    r = merged.first()
    assert r["n_days"] == 8 and r["n_values"] == counts.count()
    errors = profiles.rank_errors(merged, counts)
    assert len(errors) == len(profiles.PERCENTILES) and max(errors.values()) < 0.03
    # a wrong answer is seen
    off = merged.withColumn("p50", F.lit(10**6))
    assert profiles.rank_errors(off, counts)["p50"] == pytest.approx(0.5)


def test_bitmaps_count_distinct_users_over_any_days(spark):
    path = scratch_path(spark, "bitmaps")
    rows = [(u * 7919 % 100_000, f"i{u % 5}", D[u % 4]) for u in range(4_000)] * 2 + [(3, None, D[0]), (40_000, "i0", D[3])]
    log = _log(spark, rows).withColumn("user_idx", F.col("user_id"))
    for d in D[:4]:
        schema = bitmaps.add_days(log.filter(F.col("timestamp") == d), path)
    stored = bitmaps.stored_bitmaps(spark, path, schema)
    want = lambda x: {tuple(r) for r in x.groupBy("recording_mbid").agg(F.countDistinct("user_id")).collect()}
    assert {tuple(r) for r in bitmaps.distinct_users(stored).collect()} == want(log)
    two = F.col("day").isin(D[1:3])
    assert {tuple(r) for r in bitmaps.distinct_users(stored.filter(two)).collect()} == want(log.filter(F.col("timestamp").isin(D[1:3])))


def test_a_lone_listener_costs_a_few_bytes_not_a_whole_bitmap(spark):
    log = _log(spark, [(u * 1_000, f"i{u}", D[0]) for u in range(50)]).withColumn("user_idx", F.col("user_id"))
    rows = bitmaps.day_bitmaps(log)
    assert rows.schema["listeners"].dataType.simpleString() == "bigint" and rows.count() == 50
    assert bitmaps.distinct_users(rows).agg(F.sum("n_users")).first()[0] == 50


def test_growing_id_map_is_dense_and_stable(spark):
    path = scratch_path(spark, "map")
    batch = lambda ks: spark.createDataFrame([(k,) for k in ks], "recording_mbid string")
    first = {tuple(r) for r in ids.grow_id_map(batch(["c", "a", "b", "a", None]), path, 0).collect()}
    assert first == {(1, "a", 0), (2, "b", 0), (3, "c", 0)}
    for _ in range(2):  # a repeated batch writes the same rows
        second = {tuple(r) for r in ids.grow_id_map(batch(["b", "0", "z", "z"]), path, 1).collect()}
        assert second == first | {(4, "0", 1), (5, "z", 1)}
    assert {tuple(r) for r in ids.grow_id_map(batch(["a", None]), path, 2).collect()} == second
    assert {tuple(r) for r in ids.grow_id_map(batch(["y"]), path, 3).collect()} == second | {(6, "y", 3)}
    for wrong in (1, 5):
        with pytest.raises(ids.BatchGap):
            ids.grow_id_map(batch(["q"]), path, wrong)


def test_bucketed_log_is_numbered_and_counted_without_a_shuffle_of_listens(spark):
    rows = [(u % 7, f"ms{u}", D[u % 5], f"mb{u % 11}") for u in range(600)] + [(1, "m", D[0], "b")] * 3
    canon = spark.createDataFrame(rows, "user_id long, recording_msid string, timestamp date, recording_mbid string")
    log = bucketed.read_bucketed_log(spark, bucketed.write_bucketed_log(canon, 4))
    seq = split.temporal_sequence(log)
    assert sorted(map(tuple, seq.collect())) == sorted(map(tuple, split.temporal_sequence(canon).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(split.temporal_sequence(log))
        assert "Bucketed: true" in plan
        # what is exchanged is one row per cell: its keys and count, no listen's columns
        exchanged = [ln for ln in plan.splitlines() if ln.startswith("Arguments: hashpartitioning(user_id")]
        assert exchanged and all("_cell" not in ln for ln in exchanged)
        by_user = bucketed.read_bucketed_log(spark, bucketed.write_bucketed_log(canon, 4, by=("user_id",)))
        assert "hashpartitioning(user_id" not in executed_plan(split.temporal_sequence(by_user))
        assert "Exchange" not in executed_plan(bucketed.user_counts(by_user))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    counts = {tuple(r) for r in bucketed.user_counts(log).collect()}
    assert counts == {tuple(r) for r in canon.groupBy("user_id").count().collect()}


def test_one_user_and_one_day_is_numbered_by_many_tasks(spark):
    rows = spark.range(20_000).select(F.lit(1).cast("long").alias("user_id"), F.format_string("ms%05d", F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("recording_msid"),
                                      F.lit(D[0]).alias("timestamp"), F.lit("mb").alias("recording_mbid"))
    rows = rows.unionByName(spark.createDataFrame([(2, "a", D[0], "b"), (2, "a", D[1], None), (3, None, D[1], "x")],
                                                   "user_id long, recording_msid string, timestamp date, recording_mbid string"))
    got = split.temporal_sequence_by_quantiles(rows, cell_rows=1_000)
    assert sorted(map(str, got.collect())) == sorted(map(str, split.temporal_sequence(rows).collect()))
    from spark_recs.operators.sequence import with_quantile_cells
    sizes = with_quantile_cells(rows, ["user_id"], "timestamp", ["recording_msid", "recording_mbid"], cell_rows=1_000) \
        .filter("user_id = 1").groupBy("_cell").count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) < 3_000
