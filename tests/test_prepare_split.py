"""Hand-made edge cases (FIXTURES.md part C) and split properties."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import Window

from spark_recs.operators import ids, prepare, split
from spark_recs.operators.sequence import dense_ids, sequence_within


def _tracks(spark):
    return spark.createDataFrame([
        ("m1", "A", "t1", None),      # mbid null -> canonical is msid
        ("m2", "A", "t2", "b2"),
        ("m3", "B", None, "b2"),      # mbid shared by two msids; null name
        ("m4", "B", "t4", "b4"),
    ], "recording_msid string, artist_name string, track_name string, recording_mbid string")


def _log(spark, rows):
    return spark.createDataFrame(
        [(u, m, dt.datetime(2000, 1, d, h)) for u, m, d, h in rows],
        "user_id long, recording_msid string, timestamp timestamp_ntz")


def test_canonical_ids_and_inner_join(spark):
    log = _log(spark, [(1, "m1", 1, 0), (1, "m2", 1, 0), (1, "m3", 2, 0), (1, "m9", 3, 0)])
    c = {(r.recording_msid, r.recording_mbid) for r in prepare.canonical_log(log, _tracks(spark)).collect()}
    assert c == {("m1", "m1"), ("m2", "b2"), ("m3", "b2")}  # m9 has no track row


def test_count_skips_null_names(spark):
    log = _log(spark, [(1, "m2", 1, 0), (1, "m3", 1, 0), (2, "m3", 1, 0)])
    got = {r.recording_mbid: r.interaction_count for r in prepare.item_interaction_counts(log, _tracks(spark)).collect()}
    assert got == {"b2": 1}


def test_split_sizes_and_null_user(spark):
    rows = []
    for user, n in ((1, 1), (2, 4), (3, 5), (4, 10)):
        rows += [(user, f"m{(i % 4) + 1}", 1 + i, 0) for i in range(n)]
    log = _log(spark, rows).unionByName(_log(spark, [(None, "m1", 1, 0)]))
    seq = split.temporal_sequence(prepare.canonical_log(log, _tracks(spark)))
    train = {r.user_id: r.n for r in split.train_split(seq).groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert train == {2: 3, 3: 4, 4: 8}
    val = {r.user_id: r.n for r in split.val_split(seq).groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert val == {1: 1, 2: 1, 3: 1, 4: 2}
    assert seq.filter(F.col("user_id").isNull()).count() == 0


def test_train_val_partition_the_log(spark):
    from conftest import SF_SMALL
    from spark_recs.plans.catalog import Tables
    t = Tables(spark, SF_SMALL)
    seq, tr, va = t.seq, t.train, t.val
    assert tr.count() + va.count() == seq.count()
    assert tr.join(va, ["user_id", "row_number"]).count() == 0
    rseq = split.random_sequence(t.canon)
    assert split.val_by_anti_join(rseq, split.train_split(rseq)).exceptAll(split.val_split(rseq)).count() == 0


def test_sequence_independent_of_partitions_and_hot_user(spark):
    # user 7 holds most rows (a hot group), with same-day ties
    rows = [(7, f"m{i % 4 + 1}", 1 + i % 9, 0) for i in range(400)] + [(u, "m1", 2, 0) for u in range(20)]
    canon = prepare.canonical_log(_log(spark, rows), _tracks(spark))
    w = Window.partitionBy("user_id").orderBy("timestamp", "recording_msid", "recording_mbid")
    expect = canon.withColumn("row_number", F.row_number().over(w).cast("long"))
    cols = ["user_id", "recording_msid", "timestamp", "recording_mbid", "row_number"]
    for n, cell in ((1, F.col("timestamp")), (64, F.col("timestamp")), (8, F.trunc("timestamp", "month")), (8, F.lit(0))):
        got = sequence_within(canon.repartition(n), ["user_id"], ["timestamp", "recording_msid", "recording_mbid"],
                              cell).select(*cols)
        assert got.exceptAll(expect.select(*cols)).count() == 0
        assert expect.select(*cols).exceptAll(got).count() == 0


def test_dense_ids_no_gaps_any_partitioning(spark):
    df = spark.createDataFrame([(f"k{i:04d}",) for i in range(0, 3000, 3)] * 2, "key string")
    for n in (1, 7, 32):
        m = dense_ids(df, "key", "id", 1, n)
        got = sorted((r.id, r.key) for r in m.collect())
        assert [g[0] for g in got] == list(range(1, 1001))
        assert [g[1] for g in got] == sorted(g[1] for g in got)


def test_cold_item_dropped_on_inner_encode(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "track_id long, recording_mbid string")
    test = spark.createDataFrame([(1, "a"), (1, "zz")], "user_id long, recording_mbid string")
    assert ids.encode(test, m, "recording_mbid", "inner").count() == 1
    assert ids.encode(test, m, "recording_mbid", "left").filter(F.col("track_id").isNull()).count() == 1


def test_popularity_tie_break(spark):
    from spark_recs.operators import popularity
    rows = [(u, f"i{j}") for j in range(5) for u in range(3)]  # all items tie
    df = spark.createDataFrame(rows, "user_id long, recording_mbid string")
    top = popularity.popularity(df, "interactions", 2).orderBy("rank").collect()
    assert [r.recording_mbid for r in top] == ["i0", "i1"]


def test_sampling_by_user_keeps_whole_users(spark):
    from conftest import SF_SMALL
    from spark_recs.plans.catalog import Tables
    tr = Tables(spark, SF_SMALL).train
    s = split.sample(tr, 50, 45, by="user")
    kept = s.select("user_id").distinct()
    assert tr.join(kept, "user_id", "left_semi").count() == s.count()
    assert 0 < kept.count() < tr.select("user_id").distinct().count()
