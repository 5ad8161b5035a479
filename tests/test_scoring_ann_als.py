"""Blocked scoring vs brute force, ANN properties, ALS behaviour."""

import numpy as np
from pyspark.sql import functions as F

from spark_recs.operators import ann, scoring


def _vectors(spark, n, d, seed, scale=False):
    rs = np.random.RandomState(seed)
    x = rs.standard_normal((n, d))
    if scale:  # unequal norms: inner product order differs from cosine order
        x *= rs.uniform(0.2, 3.0, (n, 1))
    rows = [(i, [float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>"), x


def _brute(U, V, k, ub=None, ib=None, exclude=()):
    S = U @ V.T
    if ub is not None:
        S = S + ub[:, None] + ib[None, :]
    out = {}
    for u in range(S.shape[0]):
        cand = [(-S[u, i], i) for i in range(S.shape[1]) if (u, i) not in exclude]
        out[u] = [i for _, i in sorted(cand)[:k]]
    return out


def test_blocked_topk_matches_brute_force(spark):
    users, U = _vectors(spark, 37, 8, 1)
    items, V = _vectors(spark, 53, 8, 2, scale=True)
    got = scoring.blocked_topk(users, items, 5, max_tile_cells=60, max_block=12).collect()
    by_user = {}
    for r in sorted(got, key=lambda r: (r.user_id, r.rank)):
        by_user.setdefault(r.user_id, []).append(r.item_id)
    assert by_user == _brute(U, V, 5)


def test_blocked_topk_biases_and_exclusions(spark):
    users, U = _vectors(spark, 20, 6, 3)
    items, V = _vectors(spark, 30, 6, 4)
    ex_pairs = {(u, (u * 7) % 30) for u in range(20)} | {(3, i) for i in range(25)}
    ex = spark.createDataFrame(sorted(ex_pairs), "user_id long, item_id long")
    got = scoring.blocked_topk(users, items, 4, user_bias=F.col("id") % 7 / 100.0,
                               item_bias=F.col("id") % 11 / 100.0, exclude=ex, max_tile_cells=40, max_block=8).collect()
    by_user = {}
    for r in sorted(got, key=lambda r: (r.user_id, r.rank)):
        by_user.setdefault(r.user_id, []).append(r.item_id)
    ub = np.arange(20) % 7 / 100.0
    ib = np.arange(30) % 11 / 100.0
    assert by_user == _brute(U, V, 4, ub, ib, ex_pairs)


def test_ann_zero_bits_is_exact(spark):
    vecs, X = _vectors(spark, 40, 5, 5, scale=True)
    got = ann.ann_topk(vecs, vecs, 3, tables=1, bits=0, seed=0)
    exact = scoring.blocked_topk(vecs, vecs, 3, exclude_self=True, max_tile_cells=100, max_block=16)
    a = {(r.user_id, r.rank, r.item_id) for r in got.collect()}
    b = {(r.user_id, r.rank, r.item_id) for r in exact.collect()}
    assert a == b


def test_ann_recall_grows_with_tables(spark):
    vecs, _ = _vectors(spark, 150, 8, 6, scale=True)
    exact = scoring.blocked_topk(vecs, vecs, 5, exclude_self=True)
    recalls = []
    for tables in (1, 4, 12):
        approx = ann.ann_topk(vecs, vecs, 5, tables=tables, bits=4, flips=0, seed=3, complete=False)
        recalls.append(ann.recall_at_k(approx, exact).first()["recall"])
    assert recalls[0] <= recalls[1] <= recalls[2]
    assert recalls[2] > 0.5


def test_ann_salting_keeps_lists(spark):
    vecs, _ = _vectors(spark, 60, 4, 7)
    plain, salted = (ann.ann_topk(vecs, vecs, 5, tables=3, bits=2, seed=11, bucket_rows=n).select("user_id", "rank", "item_id")
                     for n in (10**9, 3))
    assert sorted(plain.collect()) == sorted(salted.collect())


def test_ann_lists_are_full_and_bits_grow_with_the_items(spark):
    vecs, _ = _vectors(spark, 60, 4, 8)
    got = ann.ann_topk(vecs, vecs, 10, tables=1, bits=6, flips=0, seed=2)  # a bucket holds about one
    assert {r["count"] for r in got.groupBy("user_id").count().collect()} == {10} and got.select("user_id").distinct().count() == 60
    assert len(ann.ann_topk(vecs, vecs, 100, tables=2, seed=2).collect()) == 60 * 59
    assert [ann.index_bits(n) for n in (0, 256, 257, 512, 513, 10**6)] == [0, 0, 1, 1, 2, 12]
    assert len(ann.probe_masks(5, 2)) == 1 + 5 + 10
    part = ann.hyperplanes(4, 3, 2, 5)
    assert (part == ann.hyperplanes(4, 3, 6, 5)[:, :2]).all()
    share = [ann.candidate_counts(vecs, vecs, tables=2, seed=2, bits=b, flips=1).agg(F.avg("n_candidates")).first()[0] for b in (1, 4)]
    assert share[0] > share[1]


def test_als_seeded_fit_is_reproducible_and_unseen_excludes(spark):
    from spark_recs.operators import als
    rs = np.random.RandomState(0)
    rows = sorted({(int(u), int(i)) for u, i in zip(rs.randint(0, 30, 400), rs.randint(0, 40, 400))})
    counts = spark.createDataFrame([(u, i, 1 + (u + i) % 3) for u, i in rows],
                                   "user_id long, track_id long, interactions_count long").persist()
    p = als.ALSParams(rank=4, max_iter=3)
    f1 = als.fit(counts, p).userFactors.orderBy("id").collect()
    f2 = als.fit(counts, p).userFactors.orderBy("id").collect()
    assert [r.features for r in f1] == [r.features for r in f2]
    model = als.fit(counts, p)
    recs = als.recommend_unseen(model, counts, 10)
    assert recs.join(counts, ["user_id", "track_id"]).count() == 0
    n_items = counts.select("track_id").distinct().count()
    per_user = {r.user_id: r.n for r in recs.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    seen = {r.user_id: r.n for r in counts.groupBy("user_id").agg(F.count("*").alias("n")).collect()}
    assert per_user == {u: min(10, n_items - s) for u, s in seen.items()}
    exact = scoring.blocked_topk(model.userFactors.select("id", F.col("features").cast("array<double>").alias("features")),
                                 model.itemFactors.select("id", F.col("features").cast("array<double>").alias("features")), 5)
    lib = als.recommend_all(model, 5, method="library")
    a = {(r.user_id, r.item_id) for r in exact.collect()}
    b = {(r.user_id, r.track_id) for r in lib.collect()}
    assert len(a & b) / len(b) > 0.95  # float32 library scores vs float64 here


def test_model_store_keeps_item_map(spark):
    from spark_recs.operators import als
    counts = spark.createDataFrame([(u, i, 1) for u in range(6) for i in range(5) if (u + i) % 2 == 0],
                                   "user_id long, track_id long, interactions_count long")
    imap = spark.createDataFrame([(i, f"mb-{i}") for i in range(5)], "track_id long, recording_mbid string")
    p = als.ALSParams(rank=2, max_iter=2)
    path = als.save_in_store(als.fit(counts, p), p, item_map=imap)
    model, stored = als.load_from_store(path)
    assert sorted(stored.collect()) == sorted(imap.collect())
    decoded = als.decode_recs(als.recommend_all(model, 2), stored)
    assert decoded.filter(F.col("recording_mbid").isNull()).count() == 0
    bare = als.save_in_store(model, p)
    assert als.load_from_store(bare)[1] is None


def test_users_beyond_int_are_encoded_and_decoded(spark):
    from spark_recs.operators import als
    big = 2**40
    rows = [(big + u, i, 1 + (u * i) % 3) for u in range(8) for i in range(6) if (u + i) % 3]
    counts = spark.createDataFrame(rows, "user_id long, track_id long, interactions_count long")
    enc, umap = als.encode_users(counts)
    als.check_int_ids(enc)
    assert umap.count() == 8
    model = als.fit(enc, als.ALSParams(rank=2, max_iter=2))
    recs = als.decode_users(als.recommend_all(model, 3), umap)
    got = {r.user_id for r in recs.select("user_id").distinct().collect()}
    assert got == {big + u for u in range(8)}
    assert recs.columns[0] == "user_id"


def test_blocks_copy_each_vector_a_few_times():
    bu, bi = scoring.block_counts(8_000, 23_000_000, 400)
    assert bu <= 2 and bi <= 400
    bu, bi = scoring.block_counts(1_000_000, 1_000_000, 400)
    assert bu <= 32 and bi <= 32 and bu * bi >= 256


def test_tile_scores_stay_within_the_bound(monkeypatch):
    import numpy as np
    import pandas as pd
    seen = []
    plain = scoring._rows_topk
    monkeypatch.setattr(scoring, "_rows_topk", lambda s, i, k: seen.append(s.size) or plain(s, i, k))
    side = lambda n, c: pd.DataFrame({c: range(n), "features": [np.ones(3) * j for j in range(n)], "bias": 0.0})
    out = scoring._tile_topk(2, False, max_tile_cells=50)(side(30, "user_id"), side(20, "item_id").assign(kind=0, user_id=None))
    assert max(seen) <= 50 and len(out) == 60


def test_streamed_lists_with_repeated_ids_ties_and_left_out_pairs(spark):
    rs = np.random.RandomState(9)
    U, V = rs.randint(-3, 4, (30, 4)).astype(float), rs.randint(-3, 4, (60, 4)).astype(float)  # many equal scores
    users = spark.createDataFrame([(i, [float(x) for x in U[i]]) for i in range(30)], "id long, features array<float>")
    items = spark.createDataFrame([(i, [float(x) for x in V[i]]) for i in range(60)], "id long, features array<float>")
    left_out = {(u, i) for u in range(30) for i in range(60) if (u * 7 + i) % 3 == 0}
    ex = spark.createDataFrame(sorted(left_out), "user_id long, item_id long")
    for bu, bi in ((1, 1), (3, 1), (2, 3)):
        rows = items.selectExpr("id AS item_id", "features", "0D AS bias", "0D AS place")
        got = scoring.stream_topk(scoring.user_rows(users.repartition(4)), rows.repartition(3), 6, bu, bi, exclude=ex).collect()
        by_user = {}
        for r in sorted(got, key=lambda r: (r.user_id, r["rank"])):
            by_user.setdefault(r.user_id, []).append(r.item_id)
        assert by_user == _brute(U, V, 6, exclude=left_out)
    # rows of one user are one list
    twice = scoring.blocked_topk(users.unionByName(users), items, 6).groupBy("user_id").count().collect()
    assert {r["count"] for r in twice} == {6}


def test_streamed_kernel_drops_unusable_rows_and_survives_large_values():
    run = lambda U, V, **kw: list(_kernel(U, V, 3, **kw))
    rs = np.random.RandomState(1)
    U, V = rs.standard_normal((50, 5)), rs.standard_normal((3000, 5))
    V[7], U[3] = np.nan, np.inf
    got = run(U, V)
    S = np.where(np.isfinite(S := np.nan_to_num(U, posinf=0) @ np.nan_to_num(V).T), S, -np.inf)
    S[:, 7] = -np.inf
    want = {u: np.lexsort((np.arange(3000), -S[u]))[:3].tolist() for u in range(50) if u != 3}
    assert {u: [i for v, _, i in got if v == u] for u in want} == want and 3 not in {u for u, _, _ in got}
    # beyond single precision
    big = run(U * 1e25, V * 1e25)
    assert [(u, i) for u, _, i in big] == [(u, i) for u, _, i in got]


def _kernel(U, V, k, step=700):
    none = [np.array([], np.int64)] * 2
    lists = scoring._Lists(np.arange(len(U)), U, np.zeros(len(U)), np.full(len(U), -np.inf), none, k, False, False, 1 << 20)
    for a in range(0, len(V), step):
        lists.meet(np.arange(a, min(a + step, len(V))), V[a: a + step], np.zeros(len(V[a: a + step])))
    for cols in lists.lists():
        yield from zip(*(c.tolist() for c in cols[:3]))


def _plan_text(df):
    return df._jdf.queryExecution().toString()


def test_lists_leave_the_task_once_and_nothing_is_broadcast_or_paired(spark):
    """Neither pairs of blocks nor probed buckets travel: one exchange, whose rows
    are the users and, for each user block, the items."""
    vecs, _ = _vectors(spark, 400, 6, 12)
    exact = scoring.blocked_topk(vecs, vecs, 100, max_block=50)
    approx = ann.ann_topk(vecs, vecs, 100, tables=2, bits=4, seed=3, complete=False)
    bound = scoring.NormBound(vecs, vecs, 5, block=20)
    for df in (exact, approx, bound.first):
        assert "CoGroups" not in _plan_text(df)
    for df in (exact, approx):
        text = _plan_text(df).split("== Physical Plan ==")[1]
        assert text.count("Exchange ") == 1 and "Broadcast" not in text and "Window" not in text
    assert scoring.stream_blocks(900_000, 780_000, 12, 100) == (14, 1)
    assert scoring.stream_blocks(256, 23_000_000, 400, 100)[0] <= 4


def test_listed_scores_are_checked_where_the_items_are(spark):
    rs = np.random.RandomState(4)
    U, V = rs.standard_normal((50, 4)).astype(np.float32), rs.standard_normal((40, 4)).astype(np.float32)
    S = U.astype(np.float64) @ V.astype(np.float64).T
    listed = [rs.choice(40, 6, False).tolist() for _ in range(50)]
    rows = [(u, u % 2 == 0, U[u].tolist(), [*listed[u], 1000], [*(float(S[u, i]) + (0.1 if (u, n) == (7, 2) else 0.0) for n, i in enumerate(listed[u])), 1.0])
            for u in range(50)]
    lists = spark.createDataFrame(rows, "user_id long, flag boolean, features array<float>, items array<long>, scores array<double>").repartition(3)
    items = spark.createDataFrame([(i, V[i].tolist()) for i in range(40)], "id long, features array<float>")
    for block in (7, 1000):
        got = scoring.listed_products(lists, items, 1e-6, block).groupBy("user_id", "flag").agg(F.sum("n").alias("n"), F.sum("n_off").alias("off"))
        assert sorted(tuple(r) for r in got.collect()) == [(u, u % 2 == 0, 6, int(u == 7)) for u in range(50)]  # item 1000 is unknown


def test_recall_counts_pairs_and_shuffles_lists_once(spark):
    exact = spark.createDataFrame([(u, i) for u in range(5) for i in range(4)], "user_id long, item_id long")
    approx = spark.createDataFrame([(u, i) for u in range(4) for i in range(1, 6)], "user_id long, item_id long")
    r = ann.recall_at_k(approx, exact)
    assert _plan_text(r).split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1
    assert tuple(r.first()) == (12 / 20, 5)
    twice = ann.recall_at_k(approx.unionByName(approx), exact.unionByName(exact))
    assert tuple(twice.first()) == (48 / 64, 5)  # every pairing of the rows counts, as in a join
