"""Search effort tied to recall, the stored index, norm-bounded exact lists, the concurrent sweep."""

import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spark_recs.operators import als, ann, ann_index, scoring
from spark_recs.plans.inspect import executed_plan
from spark_recs.session import scratch_path

SIZES = (2_000, 20_000, 100_000)
N_QUERIES, K = 60, 100


@pytest.fixture(scope="module")
def sizes(spark):
    """{n: (items, queries, exact lists)}: unit vectors with the covariance of the
    embeddings table; the queries are further vectors of the same kind."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").toPandas()
    x = np.vstack(table["embedding"])
    rs, root = np.random.RandomState(1), np.linalg.cholesky(np.cov(x.T) + 1e-9 * np.eye(x.shape[1]))

    def frame(v, start):
        return spark.createDataFrame(pd.DataFrame({"id": np.arange(start, start + len(v)), "features": list(v)})).repartition(4)

    out = {}
    for n in SIZES:
        v = rs.standard_normal((n + N_QUERIES, x.shape[1])) @ root.T + x.mean(axis=0)
        v /= np.linalg.norm(v, axis=1)[:, None]
        s = v[n:] @ v[:n].T
        exact = {n + q: set(np.argsort(-s[q])[:K].tolist()) for q in range(N_QUERIES)}
        path = scratch_path(spark, "vectors")
        frame(v[:n], 0).write.parquet(path)
        out[n] = spark.read.parquet(path), frame(v[n:], n), exact
    return out


def _recall(recs, exact):
    rows = recs.select("user_id", "item_id").collect()
    assert len(rows) == len(exact) * K
    return sum(i in exact[u] for u, i in rows) / (len(exact) * K)


@pytest.mark.parametrize("n", SIZES)
@pytest.mark.parametrize("target", [0.9])
def test_hyperplane_search_reaches_its_recall(sizes, n, target):
    items, queries, exact = sizes[n]
    recs = ann.ann_topk(queries, items, K, tables=8, seed=20, exclude_self=False, recall=target)
    assert _recall(recs, exact) >= target


@pytest.mark.parametrize("n", SIZES)
def test_stored_index_reaches_its_recall_in_another_session(spark, sizes, n):
    items, queries, exact = sizes[n]
    path = ann_index.build(items, scratch_path(spark, "index"), k=K)
    other = spark.newSession()
    index = ann_index.load(other, path)
    there = other.createDataFrame(queries.toPandas(), queries.schema)
    probes = index.probes_for(0.9)
    print(n, "cells", len(index.sizes), "probes", probes, "items read", index.sizes[:].sum() and round(probes / len(index.sizes), 3))
    assert index.sizes.sum() == n and index.recalls == sorted(index.recalls)
    assert index.probes_for(0.5) <= probes
    assert _recall(ann_index.search(other, index, there, K, recall=0.9), exact) >= 0.9


def _small(spark, n, d, seed):
    rs = np.random.RandomState(seed)
    x = rs.standard_normal((n, d)) * rs.uniform(0.2, 3.0, (n, 1))
    return spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(n)], "id long, features array<double>")


def _pairs(df):
    return sorted((r.user_id, r["rank"], r.item_id) for r in df.select("user_id", "rank", "item_id").collect())


def test_index_reads_only_probed_cells_and_fills_lists(spark):
    vecs = _small(spark, 300, 6, 1)
    path = ann_index.build(vecs, scratch_path(spark, "index"), cells=12, k=5)
    index = ann_index.load(spark, path)
    lists = ann_index.read_postings(spark, index, [3, 7])
    files = [r[0] for r in lists.select(F.input_file_name()).distinct().collect()]
    assert files and all("/cell=3/" in f or "/cell=7/" in f for f in files)
    assert "PartitionFilters: [cell#" in executed_plan(lists)
    one = vecs.filter("id = 5")
    cells = {r.cell for r in ann_index.probed_cells(one, index, 1, 5).collect()}
    assert len(cells) < 4
    every = ann_index.search(spark, index, vecs, 5, probes=12, exclude_self=True, cell_rows=10)
    assert _pairs(every) == _pairs(scoring.blocked_topk(vecs, vecs, 5, exclude_self=True))
    # one probe, but full lists
    few = ann_index.search(spark, index, vecs, 60, probes=1, exclude_self=True)
    assert {r["count"] for r in few.groupBy("user_id").count().collect()} == {60}
    empty = ann_index.build(vecs.limit(0), scratch_path(spark, "index"))
    assert ann_index.search(spark, ann_index.load(spark, empty), vecs, 5).collect() == []


def test_rows_of_one_id_are_entries_of_their_own_in_the_index(spark):
    vecs = _small(spark, 80, 4, 2)
    twice = vecs.unionByName(vecs)
    index = ann_index.load(spark, ann_index.build(twice, scratch_path(spark, "index"), cells=4, k=6))
    got = ann_index.search(spark, index, twice, 6, probes=4, exclude_self=True)
    assert _pairs(got) == _pairs(scoring.blocked_topk(twice, twice, 6, exclude_self=True))
    once = ann.ann_topk(twice, twice, 6, tables=2, bits=1, seed=3)
    assert once.groupBy("user_id", "item_id").count().filter("count > 1").count() == 0


def test_effort_is_the_cheapest_that_reaches_the_share():
    assert ann._effort(2, [(1, 50), (2, 30), (4, 20)], 0.8) == (4, 2, 2)
    assert ann._effort(1, [(1, 50), (2, 30), (4, 20)], 0.81) == (4, 1, 4)
    margins = np.abs(np.random.RandomState(0).standard_normal((5, 3, 4)))
    cost = ann._probed(margins)
    assert cost.shape == (5, 3, 16) and (cost[:, :, 0] == 0).all()
    assert np.allclose(cost[:, :, 0b1010], margins[:, :, 1] ** 2 + margins[:, :, 3] ** 2)


def test_fitted_search_with_every_bucket_is_exact(spark):
    vecs = _small(spark, 120, 5, 3)
    got = ann.ann_topk(vecs, vecs, 7, tables=4, bits=3, seed=3, recall=1.0)
    assert _pairs(got) == _pairs(scoring.blocked_topk(vecs, vecs, 7, exclude_self=True))


@pytest.mark.parametrize("block", [7, 40, 10_000])
def test_norm_bounded_lists_are_exact_and_skip_products(spark, block):
    users, items = _small(spark, 40, 3, 4), _small(spark, 200, 3, 5)
    items = items.unionByName(items.filter("id < 30").withColumn("id", F.col("id") + 1000))  # equal norms
    search = scoring.NormBound(users, items, 4, block=block)
    assert _pairs(search.top_k()) == _pairs(scoring.blocked_topk(users, items, 4))
    p = search.products().first()
    assert p["n_products"] == 40 * 230 and p["n_scored"] <= p["n_products"]
    if block == 40:
        assert p["n_scored"] < 0.8 * p["n_products"]
    own = scoring.NormBound(users, users, 50, exclude_self=True, block=block)  # lists longer than the items
    assert _pairs(own.top_k()) == _pairs(scoring.blocked_topk(users, users, 50, exclude_self=True))


def test_norm_bound_of_empty_sides(spark):
    some = _small(spark, 5, 3, 6)
    for u, i in ((some.limit(0), some), (some, some.limit(0))):
        assert scoring.NormBound(u, i, 3).top_k().collect() == []


def test_concurrent_sweep_gives_the_same_rows_sooner(spark):
    rs = np.random.RandomState(2)
    rows = sorted({(int(u), int(i)) for u, i in zip(rs.randint(0, 60, 900), rs.randint(0, 50, 900))})
    schema = "user_id long, track_id long, interactions_count long"
    train = spark.createDataFrame([(u, i, 1 + (u + i) % 3) for u, i in rows], schema).persist()
    val = spark.createDataFrame([(u, i, 1) for u in range(60) for i in (u % 50, 70 + u % 3)], schema).persist()
    grid = [als.ALSParams(rank=r, reg=g, max_iter=3) for r in (3, 5) for g in (0.05, 0.1)]
    fixed = ["rank", "alpha", "reg", "max_iter", "precision_at_k", "map_at_k", "ndcg_at_k", "n_users", "val_rows", "cold_rows", "users_scored"]
    one = als.sweep(train, val, grid, 10).select(fixed).collect()
    t0 = time.perf_counter()
    many = als.sweep(train, val, grid, 10, concurrent=4)
    wall = time.perf_counter() - t0
    rounded = lambda rs_: [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rs_]
    assert rounded(many.select(fixed).collect()) == rounded(one)
    assert wall < many.agg(F.sum(F.col("train_time") + F.col("recommendation_time") + F.col("evaluation_time"))).first()[0]
    r = one[0]
    assert (r["val_rows"], r["cold_rows"], r["users_scored"]) == (120, 60, 60)


def test_a_sweep_ships_vectors_to_two_blocks_and_keeps_narrow_lists(spark, monkeypatch):
    fits, kept = [], []
    fit, evaluated = als.fit, als.metrics.per_user_metrics
    monkeypatch.setattr(als, "fit", lambda *a, **b: fits.append(fit(*a, **b)) or fits[-1])
    monkeypatch.setattr(als.metrics, "per_user_metrics", lambda recs, *a, **b: kept.append(recs.columns) or evaluated(recs, *a, **b))
    train = spark.createDataFrame([(u, i, 1) for u in range(20) for i in range(12) if (u + i) % 3], "user_id long, track_id long, interactions_count long")
    row = als.sweep(train, train, [als.ALSParams(rank=2, max_iter=1)], 5).first()
    assert fits[0].userFactors.rdd.getNumPartitions() == 2 and row["users_scored"] == 20
    assert kept == [["user_id", "rank", "item_id"]]


def test_als_blocks_follow_the_data():
    assert als.block_count(1_000, 8) == 8 and als.block_count(179_000_000, 8) == 45


def test_a_fit_has_few_blocks_however_many_slots(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda _: 16))
    counts = spark.createDataFrame([(u, i, 1 + (u + i) % 3) for u in range(40) for i in range(30) if (u + i) % 4 == 0],
                                   "user_id long, track_id long, interactions_count long").persist()
    model = als.fit(counts, als.ALSParams(rank=2, max_iter=2))
    assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == als.FIT_BLOCKS < 16
    assert (model.userFactors.count(), model.itemFactors.count()) == (40, 30)
    blocks = als.fit(counts, als.ALSParams(rank=2, max_iter=2, num_blocks=5)).userFactors.rdd.getNumPartitions()
    assert blocks == 5  # as asked for


def _alike(n, clusters, d, seed):
    way, rs = np.random.RandomState(0).standard_normal((clusters, d)), np.random.RandomState(seed)
    x = way[rs.randint(0, clusters, n)] + 0.05 * rs.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1)[:, None] * rs.uniform(0.9, 1.0, (n, 1))


def test_groups_of_like_direction_skip_products_and_keep_the_lists():
    U, V = _alike(1500, 12, 16, 1), _alike(6000, 12, 16, 2)   # norms alone exclude next to nothing
    rs = np.random.RandomState(3)
    none = [np.array([], np.int64)] * 2
    for ub, ib in ((np.zeros(1500), np.zeros(6000)), (rs.uniform(-1, 1, 1500), rs.uniform(-0.1, 0.1, 6000))):
        lists = scoring._Lists(np.arange(1500), U, ub, np.full(1500, -np.inf), none, 10, True, False, scoring.MAX_TILE_CELLS, bool(ib.any()))
        for a in range(0, 6000, 1000):
            lists.meet(np.arange(a, a + 1000), V[a: a + 1000], ib[a: a + 1000])
        got = {}
        for u, r, i, _ in (row for cols in lists.lists() for row in zip(*(c.tolist() for c in cols))):
            got.setdefault(u, {})[r] = i
        S = U @ V.T + ub[:, None] + ib[None, :]
        S[np.arange(1500), np.arange(1500)] = -np.inf
        want = [np.lexsort((np.arange(6000), -s))[:10].tolist() for s in S]
        assert [[got[u][r] for r in range(1, 11)] for u in range(1500)] == want
        assert sum(m * n for m, n in zip(lists.met, np.diff(lists.cuts))) < 0.5 * S.size


def test_probed_buckets_are_found_in_the_task(spark):
    """The bits are the buckets that are listed; neither buckets nor probes are
    exploded, so an item is one row for all tables."""
    X = np.random.RandomState(5).standard_normal((40, 6))
    X[3] = 0  # every cost is equal
    rows = pd.Series(list(X))
    planes = ann.hyperplanes(6, 3, 4, 7)
    every = np.arange(3 << 4)
    for bits, listed in ((ann.cheapest_bits(planes, 5), ann.probe_buckets(planes, 5)), (ann.flipped_codes(planes, 2), ann.flip_buckets(planes, 2))):
        want = [set(p) for p in listed.func(rows)]
        held = bits(X)
        codes = every.reshape(3, 16).T  # an item's buckets: one of each table
        for u in range(40):
            assert held.has(np.full(16, u), codes).tolist() == [any(int(b) in want[u] for b in c) for c in codes]
        assert held.union(0, 3)(codes).tolist() == [any(int(b) in want[0] | want[1] | want[2] for b in c) for c in codes]
    vecs = _small(spark, 200, 6, 8)
    plan = executed_plan(ann.ann_topk(vecs, vecs, 5, tables=8, bits=4, seed=3, complete=False))
    assert len(re.findall(r"^\(\d+\) Generate", plan, re.M)) == 2 and "probes" not in plan  # users by item slice, items by user block
