"""Lexical search, exact top-k and whitening against brute force, and their edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.llm import lexical, topk, whitening

from tests.llm.helpers import docs_of  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_rank(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by the contract's words."""
    split = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in split), sum(len(w) for _, w in split)
    df = Counter(t for _, w in split for t in set(w))
    out = []
    merged = {}
    for item, text in dict.fromkeys(items):
        merged.setdefault(item, []).extend(terms(text))
    for item, want in merged.items():
        scored = []
        for doc, words in split:
            tf, score = Counter(words), 0
            for t in want:
                if tf[t]:
                    m = 100 - 75 + (75 * len(words) * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r))


def ranked(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("block_bytes", [1 << 22, 40])
def test_lexical_rank_equals_brute_force(spark, docs_of, block_bytes):  # noqa: F811
    rng = random.Random(5)
    words = ["Ab", "ab-c", "été", "ÉTÉ", "日本", "x1", "1", "q_r", "nul\x00l", "zz", "it's", "z"] + [f"w{i}" for i in range(30)]
    docs = [(i, rng.choice([" ", "\n", ", ", "\t"]).join(rng.choices(words, k=rng.randrange(40)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "... \n"), (7, docs[7][1]), (8, "ab ab ab"), (None, "ab zz"), (303, "ab " * 200_000 + "w3")]
    items = [(1, "ab zz zz"), (2, "W3 it's 日本 w3"), (3, None), (4, "?!"), (5, "nowhere"), (1, "ab zz zz"), (6, "w1"), (6, "w2 ab"), (None, "w4")]
    items += [(10 + i, " ".join(rng.choices(words, k=12))) for i in range(12)]
    table = docs_of(docs).withColumn("item_id", F.lit(1)).withColumn("score", F.lit("clash")).repartition(5)
    got = ranked(lexical.rank(table, spark.createDataFrame(items, ITEMS).withColumn("rank", F.lit("clash")), block_bytes=block_bytes))
    assert got == plain_rank(docs, items)


def test_lexical_boundaries_and_wide_sums(spark, docs_of):  # noqa: F811
    docs = [(1, "cat concat cats cat"), (2, "CAT"), (3, "dog"), (4, "dog catdog")]
    items = [(1, "cat"), (2, "dog cat " * 400_000)]  # sums beyond 2**53
    got = ranked(lexical.rank(docs_of(docs), spark.createDataFrame(items, ITEMS)))
    assert [r[2] for r in got if r[0] == 1] == [2, 1] or [r[2] for r in got if r[0] == 1] == [1, 2]
    assert got == plain_rank(docs, items)


def test_lexical_empty_tables(spark, docs_of):  # noqa: F811
    some = docs_of([(1, "a b")])
    assert lexical.rank(some.limit(0), spark.createDataFrame([(1, "a")], ITEMS)).collect() == []
    assert lexical.rank(some, spark.createDataFrame([], ITEMS)).collect() == []
    assert lexical.rank(docs_of([(1, "..."), (2, None)]), spark.createDataFrame([(1, "a")], ITEMS)).collect() == []


def plain_topk(rows, k=20, every=20):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        best = {}
        for i, a in ok:
            for j, b in ok:
                if i == q and j != q:
                    s = sum(x * y for x, y in zip(a, b))
                    best[j] = max(best.get(j, s), s)
        out += [(q, r, j, s) for r, (s, j) in enumerate(sorted(((s, j) for j, s in best.items()), key=lambda t: (-t[0], t[1]))[:k], 1)]
    return out


@pytest.mark.parametrize("block_rows, seed_rows", [(1 << 16, 1 << 13), (60, 25)])
def test_topk_equals_brute_force(spark, block_rows, seed_rows):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=40) * rng.choice([0.1, 1, 4])).tolist()) for i in range(260)]
    rows += [(1000 + i, [0.5] * 40) for i in range(50)]                         # ties
    rows += [(20, [0.5] * 40)] + [(40, rows[40][1])] * 3 + [(77, [1.0] * 40)]   # one id, several rows
    rows += [(500, None), (520, [1.0, None] + [0.0] * 38), (540, [math.nan] * 40), (560, [math.inf] * 40), (580, [1.0, 2.0]), (600, []), (None, [1.0] * 40)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(7)
    got = sorted(tuple(r) for r in topk.top_k(df, block_rows=block_rows, seed_rows=seed_rows).collect())
    assert got == plain_topk(rows)


def test_topk_small_and_large_values(spark):
    rows = [(0, [3e7, 1.0]), (1, [2.0, -3e7]), (2, [-3e7, 5.0]), (3, [4e7, 2.0])]  # products beyond 2**53
    assert sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, VECTORS)).collect()) == plain_topk(rows)
    assert topk.top_k(spark.createDataFrame([], VECTORS)).collect() == []
    assert topk.top_k(spark.createDataFrame([(20, [1.0])], VECTORS)).collect() == []
    assert topk.top_k(spark.createDataFrame([(20, [1.0]), (1, [2.0])], VECTORS)).collect() == [(20, 1, 1, 64 * 128)]


def test_bounds_drop_most_candidates_and_no_answer():
    rng = np.random.default_rng(4)
    mass = 1 / np.arange(1, 65)
    c = np.floor(64 * 8 * rng.normal(size=(5000, 64)) * mass)
    q, ids = c[:50].copy(), np.arange(5000)
    best = topk.search(q, c, ids, topk.Best(ids[:50], np.full(50, -1 << 62), 20, False))
    s = q @ c.T
    s[np.arange(50), np.arange(50)] = -np.inf
    want = np.take_along_axis(s, np.argsort(-s, axis=1)[:, :20], axis=1)
    assert np.array_equal(best.score.reshape(50, 20), want)
    floor = want[:, -1].astype(float)
    cuts = [slice(a, a + topk.WIDTH) for a in range(0, 64, topk.WIDTH)]
    row, _, _ = topk._survivors([q[:, x].T for x in cuts], [c[:, x].T for x in cuts], topk._lengths(q, cuts), topk._lengths(c, cuts), floor)
    assert len(row) < 50 * 30  # what passes the last bound is the answer, itself and ties


def plain_whitening(rows, k=8):
    dims = max((len(v) for _, v in rows if v is not None), default=0)
    ok = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in ok], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = ((n * x - s) ** 2).sum(axis=1)
    centred = (n * x - s).astype(float) / n
    v = np.cov(centred.T, bias=True)
    e, u = np.linalg.eigh(v)
    return [i for i, _ in ok], dev, centred, v, e[::-1][:k], u[:, ::-1][:, :k]


def check_whitening(spark, rows):
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).withColumn("component", F.lit("clash")).repartition(4)).collect()
    ids, dev, centred, v, e, u = plain_whitening(rows)
    k = len(e)
    assert len(got) == k * len(ids)
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in got) == Counter(
        (i, c + 1, len(ids), int(d) if d < 2 ** 63 else None) for i, d in zip(ids, dev) for c in range(k))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    white = centred @ u / np.sqrt(e)
    where = {i: j for j, i in enumerate(ids)}
    w = np.zeros_like(white)
    for r in got:
        w[where[r.vec_id], r.component - 1] = r.whitened
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-9
    sign = np.sign((w * white).sum(axis=0))
    assert np.allclose(w * sign, white, atol=1e-6)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) * 0.2 + 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [math.nan] * 12), (902, [1.0, None] + [0.0] * 10), (903, [1.0] * 5), (904, [math.inf] + [0.0] * 11), (905, [])]
    check_whitening(spark, rows)


def test_whitening_large_entries_and_few_dimensions(spark):
    rng = np.random.default_rng(7)
    check_whitening(spark, [(i, [float(a), float(b)]) for i, (a, b) in enumerate(rng.normal(size=(60, 2)) * 40_000)])


def test_whitening_defined_results(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [])], VECTORS)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], VECTORS)).collect()
    assert [(r.component, r.whitened, r.deviation, r.identity_error) for r in one] == [(1, 0.0, 0, 0.0), (2, 0.0, 0, 0.0)]
    # repeated rows count as often as they occur; the second dimension is constant
    got = whitening.whiten(spark.createDataFrame([(1, [0.0, 5.0]), (1, [0.0, 5.0]), (None, [3.0, 5.0])], VECTORS)).collect()
    assert Counter((r.vec_id, r.component) for r in got) == {(1, 1): 2, (1, 2): 2, (None, 1): 1, (None, 2): 1}
    assert all(r.whitened == 0 and r.explained == 0 for r in got if r.component == 2)
    huge = whitening.whiten(spark.createDataFrame([(1, [3e18]), (2, [-3e18]), (3, [1.0])], VECTORS)).collect()
    assert {r.vec_id: r.deviation for r in huge} == {1: None, 2: None, 3: 2048 ** 2} and huge[0].identity_error < 1e-9
