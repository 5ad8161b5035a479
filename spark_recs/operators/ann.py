"""Approximate maximum-inner-product search with random-hyperplane hashing.

Items are augmented with ``sqrt(M² - |x|²)`` (M = largest item norm) and
queries with 0, which turns inner-product order into cosine order; each of
``tables`` hash tables takes the sign pattern of ``bits`` random hyperplanes
as a bucket code.  The bits grow with the number of items, so that a bucket
holds about ``bucket_items`` of them whatever the table's size.  A query looks
into its own bucket and into those whose code differs in up to ``flips`` bits.
More tables and flips raise recall; zero bits puts everything in one bucket
(exact search).

With a ``recall`` target the effort is fitted instead (``fit_effort``): a query's
buckets are ordered by its margins to the hyperplanes that separate it from
them, and the number of tables and of buckets probed per table is the cheapest
that finds the target share of the exact lists of a bounded sample of queries.
The fitted effort never meets more pairs than an exact search: one table with
all its buckets probed is one.

Top-k ships no vectors per candidate pair, none per probed bucket and no probed
buckets: a task holds a block of queries and their lists and finds there which
buckets each probes, as bits.  The items, with their codes, are read past it
(``scoring.stream_topk``): an item travels once per query block, whatever the
tables and probes, a query once.  A group of queries takes products only with
items in buckets that one of them probes.  This is exact over the candidate
union, and an item met in several tables counts once.  Queries that meet fewer
than k items are searched exactly, so that every list holds min(k, items).

A query block is cut so that it holds at most ``BLOCK_BITS`` bits of probed
buckets; at most ``bucket_rows`` items are scored at a time.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.functions.columns import dot, hash_key
from spark_recs.operators.scoring import GROUP_ROWS, MAX_TILE_CELLS, STREAM_BLOCK, blocked_topk, norm_of, stream_blocks, stream_topk, user_rows
from spark_recs.session import scratch_path

DEFAULT_BUCKET_ROWS = 8_192
BUCKET_ITEMS = 256            # items aimed at per bucket
MAX_BITS = 12                 # of a fitted index: a query's buckets are ordered one by one
SAMPLE_QUERIES = 256          # queries that the effort is fitted on
SLACK = 0.02                  # added to the target when fitting on the sample
ORDER_CELLS = 1 << 21         # bucket costs held at once in a task
BLOCK_BITS = 1 << 30          # bits of probed buckets held by a task (128 MiB)


def hyperplanes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    """(tables, bits, dim + 1) normal hyperplanes, rounded to 6 places so the
    same constants can be written into SQL.  Fewer bits are a prefix of more."""
    rs = np.random.RandomState(seed)
    return np.round(rs.standard_normal((bits, tables, dim + 1)), 6).transpose(1, 0, 2)


def index_bits(n_items: int, bucket_items: int = BUCKET_ITEMS) -> int:
    """Least bits at which a bucket holds ``bucket_items`` items on average."""
    return max(0, -(-n_items // bucket_items) - 1).bit_length()


def probe_masks(bits: int, flips: int) -> list[int]:
    """What a query's code is xor-ed with: every choice of up to ``flips`` bits."""
    return [sum(1 << j for j in c) for f in range(min(flips, bits) + 1) for c in combinations(range(bits), f)]


def item_stats(items: DataFrame) -> tuple[float, int, int]:
    """(largest squared item norm, vector length, items) in one small action."""
    row = items.agg(F.max(dot(F.col("features"), F.col("features"))).alias("m2"),
                    F.max(F.size("features")).alias("dim"), F.count(F.lit(1)).alias("n")).first()
    return float(row["m2"] or 0.0), int(row["dim"] or 0), int(row["n"])


def _probed(margins: np.ndarray) -> np.ndarray:
    """(rows, tables, buckets): the cost of reaching each bucket, by its mask
    against the row's own code: the squared margins of the bits that differ."""
    bits = margins.shape[2]
    masks = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    return (margins ** 2) @ masks.T


def _slices(n: int, planes: np.ndarray):
    step = max(1, ORDER_CELLS // (planes.shape[0] << planes.shape[1]))
    return ((a, min(n, a + step)) for a in range(0, n, step))


def _projections(features: pd.Series, planes: np.ndarray, m2: float | None) -> np.ndarray:
    """(rows, tables, bits) products with the hyperplanes."""
    return _projected(np.vstack(features.to_numpy()).astype(np.float64), planes, m2)


def _projected(X: np.ndarray, planes: np.ndarray, m2: float | None) -> np.ndarray:
    extra = np.zeros(len(X)) if m2 is None else np.sqrt(np.maximum(m2 - np.einsum("ij,ij->i", X, X), 0.0))
    tables, bits, width = planes.shape
    return (np.hstack([X, extra[:, None]]) @ planes.reshape(tables * bits, width).T).reshape(len(X), tables, bits)


def _buckets(codes: np.ndarray, bits: int) -> np.ndarray:
    """Codes by table (rows, tables, ...) as numbers that differ between tables."""
    tables = np.arange(codes.shape[1], dtype=np.int64) << bits
    return codes + tables.reshape(1, -1, *[1] * (codes.ndim - 2))


def item_buckets(planes: np.ndarray, m2: float):
    """An item's bucket of each table."""
    weights = 1 << np.arange(planes.shape[1], dtype=np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def buckets(features: pd.Series) -> pd.Series:
        if len(features) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(_buckets((_projections(features, planes, m2) > 0) @ weights, planes.shape[1])))
    return buckets


def flip_buckets(planes: np.ndarray, flips: int):
    """A query's probed buckets: those of its own codes with up to ``flips`` bits changed."""
    weights, masks = 1 << np.arange(planes.shape[1], dtype=np.int64), np.array(probe_masks(planes.shape[1], flips), dtype=np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def buckets(features: pd.Series) -> pd.Series:
        if len(features) == 0:
            return pd.Series([], dtype=object)
        codes = (_projections(features, planes, None) > 0) @ weights
        return pd.Series(list(_buckets(codes[:, :, None] ^ masks, planes.shape[1]).reshape(len(codes), -1)))
    return buckets


def probe_buckets(planes: np.ndarray, probes: int):
    """A query's ``probes`` cheapest buckets per table."""
    weights = 1 << np.arange(planes.shape[1], dtype=np.int64)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def buckets(features: pd.Series) -> pd.Series:
        out = []
        for a, b in _slices(len(features), planes):
            p = _projections(features.iloc[a:b], planes, None)
            cheapest = np.argsort(_probed(np.abs(p)), axis=2, kind="stable")[:, :, :probes]
            out += list(_buckets(((p > 0) @ weights)[:, :, None] ^ cheapest, planes.shape[1]).reshape(b - a, -1).astype(np.int32))
        return pd.Series(out, dtype=object)
    return buckets


class ProbeBits:
    """The probed buckets of a block of queries: a bit per query and bucket."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Whether a query probes one of an item's buckets (pairs, tables)."""
        return ((self.bits[rows[:, None], codes >> 3] >> (codes & 7)) & 1).any(axis=1)

    def union(self, a: int, b: int):
        """From items' buckets to whether one of the queries a to b probes one."""
        some = np.unpackbits(np.bitwise_or.reduce(self.bits[a:b]), bitorder="little").astype(bool)
        return lambda codes: some[codes].any(axis=1)


class ProbeFlips:
    """As ``ProbeBits``, for buckets whose code differs in up to ``flips`` bits:
    only the queries' own buckets are held, whatever the number of buckets."""

    def __init__(self, codes: np.ndarray, flips: int):
        self.codes, self.flips = codes, flips

    def has(self, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return (np.bitwise_count(self.codes[rows] ^ codes) <= self.flips).any(axis=1)

    def union(self, a: int, b: int):
        own = [np.unique(c) for c in self.codes[a:b].T]
        return lambda codes: np.any([(np.bitwise_count(o[:, None] ^ c) <= self.flips).any(axis=0) for o, c in zip(own, codes.T)], axis=0)


def cheapest_bits(planes: np.ndarray, probes: int):
    """For a block of queries what ``probe_buckets`` finds, as ``ProbeBits``."""
    weights, n = 1 << np.arange(planes.shape[1], dtype=np.int64), 1 << planes.shape[1]

    def of(X: np.ndarray) -> ProbeBits:
        bits = np.zeros((len(X), -(-planes.shape[0] * n // 8)), np.uint8)
        for a, b in _slices(len(X), planes):
            p = _projected(X[a:b], planes, None)
            near = np.ones((b - a, planes.shape[0], n), bool)
            if probes < n:
                cost = _probed(np.abs(p))
                most = np.partition(cost, probes - 1, axis=2)[:, :, probes - 1: probes]
                near, tied = cost < most, cost == most       # ties to the smaller mask
                near |= tied & (np.cumsum(tied, axis=2) <= probes - near.sum(axis=2, keepdims=True))
            own = ((p > 0) @ weights)[:, :, None]
            bits[a:b] = np.packbits(np.take_along_axis(near, own ^ np.arange(n), axis=2).reshape(b - a, -1), axis=1, bitorder="little")
        return ProbeBits(bits)
    return of


def flipped_codes(planes: np.ndarray, flips: int):
    """For a block of queries what ``flip_buckets`` finds, as ``ProbeFlips``."""
    weights = 1 << np.arange(planes.shape[1], dtype=np.int64)
    return lambda X: ProbeFlips(_buckets((_projected(X, planes, None) > 0) @ weights, planes.shape[1]).astype(np.int32), min(flips, planes.shape[1]))


def _probe_ranks(planes: np.ndarray, m2: float):
    """For a query and an item: per table, how many buckets the query probes
    until it meets the item."""
    weights = 1 << np.arange(planes.shape[1], dtype=np.int64)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def ranks(query: pd.Series, item: pd.Series) -> pd.Series:
        out = []
        for a, b in _slices(len(query), planes):
            p, i = _projections(query.iloc[a:b], planes, None), _projections(item.iloc[a:b], planes, m2)
            mask = ((p > 0) ^ (i > 0)) @ weights
            cost = _probed(np.abs(p))
            own = np.take_along_axis(cost, mask[:, :, None], axis=2)
            before = (cost < own) | ((cost == own) & (np.arange(cost.shape[2]) < mask[:, :, None]))
            out += (before.sum(axis=2) + 1).tolist()
        return pd.Series(out)
    return ranks


def sample_queries(queries: DataFrame, seed: int, n: int = SAMPLE_QUERIES) -> DataFrame:
    """The ``n`` queries of smallest seeded hash: a bounded sample that does not
    depend on the partitioning."""
    return queries.select("id", "features").orderBy(hash_key(seed, ["id"]), "id").limit(n)


def fit_effort(queries: DataFrame, items: DataFrame, k: int, planes: np.ndarray, m2: float, recall: float, seed: int,
               exclude_self: bool = True, sample: int = SAMPLE_QUERIES, slack: float = SLACK) -> tuple[int, int]:
    """(tables, probes): of 1, 2, 4, ... tables the cheapest effort that finds a
    share of ``recall + slack`` of the sample's exact top-k.  What is brought
    to the driver is a histogram of bucket ranks."""
    chosen = sample_queries(queries, seed, sample)
    pairs = blocked_topk(chosen, items, k, exclude_self=exclude_self).select("user_id", "item_id")
    q = chosen.select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("_q"))
    i = items.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("_i"))
    ranks = pairs.join(q, "user_id").join(i, "item_id").select(_probe_ranks(planes, m2)("_q", "_i").alias("ranks"))
    tried = [t for t in (1 << e for e in range(16)) if t <= planes.shape[0]]
    least = ranks.select(F.explode(F.array(*[F.struct(F.lit(t).alias("tables"), F.array_min(F.slice("ranks", 1, t)).alias("rank"))
                                             for t in tried])).alias("x"))
    found = least.groupBy("x.tables", "x.rank").agg(F.count(F.lit(1)).alias("n")).collect()
    best = (1, 1, 1)
    if found:
        best = min(_effort(t, sorted((r["rank"], r["n"]) for r in found if r["tables"] == t), recall + slack) for t in tried)
    return best[1], best[2]


def _effort(tables: int, histogram: list[tuple[int, int]], share: float) -> tuple[int, int, int]:
    """(buckets probed, tables, probes per table) that reach the share."""
    total, met = sum(n for _, n in histogram), 0
    for rank, n in histogram:
        met += n
        if met >= share * total:
            break
    return tables * rank, tables, rank


def _plan(queries: DataFrame, items: DataFrame, k: int, tables: int, seed: int, bits: int | None, flips: int,
          bucket_items: int, recall: float | None, exclude_self: bool):
    """(planes, m2, probes per table or None: those that differ in ``flips`` bits)."""
    m2, dim, n = item_stats(items)
    if recall is None:
        planes = hyperplanes(dim, tables, index_bits(n, bucket_items) if bits is None else bits, seed)
        return planes, m2, None
    planes = hyperplanes(dim, tables, min(MAX_BITS, index_bits(n, bucket_items)) if bits is None else bits, seed)
    used, probes = fit_effort(queries, items, k, planes, m2, recall, seed, exclude_self)
    return planes[:used], m2, probes


def candidate_counts(queries: DataFrame, items: DataFrame, tables: int, seed: int, bits: int | None = None,
                     flips: int = 1, bucket_items: int = BUCKET_ITEMS, recall: float | None = None, k: int = 100) -> DataFrame:
    """(user_id, n_buckets, n_candidates): buckets probed that hold items, and
    the items in them, a query itself and repeats between tables included."""
    planes, m2, probes = _plan(queries, items, k, tables, seed, bits, flips, bucket_items, recall, True)
    probed = flip_buckets(planes, flips) if probes is None else probe_buckets(planes, probes)
    sizes = (items.select(F.explode(item_buckets(planes, m2)("features")).alias("bucket"))
                  .groupBy("bucket").agg(F.count(F.lit(1)).alias("ni")))
    probes = queries.select("id", F.explode(probed("features")).alias("bucket"))
    return (probes.join(sizes, "bucket", "left").groupBy(F.col("id").cast("long").alias("user_id"))
                  .agg(F.count("ni").alias("n_buckets"), F.coalesce(F.sum("ni"), F.lit(0)).alias("n_candidates")))


def search_buckets(queries: DataFrame, items: DataFrame, k: int, n_queries: int, n_items: int, probing, row_bits: int, exclude_self: bool,
                   bucket_rows: int = DEFAULT_BUCKET_ROWS, distinct: bool = False, full: bool = False) -> DataFrame:
    """(user_id, rank, item_id, score): each query's (id, features) best ``k`` of
    the items (item_id, features, codes) with a code among the buckets it probes.
    ``probing``: gives these for a block of vectors (``cheapest_bits``), in
    ``row_bits`` bits a query; ``n_items``: rows of ``items``; ``distinct``: an id
    met several times counts once; ``full``: only lists of ``k`` items."""
    slots = queries.sparkSession.sparkContext.defaultParallelism
    bu, bi = stream_blocks(n_queries, n_items, slots, k, min(STREAM_BLOCK, max(1, BLOCK_BITS // max(1, row_bits))))
    i = items.select("item_id", "features", F.lit(0.0).alias("bias"), (-norm_of()).alias("place"), "codes")
    return stream_topk(user_rows(queries), i, k, bu, bi, exclude_self=exclude_self, distinct=distinct,
                       cells=min(MAX_TILE_CELLS, bucket_rows * GROUP_ROWS), biased=False, probing=probing, full=full)


def ann_topk(queries: DataFrame, items: DataFrame, k: int, tables: int, seed: int, bits: int | None = None,
             flips: int = 1, exclude_self: bool = True, bucket_items: int = BUCKET_ITEMS,
             bucket_rows: int = DEFAULT_BUCKET_ROWS, complete: bool = True, recall: float | None = None) -> DataFrame:
    """Per-query top-k among the items of the probed buckets; exact for
    queries that meet fewer than k.  ``recall``: the share of the exact lists
    to find; it fits the effort, in place of ``flips``.  The full lists are written once, as the
    second search depends on them.  With ``complete=False`` queries that meet fewer keep
    what their buckets hold, in one lazy pass."""
    spark = queries.sparkSession
    planes, m2, probes = _plan(queries, items, k, tables, seed, bits, flips, bucket_items, recall, exclude_self)
    n_items = items.count()
    n_queries = n_items if queries is items else queries.count()
    coded = items.select(F.col("id").cast("long").alias("item_id"), "features", item_buckets(planes, m2)("features").alias("codes"))
    probing, row_bits = (flipped_codes(planes, flips), 32 * len(planes)) if probes is None else (cheapest_bits(planes, probes), len(planes) << planes.shape[1])
    lists = search_buckets(queries.select("id", "features"), coded, k, n_queries, n_items, probing, row_bits, exclude_self, bucket_rows,
                           distinct=True, full=complete)
    if not complete:
        return lists
    path = scratch_path(spark, "ann_lists")
    lists.write.parquet(path)
    found = spark.read.schema(lists.schema).parquet(path)
    listed = found.filter(F.col("rank") == k).select(F.col("user_id").alias("id"))
    rest = queries.join(listed, "id", "left_anti")
    return found.select("user_id", "rank", "item_id", "score").unionByName(blocked_topk(rest, items, k, exclude_self=exclude_self))


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact top-k pairs that the approximate search
    found, and the number of queries.  Both lists are shuffled once, by user."""
    side = lambda df, a, e: df.select("user_id", "item_id", F.lit(a).alias("_a"), F.lit(e).alias("_e"))
    pairs = side(approx, 1, 0).unionByName(side(exact, 0, 1)).repartition("user_id").groupBy("user_id", "item_id").agg(
        F.sum("_a").alias("_a"), F.sum("_e").alias("_e"))
    by_user = pairs.groupBy("user_id").agg(F.sum(F.col("_a") * F.col("_e")).alias("_found"),
                                         F.sum(F.col("_e") * F.greatest("_a", F.lit(1))).alias("_all"))
    return by_user.filter(F.col("_all") > 0).agg((F.sum("_found") / F.sum("_all")).alias("recall"), F.count("user_id").alias("n_queries"))
