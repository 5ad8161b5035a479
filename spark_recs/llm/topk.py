"""Exact top-k by integer inner product, by columnar branch and bound.

Vectors become integers (floor(scale * x)).  Queries and candidates are dealt
into blocks, and a task takes one block of each.  It lays the candidates out
vertically, dimension block by dimension block, the dimensions of most mass
first, and accumulates scores one dimension block at a time.  What is still to
come is at most the product of the two remaining lengths; a candidate that
can't reach the query's k-th best score by that bound is dropped, and the
survivors are compacted before the next dimension block.  Before the first one
the remaining length is the whole one, so candidates are taken by falling
length and a strip that is too short for all queries ends the task's work.

A query starts with a floor: its k-th best score over the same `SEED_ROWS` or so
candidates, found in a first round.  It is a lower bound of the final k-th score,
so nothing is lost, and tasks drop most candidates from the first strip on.

Blocks are as wide as `BLOCK_ROWS` allows, since each row travels once per block
of the other side, and are dealt by a hash of the row, not of its id, so that
no id is hot.

Defined results: null vectors and vectors that hold null or non-finite entries
take no part, nor do rows without an id; vectors of unequal length are
compared as if zeros followed the shorter; rows of one id are one entity with
several vectors, whose score is the highest of the pairs', so equal rows
count once and no entity meets itself; scores beyond 64 bits end the query with
an error; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize

TOP, SCALE, EVERY = 20, 64, 20
BLOCK_ROWS = 1 << 16
SEED_ROWS = 1 << 13
STRIP, BATCH, WIDTH = 4096, 256, 16     # candidates, queries and dimensions at once
DENSE = 0.25                            # share of survivors above which a block is not gathered
_LOWEST = -(1 << 62)
_SCORES = "query_id long, vec_id long, score long"


def whole(vector: str) -> Column:
    """No null, no null entry, all entries finite."""
    bad = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(vector, bad)


def matrix(col, scale: float, dims: int = 0) -> np.ndarray:
    """The vectors of an Arrow list column as rows of floor(scale * x), zeros after the shorter."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offsets = np.asarray(col.offsets).astype(np.int64)
    x = np.floor(scale * np.asarray(col.values, dtype=np.float64)[offsets[0]: offsets[-1]])
    size = np.diff(offsets)
    dims = max(dims, int(size.max(initial=0)))
    if len(size) and (size == dims).all():
        return x.reshape(len(size), dims)
    out = np.zeros((len(size), dims))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(x)) - np.repeat(offsets[:-1] - offsets[0], size)] = x
    return out


class Best:
    """Each query's best k (score, id), ids distinct."""

    def __init__(self, ids: np.ndarray, floor: np.ndarray, k: int, repeats: bool):
        self.ids, self.floor, self.k, self.repeats = ids, floor.astype(np.float64), k, repeats
        self.row, self.vec, self.score = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, row, vec, score):
        other = vec != self.ids[row]
        if not other.any():
            return
        self.row, self.vec, self.score = (np.concatenate([a, b[other]]) for a, b in ((self.row, row), (self.vec, vec), (self.score, score)))
        if self.repeats:  # an id's best vector
            self._keep(np.lexsort((-self.score, self.vec, self.row)), first_of_pair=True)
        self._keep(np.lexsort((self.vec, -self.score, self.row)))
        n = np.bincount(self.row, minlength=len(self.ids))
        full = np.flatnonzero(n >= self.k)
        self.floor[full] = np.maximum(self.floor[full], self.score[np.cumsum(n)[full] - 1])

    def _keep(self, order, first_of_pair=False):
        row, vec = self.row[order], self.vec[order]
        if first_of_pair:
            good = np.r_[True, (row[1:] != row[:-1]) | (vec[1:] != vec[:-1])]
        else:
            good = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        self.row, self.vec, self.score = row[good], vec[good], self.score[order][good]


def _lengths(x: np.ndarray, cuts: list[slice]) -> np.ndarray:
    """(dimension blocks + 1, rows): what each row's length is from that block on."""
    part = np.stack([np.einsum("ij,ij->i", x[:, c], x[:, c]) for c in cuts] + [np.zeros(len(x))])
    return np.sqrt(np.cumsum(part[::-1], axis=0)[::-1])


def _slack(bound):
    """An upper bound in spite of rounding; scores are whole numbers."""
    return bound * (1 + 1e-9) + 1e-3


def search(q: np.ndarray, c: np.ndarray, vec: np.ndarray, best: Best) -> Best:
    """Offers `best` every candidate that may be among a query's k best."""
    if not len(q) or not len(c):
        return best
    top = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if top >= 2 ** 53:
        return _search_wide(q, c, vec, best)
    order = np.argsort(-(np.einsum("ij,ij->j", q, q) * np.einsum("ij,ij->j", c, c)), kind="stable")
    q, c = q[:, order], c[:, order]
    cuts = [slice(a, a + WIDTH) for a in range(0, q.shape[1], WIDTH)] or [slice(0, 0)]
    q_len, c_len = _lengths(q, cuts), _lengths(c, cuts)
    by_length = np.argsort(-c_len[0], kind="stable")
    c, c_len, vec = c[by_length], c_len[:, by_length], vec[by_length]
    vertical = [np.ascontiguousarray(c[:, cut].T) for cut in cuts]
    for s in range(0, len(c), STRIP):
        strip = slice(s, s + STRIP)
        hope = np.flatnonzero(_slack(q_len[0] * c_len[0, s]) >= best.floor)
        if not len(hope):
            break
        for a in range(0, len(hope), BATCH):
            some = hope[a: a + BATCH]
            cols = [v[:, strip] for v in vertical]
            parts = [q[some, cut].T for cut in cuts]
            row, at, score = _survivors(parts, cols, q_len[:, some], c_len[:, strip], best.floor[some])
            best.add(some[row], vec[strip][at], score.astype(np.int64))
    return best


def _survivors(parts, cols, q_len, c_len, floor):
    """(query, candidate, score) of the pairs that no bound excludes; `parts` and
    `cols` hold the queries and candidates by dimension block."""
    score, b = np.zeros((len(floor), cols[0].shape[1])), 0
    while True:  # whole blocks while most candidates stay
        score += parts[b].T @ cols[b]
        b += 1
        alive = score + _slack(q_len[b][:, None] * c_len[b]) >= floor[:, None]
        if b == len(cols) or alive.sum() < DENSE * alive.size:
            break
    row, at = np.nonzero(alive)
    score = score[row, at]
    for b in range(b, len(cols)):
        score = score + np.einsum("ij,ij->j", parts[b][:, row], cols[b][:, at])
        stay = score + _slack(q_len[b + 1][row] * c_len[b + 1][at]) >= floor[row]
        row, at, score = row[stay], at[stay], score[stay]
    return row, at, score


def _search_wide(q, c, vec, best):
    """Numbers beyond 53 bits: whole products in Python integers."""
    to_int = lambda x: np.array([[int(v) for v in r] for r in x.tolist()], dtype=object).reshape(x.shape)
    c = to_int(c)
    for i, row in enumerate(to_int(q)):
        score = np.array([int(x) for x in c @ row], dtype=np.int64)  # OverflowError beyond 64 bits
        best.add(np.full(len(c), i), vec, score)
    return best


def _task(k: int, scale: float, seed: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q, c = matrix(left["vector"], scale), matrix(right["vector"], scale)
        dims = max(q.shape[1], c.shape[1])
        q, c = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, c))
        ids, vec = np.asarray(left["id"], dtype=np.int64), np.asarray(right["id"], dtype=np.int64)
        floor = np.full(len(ids), _LOWEST) if seed else np.asarray(left["floor"], dtype=np.int64)
        best = search(q, c, vec, Best(ids, floor, k, len(np.unique(vec)) < len(vec)))
        if seed:
            return left.select(["id", "slot", "vector"]).append_column("floor", pa.array(best.floor.astype(np.int64)))
        return pa.table([pa.array(x, pa.int64()) for x in (ids[best.row], best.vec, best.score)], ["query_id", "vec_id", "score"])
    return run


def _blocks(n_queries: int, n: int, tasks: int, block_rows: int) -> tuple[int, int]:
    """(query blocks, candidate blocks): as wide as allowed, at least one pair
    per task slot while there are rows for it."""
    qb, cb = max(1, -(-n_queries // block_rows)), max(1, -(-n // block_rows))
    return qb, max(cb, min(-(-tasks // qb), -(-n // STRIP)))


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: float = SCALE, vec_id: str = "vec_id",
          vector: str = "embedding", block_rows: int = BLOCK_ROWS, seed_rows: int = SEED_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    `every`, the `k` others of highest integer inner product, ties to the smaller id."""
    spark = vectors.sparkSession
    rows = vectors.filter(whole(vector) & F.col(vec_id).isNotNull())
    # the slot is stored with the row: it deals out rows of one id, and stays what it is
    slot = F.pmod(F.xxhash64(F.col(vec_id), F.monotonically_increasing_id()), F.lit(1 << 40))
    rows = materialize(rows.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), slot.alias("slot")), "vectors")
    is_query = F.pmod(F.col("id"), F.lit(every)) == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    tasks = 2 * spark.sparkContext.defaultParallelism
    qb, cb = _blocks(n_queries, n, tasks, block_rows)
    sb = max(qb, min(tasks, -(-n_queries // BATCH)))  # the first round has but one block of candidates

    def each(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))

    seeds = max(1, n // seed_rows)
    left = rows.filter(is_query).withColumn("sb", F.pmod("slot", F.lit(sb))).repartition(sb, "sb")
    right = rows.filter(F.pmod(F.shiftright("slot", 8), F.lit(seeds)) == 0).select("id", "vector", each(sb).alias("sb")).repartition(sb, "sb")
    schema = rows.select("id", "slot", "vector").schema.add("floor", "long")
    floors = left.groupBy("sb").cogroup(right.groupBy("sb")).applyInArrow(_task(k, scale, True), schema)
    left = floors.select("id", "vector", "floor", F.pmod("slot", F.lit(qb)).alias("qb"), each(cb).alias("cb"))
    right = rows.select("id", "vector", F.pmod("slot", F.lit(cb)).alias("cb"), each(qb).alias("qb"))
    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(_task(k, scale, False), _SCORES)
    # an id's vectors may lie in several blocks
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
