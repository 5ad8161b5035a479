"""Exact top-k by inner product (optionally with biases), in streamed blocks.

The user × item score matrix is never materialised as rows.  Users are hashed
into blocks of at most ``STREAM_BLOCK``; a task holds one block and its lists and
reads the items past it, those of large norm first.  The block's users are put
into groups of like direction.  No user of a group can score an item higher than
the item's norm times the cosine of its angle to the group's cone, so a group
takes products only with the items that this lets into a list; they are taken in
single precision, and only pairs that its rounding error allows to enter a list
are scored again in double precision.  The lists are those of scoring every pair
in double precision.

Items travel packed, ``PACK_ITEMS`` to a row, once per user block, a user once,
and exactly k rows a user leave the task.  Where there are fewer user blocks than
task slots, items are sliced too and a final window merges a user's lists
(``stream_blocks``).  A task's memory is its user block, its lists and a chunk of
items, whatever the tables' sizes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.functions.columns import dot
from spark_recs.sources.schemas import materialize

MAX_TILE_CELLS = 1 << 23      # scores held at once in a task (64 MiB of float64)
MAX_BLOCK = 1 << 16           # users or items per block: a block of rank-25 vectors is 13 MB
STREAM_BLOCK = 1 << 17        # users of a streamed block: lists of 100 are some 300 MB

_OUT = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("tile_rank", T.LongType()),
])


def block_counts(n_users: int, n_items: int, parallelism: int,
                 max_block: int = MAX_BLOCK) -> tuple[int, int]:
    """(user blocks, item blocks).  An item travels once per user block and a
    user once per item block, so both are made as wide as allowed, with at
    least as many block pairs as task slots; scores are bounded inside the
    task (``_tile_topk``)."""
    bi = max(1, math.ceil(n_items / max_block))
    bu = max(1, math.ceil(n_users / max_block))
    if bu * bi < parallelism:
        bu = max(bu, min(max(n_users, 1), math.ceil(parallelism / bi)))
    return bu, bi


def _rows_topk(S: np.ndarray, iid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: column indices of the best k (score desc, item id asc) and
    how many are valid (finite).  Vectorised; rows with ties straddling the
    k-th place take an exact per-row path."""
    n_rows, n_items = S.shape
    kk = min(k, n_items)
    if n_items > kk:
        part = np.argpartition(-S, kk - 1, axis=1)[:, :kk]
        kth = np.take_along_axis(S, part, axis=1).min(axis=1)
        ties = (S >= kth[:, None]).sum(axis=1) > kk
    else:
        part = np.broadcast_to(np.arange(n_items), (n_rows, n_items)).copy()
        ties = np.zeros(n_rows, dtype=bool)
    sc = np.take_along_axis(S, part, axis=1)
    order = np.lexsort((iid[part], -sc), axis=1)
    pick = np.take_along_axis(part, order, axis=1)
    for r in np.flatnonzero(ties):
        s = S[r]
        cand = np.flatnonzero(s >= np.sort(s)[::-1][kk - 1])
        o = np.lexsort((iid[cand], -s[cand]))[:kk]
        pick[r] = cand[o]
    valid = np.isfinite(np.take_along_axis(S, pick, axis=1)).sum(axis=1)
    return pick, valid


def _empty() -> pd.DataFrame:
    return pd.DataFrame({"user_id": np.array([], np.int64), "item_id": np.array([], np.int64),
                         "score": np.array([], np.float64), "tile_rank": np.array([], np.int64)})


def _tile_topk(k: int, exclude_self: bool, max_tile_cells: int = MAX_TILE_CELLS):
    """Scores a pair of blocks, so many users at a time that at most
    ``max_tile_cells`` scores are held (one user at least)."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        items = right[right["kind"] == 0]
        if left.empty or items.empty:
            return _empty()
        step = max(1, max_tile_cells // len(items))
        return pd.concat([score(left.iloc[a: a + step], items, right) for a in range(0, len(left), step)], ignore_index=True)

    def score(left: pd.DataFrame, items: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        uid = left["user_id"].to_numpy(np.int64)
        iid = items["item_id"].to_numpy(np.int64)
        U = np.vstack(left["features"].to_numpy()).astype(np.float64)
        V = np.vstack(items["features"].to_numpy()).astype(np.float64)
        S = U @ V.T
        S += left["bias"].to_numpy(np.float64)[:, None]
        S += items["bias"].to_numpy(np.float64)[None, :]
        if exclude_self:
            S[uid[:, None] == iid[None, :]] = -np.inf
        seen = right[right["kind"] == 1]
        if not seen.empty:
            upos = pd.Series(np.arange(len(uid)), index=uid)
            ipos = pd.Series(np.arange(len(iid)), index=iid)
            r = upos.reindex(seen["user_id"].to_numpy()).to_numpy()
            c = ipos.reindex(seen["item_id"].to_numpy()).to_numpy()
            ok = ~(np.isnan(r) | np.isnan(c))
            S[r[ok].astype(np.int64), c[ok].astype(np.int64)] = -np.inf
        pick, valid = _rows_topk(S, iid, k)
        mask = np.arange(pick.shape[1])[None, :] < valid[:, None]
        rows = np.broadcast_to(np.arange(len(uid))[:, None], pick.shape)[mask]
        ranks = np.broadcast_to(np.arange(1, pick.shape[1] + 1)[None, :], pick.shape)[mask]
        cols = pick[mask]
        return pd.DataFrame({"user_id": uid[rows], "item_id": iid[cols], "score": S[rows, cols],
                             "tile_rank": ranks.astype(np.int64)})
    return run


# ------------------------------------------------------------ streamed blocks
GROUP_ROWS = 128              # users of like direction scored at a time
GROUPS = 1024                 # directions that a block's users are put to, at most
CHUNK_ITEMS, FIRST_ITEMS = 10_240, 256  # items bounded at a time; scored at a time at first
STEP_ITEMS = 2048             # items scored at a time
PACK_ITEMS = 2048             # items of a shuffled row
RESCORED = 1 << 16            # pairs scored again at a time
_LISTS = "user_id long, rank long, item_id long, score double"


def stream_blocks(n_users: int, n_items: int, parallelism: int, k: int, max_block: int = MAX_BLOCK) -> tuple[int, int]:
    """(user blocks, item slices): at least as many pairs as task slots, at the
    least travel.  An item travels once per user block, a user once per item
    slice, and with several slices so does its list of ``k``, counted as k / 8
    vectors."""
    least = max(1, math.ceil(n_users / max_block))
    tried = [(max(least, math.ceil(parallelism / bi)), bi) for bi in range(1, max(1, min(parallelism, n_items)) + 1)]
    tried = [(min(bu, max(n_users, 1)), bi) for bu, bi in tried]
    slots = max(min(bu * bi, parallelism) for bu, bi in tried)
    return min((t for t in tried if t[0] * t[1] >= slots),
               key=lambda t: t[0] * n_items + t[1] * n_users * (1 + (k / 8 if t[1] > 1 else 0)))


def _once(row: np.ndarray, item: np.ndarray, score: np.ndarray):
    """Each (row, item) once, by its best score."""
    o = np.lexsort((-score, item, row))
    row, item, score = row[o], item[o], score[o]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    return row[new], item[new], score[new]


def _best_of(row: np.ndarray, item: np.ndarray, score: np.ndarray, k: int):
    """(row, item, score, rank) of each row's best ``k``: score desc, item asc."""
    o = np.lexsort((item, -score, row))
    row, item, score = row[o], item[o], score[o]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return row[keep], item[keep], score[keep], rank[keep] + 1


def _nearest(D: np.ndarray, C: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the centre of largest cosine, and the cosine."""
    at, cos = np.zeros(len(D), np.int64), np.zeros(len(D), np.float32)
    for a in range(0, len(D), 4096):
        S = D[a: a + 4096] @ C.T
        at[a: a + 4096] = S.argmax(axis=1)
        cos[a: a + 4096] = S.max(axis=1)
    return at, cos


def _alike(D: np.ndarray, odd: np.ndarray, size: int, steps: int = 4, sample: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): unit rows in groups of at most ``size`` of like direction,
    by a few steps of spherical k-means on some of them; ``odd`` rows are apart."""
    D, n = D.astype(np.float32), min(GROUPS, -(-len(D) // size))
    at, cos = np.zeros(len(D), np.int64), np.zeros(len(D), np.float32)
    if n > 1:
        some = D[:: max(1, len(D) // sample)]
        C = some[np.linspace(0, len(some) - 1, n).astype(np.int64)]
        for _ in range(steps):
            near, sums = _nearest(some, C)[0], np.zeros_like(C)
            np.add.at(sums, near, some)
            length = np.linalg.norm(sums, axis=1)[:, None]
            C = np.where(length > 0, sums / np.where(length > 0, length, 1), C)
        at, cos = _nearest(D, C)
    at[odd] = n
    order = np.lexsort((-cos, at))
    at = at[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    return order, np.flatnonzero(place % size == 0)


class _Lists:
    """The lists of one user block, over items that are met chunk by chunk.
    ``biased``: items have biases, which are taken as one more dimension;
    ``probing``: from the users' vectors to the buckets that each meets."""

    def __init__(self, uid, U, bias, floor, seen, k, exclude_self, distinct, cells, biased=False, probing=None):
        usable = np.isfinite(U).all(axis=1) & np.isfinite(bias)
        wide = np.hstack([U, np.ones((len(U), 1))]) if biased else U
        with np.errstate(all="ignore"):
            norm = np.sqrt(np.einsum("ij,ij->i", wide, wide))
            odd = ~((norm > 0) & np.isfinite(norm))
            D = np.where(odd[:, None], 0.0, wide / norm[:, None])
        self.chunk = max(1, min(CHUNK_ITEMS, cells))
        self.group = max(1, min(GROUP_ROWS, cells // self.chunk))
        rows = np.flatnonzero(usable)
        order, starts = _alike(D[rows], odd[rows], self.group)
        rows = rows[order]
        self.uid, self.U, self.bias, self.kth, self.norm = uid[rows], U[rows], bias[rows], floor[rows], norm[rows]
        self.fast = wide[rows].astype(np.float32)
        self.k, self.exclude_self, self.distinct, self.biased = k, exclude_self, distinct, biased
        self.cuts = np.append(starts, len(rows))
        n = len(starts)
        self.met, self.wait = [0] * n, [[] for _ in range(n)]
        self.n_wait, self.held = [0] * n, [0] * n
        self.sloped = np.zeros(n)                           # no item below, by norm times cosine, can enter a list of the group
        if n:
            D = D[rows]
            C = np.add.reduceat(D, starts, axis=0)
            length = np.linalg.norm(C, axis=1)[:, None]
            C = np.where(length > 1e-6, C / np.where(length > 0, length, 1), D[starts])
            cos = np.einsum("ij,ij->i", D, np.repeat(C, np.diff(self.cuts), axis=0))
            self.cos = np.clip(np.minimum.reduceat(cos, starts) - 1e-9, -1, 1)
            self.sin, self.centre = np.sqrt(1 - self.cos ** 2), C.astype(np.float32)
        for g in range(n):
            self._slope(g)
        probes = probing(U[rows]) if probing is not None and n else None
        self.meets = probes and probes.has
        self.some_meet = probes and [probes.union(a, b) for a, b in zip(self.cuts[:-1], self.cuts[1:])]
        self.seen = None
        if len(seen[0]):
            self.own, row_of = np.unique(self.uid, return_inverse=True)
            self.own_row = row_of
            at = np.searchsorted(self.own, seen[0])
            known = (at < len(self.own)) & (self.own[np.minimum(at, len(self.own) - 1)] == seen[0]) if n else np.zeros(len(at), bool)
            self.seen_items, code = np.unique(seen[1][known], return_inverse=True)
            self.seen = np.unique(at[known] * max(1, len(self.seen_items)) + code)

    def _unseen(self, rows, iid):
        if self.seen is None or not len(self.seen):
            return np.ones(len(rows), bool)
        at = np.minimum(np.searchsorted(self.seen_items, iid), len(self.seen_items) - 1)
        key = self.own_row[rows] * len(self.seen_items) + at
        place = np.minimum(np.searchsorted(self.seen, key), len(self.seen) - 1)
        return ~((self.seen_items[at] == iid) & (self.seen[place] == key))

    def _slope(self, g):
        rows = slice(self.cuts[g], self.cuts[g + 1])
        kth, bias, norm = self.kth[rows], self.bias[rows], self.norm[rows]
        with np.errstate(all="ignore"):
            least = (kth - bias - 1e-12 * (np.abs(kth) + np.abs(bias))) / norm
        self.sloped[g] = np.where((norm > 0) & np.isfinite(norm) & ~np.isnan(least), least, -np.inf).min()

    def meet(self, iid, V, bias, codes=None):
        """Scores items; ``codes``: an item's buckets."""
        good = np.isfinite(V).all(axis=1) & np.isfinite(bias)
        if not good.all():
            iid, V, bias, codes = iid[good], V[good], bias[good], None if codes is None else codes[good]
        wide = np.hstack([V, bias[:, None]]) if self.biased else V
        with np.errstate(all="ignore"):
            fast, norm = wide.astype(np.float32), np.sqrt(np.einsum("ij,ij->i", wide, wide))
        n = -(-len(iid) // self.chunk)
        for c in range(n):
            to = slice(c * len(iid) // n, (c + 1) * len(iid) // n)
            self._chunk((iid[to], V[to], bias[to], fast[to], norm[to], None if codes is None else codes[to]))

    def _chunk(self, items):
        fast, norm = items[3], items[4]
        most = float(norm.max())
        groups = np.flatnonzero(~(most * (1 + 1e-9) < self.sloped))
        if not (norm.min() > 1e-15 and most < 1e15):        # beyond what the bounds are exact for
            for g in groups:
                self._group(g, items, most, np.arange(len(norm)), None)
            return
        error = np.float32((fast.shape[1] + 8) * 2.0 ** -22)
        long = np.nextafter(norm.astype(np.float32), np.float32(np.inf))
        for a in range(0, len(groups), 256):
            some = groups[a: a + 256]
            cos, sin = (x[some, None].astype(np.float32) for x in (self.cos, self.sin))
            least = np.nextafter(self.sloped[some].astype(np.float32), np.float32(-np.inf))
            along = self.centre[some] @ fast.T
            across = np.sqrt(np.maximum(long * long - along * along, 0) + 4 * error * long * long)
            bound = np.where(along >= (cos - error) * long, long, along * cos + across * sin) + error * long
            keep = ~(bound < least[:, None])
            for g, keeps, b in zip(some, keep, bound):
                self._group(g, items, most, np.flatnonzero(keeps), b)

    def _group(self, g, items, most, at, bound):
        """Scores the items ``at`` for a group; its floors rise while it does."""
        if self.some_meet:
            at = at[self.some_meet[g](items[5][at])]
        while len(at):
            step, was = min(STEP_ITEMS, self.chunk, max(FIRST_ITEMS, self.met[g])), self.sloped[g]
            self._score(g, items, most, at[:step])
            self.met[g] += min(step, len(at))
            at = at[step:]
            if bound is not None and self.sloped[g] > was:
                at = at[~(bound[at] < np.nextafter(np.float32(self.sloped[g]), np.float32(-np.inf)))]

    def _score(self, g, items, most, at):
        iid, V, bias, fast, _, codes = items
        a, b = self.cuts[g], self.cuts[g + 1]
        # the error of a single-precision product of these lengths, with room
        reach = self.norm[a:b] * most + np.abs(self.bias[a:b])
        if reach.max() < 1e30:
            error = (fast.shape[1] + 8) * 2.0 ** -22
            least = np.nextafter((self.kth[a:b] - self.bias[a:b] - error * reach - 1e-30).astype(np.float32), np.float32(-np.inf))
            hits = np.flatnonzero(self.fast[a:b] @ fast[at].T >= least[:, None])
        else:                                               # beyond single precision
            S = self.U[a:b] @ V[at].T + self.bias[a:b, None] + bias[at]
            hits = np.flatnonzero(~(S < (self.kth[a:b] - 1e-9 * reach)[:, None]))
        for h in range(0, len(hits), RESCORED):
            i, j = np.divmod(hits[h: h + RESCORED], len(at))
            i, j = i + a, at[j]
            if self.meets:
                ok = self.meets(i, codes[j])
                i, j = i[ok], j[ok]
            score = np.einsum("ij,ij->i", self.U[i], V[j]) + self.bias[i] + bias[j]
            ok = np.isfinite(score) & (score >= self.kth[i])
            if self.exclude_self:
                ok &= self.uid[i] != iid[j]
            i, j, score = i[ok], j[ok], score[ok]
            ok = self._unseen(i, iid[j])
            self.wait[g].append((i[ok].astype(np.int32), iid[j[ok]], score[ok]))
            self.n_wait[g] += int(ok.sum())
            if self.n_wait[g] - self.held[g] > max(2048, (b - a) * self.k // 2):
                self._merge(g)

    def _merge(self, g):
        """Raises the floors of the group's rows to their k-th best score so
        far and drops what is below; many equal scores are cut by item."""
        a, b = self.cuts[g], self.cuts[g + 1]
        row, item, score = (np.concatenate(x) for x in zip(*self.wait[g]))
        if self.distinct:
            row, item, score = _once(row, item, score)
        at = (row - a).astype(np.int16)
        o = np.argsort(at, kind="stable")
        n = np.bincount(at, minlength=b - a)
        width = int(n.max(initial=0))
        if width >= self.k and width * (b - a) <= 8 * len(row) + (1 << 20):
            table = np.full((b - a, width), -np.inf)
            table[at[o], np.arange(len(o)) - (np.cumsum(n) - n)[at[o]]] = score[o]
            self.kth[a:b] = np.maximum(self.kth[a:b], np.partition(table, width - self.k, axis=1)[:, width - self.k])
            keep = score >= self.kth[row]
            row, item, score = row[keep], item[keep], score[keep]
        if len(row) > 2 * (b - a) * self.k or width * (b - a) > 8 * len(at) + (1 << 20):
            row, item, score, rank = _best_of(row, item, score, self.k)
            full = rank == self.k
            self.kth[row[full]] = np.maximum(self.kth[row[full]], score[full])
        self.wait[g], self.n_wait[g], self.held[g] = [(row, item, score)], len(row), len(row)
        self._slope(g)

    def lists(self, full=False):
        """The final lists; rows of one user are one list.  ``full``: only
        those of k items."""
        own, row_of = np.unique(self.uid, return_inverse=True)
        waits = self.wait if len(own) == len(self.uid) else [[x for w in self.wait for x in w]]
        for w in waits:
            if w:
                row, item, score = (np.concatenate(x) for x in zip(*w))
                if len(own) < len(self.uid):
                    row = row_of[row]
                if self.distinct:
                    row, item, score = _once(row, item, score)
                row, item, score, rank = _best_of(row, item, score, self.k)
                if full:
                    keep = np.isin(row, row[rank == self.k])
                    row, item, score, rank = row[keep], item[keep], score[keep], rank[keep]
                yield (own if len(own) < len(self.uid) else self.uid)[row], rank, item, score


def _matrix(features) -> np.ndarray:
    """(rows, dimensions) in double precision of an Arrow list column."""
    sizes = features.value_lengths().to_numpy(zero_copy_only=False)
    if features.null_count or (sizes != sizes[0]).any():
        raise ValueError("vectors must be of one length and not null")
    return features.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)


def _packer(kind: pa.DataType):
    """Rows (slice, place, item_id, features, bias, codes) sorted by slice, packed."""
    def run(batches):
        for batch in batches:
            of = batch.column("slice").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for x, y in ((x, min(z, x + PACK_ITEMS)) for w, z in zip(cuts[:-1], cuts[1:]) for x in range(w, z, PACK_ITEMS)):
                b = batch.slice(x, y - x)
                listed = lambda v, t: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v.cast(t))
                _matrix(b.column("features"))               # of one length and not null
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of[x: x + 1], pa.int32()), pa.array([b.column("place").to_numpy().min()], pa.float64()), listed(b.column("item_id"), pa.int64()),
                     listed(b.column("features").flatten(), kind), listed(b.column("bias"), pa.float64()), listed(b.column("codes").flatten(), pa.int32())],
                    ["slice", "place", "items", "features", "biases", "codes"])
    return run


def _scorer(k: int, exclude_self: bool, distinct: bool, cells: int, biased: bool, probing, full: bool):
    """Rows sorted by (part, kind): of each part the users (kind 0), the pairs
    left out (1) and the packed items (2); gives the users' lists."""
    join = lambda held, c: pa.concat_arrays([b.column(c) for b in held])

    def start(users, seen):
        pairs = [join(seen, c).to_numpy() if seen else np.array([], np.int64) for c in ("user_id", "item_id")]
        return _Lists(join(users, "user_id").to_numpy(), _matrix(join(users, "features")), join(users, "bias").to_numpy(zero_copy_only=False),
                      join(users, "floor").to_numpy().copy(), pairs, k, exclude_self, distinct, cells, biased, probing)

    def meet(lists, packs):
        step = max(1, CHUNK_ITEMS // PACK_ITEMS)
        for a in range(0, len(packs), step):
            b = packs.slice(a, step)
            iid, flat = b.column("items").flatten().to_numpy(), b.column("features").flatten().to_numpy(zero_copy_only=False)
            lists.meet(iid, flat.astype(np.float64).reshape(len(iid), -1), b.column("biases").flatten().to_numpy(zero_copy_only=False),
                       b.column("codes").flatten().to_numpy().reshape(len(iid), -1) if probing else None)

    def out(lists):
        for cols in lists.lists(full) if lists else ():
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                                             ["user_id", "rank", "item_id", "score"])

    def run(batches):
        part, users, seen, lists = None, [], [], None
        for batch in batches:
            key = batch.column("part").to_numpy().astype(np.int64) * 4 + batch.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                b, (of, kind) = batch.slice(x, y - x), divmod(int(key[x]), 4)
                if of != part:
                    yield from out(lists)
                    part, users, seen, lists = of, [], [], None
                if kind < 2:
                    (seen if kind else users).append(b)
                elif users:
                    if lists is None:
                        lists = start(users, seen)
                    meet(lists, b)
        yield from out(lists)
    return run


def _upto(n: int) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def stream_topk(users: DataFrame, items: DataFrame, k: int, bu: int, bi: int = 1, exclude: DataFrame | None = None,
                exclude_self: bool = False, distinct: bool = False, cells: int = MAX_TILE_CELLS, biased: bool = True, probing=None,
                full: bool = False) -> DataFrame:
    """(user_id, rank, item_id, score): each user's best ``k`` of the items.

    users: (user_id, features, bias, floor); no score below ``floor`` is
    listed.  items: (item_id, features, bias, place), met by about rising
    ``place``; ``biased``: not all biases are 0.  ``probing``: a user meets only
    items with one of ``codes`` (an array) among the buckets that this gives for
    the users' vectors.  With ``distinct`` an item id met several times counts
    once.  ``full``: lists of fewer than ``k`` are left out."""
    kind = users.schema["features"].dataType
    if items.schema["features"].dataType != kind:
        kind = T.ArrayType(T.DoubleType())
    ub, ib = (F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c, n in (("user_id", bu), ("item_id", bi)))
    empty = lambda t, c: F.lit(None).cast(t).alias(c)
    feats = F.col("features").cast(kind).alias("features")
    no_pack = [empty("array<long>", "items"), empty("array<double>", "biases"), empty("array<int>", "codes")]
    # a column that is null where it has no meaning; fresh column ids on each side
    u = users.withColumn("_i", _upto(bi)).select(
        (ub * bi + F.col("_i")).alias("part"), F.lit(0).alias("kind"), F.lit(0.0).alias("place"), "user_id", empty("long", "item_id"), feats,
        F.col("bias").alias("bias"), F.col("floor").alias("floor"), *no_pack)
    packs = items.select(ib.alias("slice"), F.col("place").cast("double").alias("place"), "item_id", feats, F.col("bias").alias("bias"),
                         F.col("codes").alias("codes") if probing else F.array().cast("array<int>").alias("codes"))
    schema = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("place", T.DoubleType()), T.StructField("items", T.ArrayType(T.LongType())),
                           T.StructField("features", kind), T.StructField("biases", T.ArrayType(T.DoubleType())), T.StructField("codes", T.ArrayType(T.IntegerType()))])
    packs = packs.sortWithinPartitions("slice", "place").mapInArrow(_packer(pa.float32() if kind.elementType == T.FloatType() else pa.float64()), schema)
    i = packs.withColumn("_u", _upto(bu)).select(
        (F.col("_u") * bi + F.col("slice")).alias("part"), F.lit(2).alias("kind"), "place", empty("long", "user_id"), empty("long", "item_id"),
        "features", empty("double", "bias"), empty("double", "floor"), "items", "biases", "codes")
    rows = u.unionByName(i)
    if exclude is not None:
        ex = exclude.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"))
        rows = rows.unionByName(ex.select(
            (ub * bi + ib).alias("part"), F.lit(1).alias("kind"), F.lit(0.0).alias("place"), "user_id", "item_id",
            F.lit(None).cast(kind).alias("features"), empty("double", "bias"), empty("double", "floor"), *no_pack))
    spread = rows.repartitionById(bu * bi, F.col("part")).sortWithinPartitions("part", "kind", "place")
    lists = spread.mapInArrow(_scorer(k, exclude_self, distinct, cells, biased, probing, full and bi == 1), _LISTS)
    if bi == 1:
        return lists
    if distinct:
        lists = lists.groupBy("user_id", "item_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("item_id"))
    lists = lists.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)
    if full:
        lists = lists.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("user_id"))).filter(F.col("_n") == k)
    return lists.select("user_id", "rank", "item_id", "score")


def norm_of(features: str = "features") -> F.Column:
    return F.sqrt(dot(F.col(features), F.col(features)))


def user_rows(users: DataFrame, bias: F.Column | None = None) -> DataFrame:
    """(id, features, ...) as users of ``stream_topk``."""
    return users.select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("features"),
                        (bias if bias is not None else F.lit(0.0)).cast("double").alias("bias"),
                        F.lit(float("-inf")).alias("floor"))


def blocked_topk(users: DataFrame, items: DataFrame, k: int,
                 user_bias: F.Column | None = None, item_bias: F.Column | None = None,
                 exclude: DataFrame | None = None, exclude_self: bool = False,
                 max_tile_cells: int = MAX_TILE_CELLS, max_block: int = STREAM_BLOCK) -> DataFrame:
    """Best ``k`` items per user by ``u·i (+ b_u + b_i)``.

    users / items: (id, features), an array of floats or doubles, shuffled as
    it is and scored in double precision; ``user_bias`` /
    ``item_bias`` are expressions over those frames.  ``exclude``:
    (user_id, item_id) pairs never recommended (e.g. training pairs).
    Returns (user_id, rank, item_id, score); ties go to the smaller item id.
    """
    n_u = users.count()
    n_i = n_u if items is users else items.count()  # all-vs-all: count once
    bu, bi = stream_blocks(n_u, n_i, users.sparkSession.sparkContext.defaultParallelism, k, max_block)
    i = items.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("features"),
                     (item_bias if item_bias is not None else F.lit(0.0)).cast("double").alias("bias"), (-norm_of()).alias("place"))
    return stream_topk(user_rows(users, user_bias), i, k, bu, bi, exclude, exclude_self, cells=max_tile_cells, biased=item_bias is not None)


# ------------------------------------------------------------- stored scores
LISTED_ITEMS = 400_000        # items of a block whose vectors a task holds (rank 25: 40 MB)


def _spread(ids: np.ndarray, n: int) -> np.ndarray:
    """A block of 0 .. n - 1 for each id."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _packed(schema: pa.Schema, *values) -> pa.RecordBatch:
    """One row of plain values and lists."""
    column = lambda t, v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t.value_type)) if pa.types.is_list(t) else pa.array([v], t)
    return pa.RecordBatch.from_arrays([column(f.type, v) for f, v in zip(schema, values)], schema=schema)


def _list_cutter(n: int, schema: pa.Schema):
    """Lists (user_id, flag, features, items, scores) cut by item blocks: of a
    batch's lists one row per block, with each vector that the block needs."""
    def run(batches):
        for b in batches:
            user, flag, U = b.column("user_id").to_numpy(), b.column("flag").to_numpy(zero_copy_only=False), b.column("features")
            row = np.repeat(np.arange(len(user)), b.column("items").value_lengths().to_numpy())
            item, score = (b.column(c).flatten().to_numpy() for c in ("items", "scores"))
            of = _spread(item, n)
            order = np.argsort(of, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                if len(part):
                    rows, at = np.unique(row[part], return_inverse=True)
                    yield _packed(schema, int(of[part[0]]), 1, user[rows], flag[rows], U.take(pa.array(rows)).flatten(), at, item[part], score[part])
    return run


def _item_cutter(n: int, schema: pa.Schema):
    def run(batches):
        for b in batches:
            item, V = b.column("id").to_numpy(), b.column("features")
            of = _spread(item, n)
            order = np.argsort(of, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                if len(part):
                    yield _packed(schema, int(of[part[0]]), 0, [], [], V.take(pa.array(part)).flatten(), [], item[part], [])
    return run


def _list_checker(tolerance: float):
    """Rows sorted by (block, kind): of each block the items (kind 0) and the cut
    lists (1); counts a user's items and those whose score isn't the product."""
    flat = lambda b, c: b.column(c).flatten().to_numpy(zero_copy_only=False)

    def run(batches):
        block, held, iid, V = None, [], None, None
        for batch in batches:
            for x in range(len(batch)):
                b = batch.slice(x, 1)
                of, kind = b.column("block")[0].as_py(), b.column("kind")[0].as_py()
                if of != block:
                    block, held, iid = of, [], None
                if kind == 0:
                    ids = flat(b, "ids")
                    held.append((ids, flat(b, "vectors").reshape(len(ids), -1)))
                    continue
                if not held:
                    continue
                if iid is None:
                    iid, V = (np.concatenate(c) for c in zip(*held))
                    order = np.argsort(iid, kind="stable")
                    iid, V, held = iid[order], V[order], [(None, None)]
                user, at, item, score = flat(b, "users"), flat(b, "at"), flat(b, "ids"), flat(b, "scores")
                U = flat(b, "vectors").reshape(len(user), -1)
                place = np.minimum(np.searchsorted(iid, item), len(iid) - 1)
                known = iid[place] == item
                off = np.zeros(len(item), bool)
                for a in range(0, len(item), RESCORED):
                    s = slice(a, a + RESCORED)
                    product = np.einsum("ij,ij->i", U[at[s]].astype(np.float64), V[place[s]].astype(np.float64))
                    off[s] = ~(np.abs(score[s] - product) < tolerance)
                n, n_off = (np.bincount(at[m], minlength=len(user)) for m in (known, known & off))
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(user[some]), pa.array(flat(b, "flags")[some].astype(bool)), pa.array(n[some].astype(np.int64)), pa.array(n_off[some].astype(np.int64))],
                                                 ["user_id", "flag", "n", "n_off"])
    return run


def listed_products(lists: DataFrame, items: DataFrame, tolerance: float, block: int = LISTED_ITEMS) -> DataFrame:
    """(user_id, flag, n, n_off), a few rows a user: how many listed items there
    are vectors of, and for how many the score isn't the product of the two.

    lists: (user_id, features, items, scores, flag), one row a user; items: (id,
    features), one row an id.  Items are spread over blocks and the lists cut by
    them, so a user's vector travels once per block, not once per listed item."""
    n = max(items.sparkSession.sparkContext.defaultParallelism, -(-items.count() // block))
    kind = lists.schema["features"].dataType
    feats = F.col("features").cast(kind).alias("features")
    ddl = f"block int, kind int, users array<long>, flags array<boolean>, vectors {kind.simpleString()}, at array<int>, ids array<long>, scores array<double>"
    listed = lambda t: pa.list_(t)
    schema = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("users", listed(pa.int64())), ("flags", listed(pa.bool_())),
                        ("vectors", listed(pa.float32() if kind.elementType == T.FloatType() else pa.float64())), ("at", listed(pa.int32())),
                        ("ids", listed(pa.int64())), ("scores", listed(pa.float64()))])
    cut = lists.select("user_id", "flag", feats, "items", "scores").mapInArrow(_list_cutter(n, schema), ddl)
    known = items.select(F.col("id").cast("long").alias("id"), feats).mapInArrow(_item_cutter(n, schema), ddl)
    spread = cut.unionByName(known).repartitionById(n, F.col("block")).sortWithinPartitions("block", "kind")
    return spread.mapInArrow(_list_checker(tolerance), "user_id long, flag boolean, n long, n_off long")


# --------------------------------------------------------- norm-bounded search
BOUND_BLOCK = 1 << 13         # items per block of similar norm


def norm_blocks(items: DataFrame, n_items: int, block: int = BOUND_BLOCK) -> DataFrame:
    """(item_id, features, block): items in blocks of falling norm, of about
    ``block`` rows.  Block borders are approximate quantiles of the norm; where
    many items share a norm, a hash of the id splits them further."""
    i = items.select(F.col("id").cast("long").alias("item_id"), "features", norm_of().alias("norm"))
    n = max(1, math.ceil(n_items / block))
    if n == 1:
        return i.withColumn("block", F.lit(0).cast("long"))
    borders = i.agg(F.percentile_approx("norm", [(n - j) / n for j in range(1, n)], 100 * n).alias("b")).first()["b"]
    borders = np.array(sorted(set(borders)))

    @F.pandas_udf("long")
    def band(norm: pd.Series) -> pd.Series:  # borders above the norm
        return pd.Series(len(borders) - np.searchsorted(borders, norm.to_numpy(), "right"))

    banded = i.withColumn("band", band("norm"))
    sizes = {r["band"]: r["n"] for r in banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per band
    first, parts, at = np.zeros(len(borders) + 1, np.int64), np.ones(len(borders) + 1, np.int64), 0
    for b in sorted(sizes):
        first[b], parts[b] = at, math.ceil(sizes[b] / (2 * block))
        at += parts[b]

    @F.pandas_udf("long")
    def numbered(band: pd.Series, key: pd.Series) -> pd.Series:
        b = band.to_numpy()
        return pd.Series(first[b] + key.to_numpy() % parts[b])

    return banded.select("item_id", "features", "norm", numbered("band", F.xxhash64("item_id")).alias("block"))


class NormBound:
    """Exact top-k that leaves out what norms exclude: no item of a block can
    score more than the query's norm times the block's largest norm.

    Every user is scored against the block of largest norms; its k-th score there
    is a floor of its k-th best score overall.  Then a user meets only the blocks
    that can beat its floor: a user block is held by a task that reads the item
    blocks past it, so neither pairs nor partial lists travel.  Only products
    that can't enter a list are dropped, so the lists are those of
    ``blocked_topk``.
    """

    def __init__(self, users: DataFrame, items: DataFrame, k: int, exclude_self: bool = False, block: int = BOUND_BLOCK,
                 max_block: int = STREAM_BLOCK):
        slots = users.sparkSession.sparkContext.defaultParallelism
        self.k, self.exclude_self = k, exclude_self
        self.n_users, self.n_items = users.count(), items.count()
        self.ub = max(1, math.ceil(self.n_users / max_block), min(slots, self.n_users))
        self.items = materialize(norm_blocks(items, self.n_items, block), "norm_blocks")
        # one row per block: (block, items, largest norm)
        self.blocks = sorted(tuple(r) for r in self.items.groupBy("block").agg(F.count(F.lit(1)), F.max("norm")).collect())
        self.users = user_rows(users)
        self.first = materialize(self._score(self.users, self.items.filter("block = 0")), "norm_first")

    def _score(self, users: DataFrame, items: DataFrame) -> DataFrame:
        i = items.select("item_id", "features", F.lit(0.0).alias("bias"), F.col("block").alias("place"))
        return stream_topk(users, i, self.k, self.ub, exclude_self=self.exclude_self, biased=False)

    def floors(self) -> DataFrame:
        """(user_id, _floor): the k-th score in the block of largest norms."""
        return self.first.filter(F.col("rank") == self.k).select("user_id", F.col("score").alias("_floor"))

    def _floored(self) -> DataFrame:
        return self.users.join(self.floors(), "user_id", "left")

    def top_k(self) -> DataFrame:
        """(user_id, rank, item_id, score), equal to ``blocked_topk``."""
        users = self._floored().withColumn("floor", F.coalesce("_floor", "floor")).drop("_floor")
        return self._score(users, self.items)

    def products(self) -> DataFrame:
        """One row (n_products, n_scored): of all user × item products, those of
        the first block and of the further blocks that can beat the user's floor;
        a user with a short first list meets all."""
        rest = [b for b in self.blocks if b[0] > 0]
        norms, sizes = np.array([m for _, _, m in rest], dtype=np.float64), np.array([n for _, n, _ in rest], dtype=np.int64)

        @F.pandas_udf("long")
        def met(unorm: pd.Series, floor: pd.Series) -> pd.Series:
            n, f, out = unorm.to_numpy(np.float64), floor.to_numpy(np.float64), []
            for a in range(0, len(n), 256):
                useful = n[a: a + 256, None] * norms * (1 + 1e-9) >= f[a: a + 256, None]
                out.append(useful @ sizes)
            return pd.Series(np.concatenate(out) if out else [], dtype="int64")

        floor = F.coalesce("_floor", F.lit(float("-inf")))
        first = self.n_users * (self.blocks[0][1] if self.blocks else 0)
        return self._floored().agg((F.coalesce(F.sum(met(norm_of(), floor)), F.lit(0)) + F.lit(first)).alias("n_scored")).select(
            F.lit(self.n_users * self.n_items).alias("n_products"), "n_scored")


def recs_as_arrays(recs: DataFrame) -> DataFrame:
    """(user_id, reco array<long>) in rank order; lists are bounded by k."""
    srt = F.array_sort(F.collect_list(F.struct("rank", "item_id")))
    return recs.groupBy("user_id").agg(F.transform(srt, lambda s: s["item_id"]).alias("reco"))


def flatten_recs(arrays: DataFrame, col: str = "reco") -> DataFrame:
    """Match matrix to long rows: one (user_id, rank, item_id) per slot."""
    return arrays.select("user_id", F.posexplode(col).alias("pos", "item_id")).select(
        "user_id", (F.col("pos") + 1).cast("long").alias("rank"), F.col("item_id").cast("long"))
