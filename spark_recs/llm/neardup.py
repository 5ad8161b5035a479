"""Near duplicates by b-bit MinHash signatures and a multi-index Hamming join.

1. A document's set is its distinct `SHINGLE`-word shingles (A-Z as a-z), as
   64-bit hashes.  Its signature is `PLACES` MinHash values of `BITS` bits.
   Two signatures' distance is the number of places in which they differ.
2. Documents with equal sets (count and 128-bit sum of mixed hashes) form a
   class; its smallest doc_id stands for it.
3. The signature is split into `CHUNKS` chunks.  Two signatures that differ in
   at most `MAX_DISTANCE` places differ in at most `CHUNK_ERRORS` places of some
   chunk (pigeonhole, checked below).  A class is filed under every chunk with
   every choice of that many places left out, so all pairs within the distance
   share a key: none is missed.
4. Classes that share a key and lie within the distance are candidates.  They
   are joined into clusters, of which only a spanning forest leaves a task, so a
   group of n copies yields n rows and not n * n.  A key with over `KEY_ROWS`
   classes joins them without comparing (a superset, which step 5 resolves).
5. Each cluster's sets are compared exactly, whole pairs of blocks at a time
   (blocks of `BLOCK_ROWS` documents and `BLOCK_SHINGLES` shingles); a task
   yields a spanning forest of the true links.  Their connected components are
   the result.

At the threshold's Jaccard of 0.85 a place differs with probability 0.15, and a
linked pair's 60 places differ in more than 23 with probability 2e-6; more
similar pairs less.  Another threshold gets as many chunks as keep that
probability (`chunks_for`: 21, 105 places and distance 41 at 0.8).  That, and equal 64-bit hashes of different shingles, are
the only ways to miss or add a link.

Defined results: null or blank text has an empty set and is linked with
nothing; a text with fewer words than a shingle has one shingle, all its words;
rows of equal doc_id are one node, linked by the text of each (a row without
words keeps its doc_id as component); a null doc_id is kept, linked with nothing, and
its component is null; an empty table gives no rows; further columns are
ignored by `near_duplicates` and kept by `keep_first`, which drops the rows of
one doc_id together.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_recs.llm.components import components
from spark_recs.llm.store import materialize
from spark_recs.llm.text import WordHasher, mix64, process_state, row_slices, shingles, space_separators, text_buffers

SHINGLE = 3
NUM, DEN = 85, 100            # linked: DEN * intersection >= NUM * union
PLACES, CHUNKS, CHUNK_ERRORS, MAX_DISTANCE = 60, 12, 1, 23
BITS = 8
WIDTH = PLACES // CHUNKS
KEY_ROWS, BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1024, 1 << 20
MISS = 2.4e-6                 # largest probability of missing a pair at the threshold
assert MAX_DISTANCE < CHUNKS * (CHUNK_ERRORS + 1) and CHUNK_ERRORS == 1
_U = np.uint64
_SETS = "doc_id long, n_shingles long, f1 long, f2 long, sig binary"


def distance_of(places: int) -> int:
    """The largest distance at which signatures of so many places share a key."""
    return places // WIDTH * (CHUNK_ERRORS + 1) - 1


def chunks_for(num: int, den: int) -> int:
    """The fewest chunks that miss a pair at the threshold with at most MISS."""
    p = 1 - num / den
    for chunks in range(1, 200):
        n = chunks * WIDTH
        if sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(distance_of(n) + 1, n + 1)) <= MISS:
            return chunks
    raise ValueError(f"a similarity of {num} / {den} is too low for signatures")


def _hasher() -> WordHasher:
    return process_state("space-words", lambda: WordHasher(space_separators()))


def sets_of(raw: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Each row's set, sorted."""
    h, first = _hasher()(raw, offsets)
    sh = shingles(h, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(sh[a: b - k + 1]))
        elif b > a:
            out.append(mix64(shingles(h[a:b], b - a) + _U(b - a)))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out


def _multipliers(places: int) -> np.ndarray:
    return (mix64(np.arange(1, places + 1, dtype=_U)) >> _U(32)).astype(np.uint32) | np.uint32(1)


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """(rows, places) uint8; empty sets get zeros."""
    n = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), places), dtype=np.uint8)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    x = (np.concatenate([sets[i] for i in full]) >> _U(32)).astype(np.uint32)
    at = np.cumsum(n[full]) - n[full]
    add = (mix64(np.arange(101, 101 + places, dtype=_U))).astype(np.uint32)
    for p, (a, c) in enumerate(zip(_multipliers(places), add)):
        low = np.minimum.reduceat(x * a + c, at)
        out[full, p] = (mix64(low.astype(_U)) >> _U(64 - BITS)).astype(np.uint8)
    return out


def _describe(k: int, places: int):
    def run(batches):
        for b in batches:
            raw, offsets = text_buffers(b.column(1))
            for i, j in row_slices(offsets):
                sets = sets_of(raw, offsets[i: j + 1], k)
                sig = signatures(sets, places)
                f1 = [int(mix64(s ^ _U(0x1234567)).sum(dtype=_U)) for s in sets]
                f2 = [int(mix64(s + _U(0x89ABCDEF)).sum(dtype=_U)) for s in sets]
                signed = lambda v: np.array(v, dtype=_U).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(signed(f1)),
                     pa.array(signed(f2)), pa.array([r.tobytes() for r in sig], pa.binary())],
                    ["doc_id", "n_shingles", "f1", "f2", "sig"])
    return run


def describe(docs: DataFrame, k: int = SHINGLE, places: int = PLACES) -> DataFrame:
    """doc_id, set size, 128-bit set fingerprint and signature of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_describe(k, places), _SETS)


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """(rows, places) int64: of each chunk with each one place left out."""
    chunks = sig.reshape(len(sig), sig.shape[1] // WIDTH, WIDTH).astype(_U)
    keys = []
    for c in range(chunks.shape[1]):
        for skip in range(WIDTH):
            code = np.full(len(sig), c * WIDTH + skip + 1, dtype=_U)
            for j in range(WIDTH):
                if j != skip:
                    code = code * _U(257) + chunks[:, c, j] + _U(1)
            keys.append(mix64(code))
    return np.stack(keys, axis=1).view(np.int64)


def _file(places: int):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint8).reshape(-1, places)
                keys = chunk_keys(sig)
                ids = np.array(part.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(ids, keys.shape[1]))], ["key", "id"])
    return run


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of each of n nodes' component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _forest(key: np.ndarray, ids: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, root) joining rows of equal (sorted) key within the distance."""
    nodes, at = np.unique(ids, return_inverse=True)
    left, right, gap = [], [], 1
    live = np.flatnonzero(key[1:] == key[:-1])
    while len(live):
        for i in range(0, len(live), 1 << 16):
            p = live[i: i + (1 << 16)]
            near = p[(sig[p] != sig[p + gap]).sum(axis=1) <= distance_of(sig.shape[1])]
            left.append(at[near])
            right.append(at[near + gap])
        gap += 1
        live = live[live + gap < len(key)]
        live = live[key[live] == key[live + gap]]
    if not left:
        return ids[:0], ids[:0]
    root = roots(np.concatenate(left), np.concatenate(right), len(nodes))
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _candidates(places: int):
    """Rows (key, id, sig) sorted by key, at most KEY_ROWS of a key."""
    def run(batches):
        rest = None
        for b in batches:
            key, ids = np.array(b.column(0)), np.array(b.column(1))
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype=np.uint8).reshape(-1, places)
            if rest is not None:
                key, ids, sig = np.concatenate([rest[0], key]), np.concatenate([rest[1], ids]), np.concatenate([rest[2], sig])
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            rest = key[cut:], ids[cut:], sig[cut:]
            if cut:
                x, y = _forest(key[:cut], ids[:cut], sig[:cut])
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
        if rest is not None and len(rest[0]):
            x, y = _forest(*rest)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])
    return run


def _to_sets(k: int):
    def run(batches):
        for b in batches:
            raw, offsets = text_buffers(b.column(3))
            for i, j in row_slices(offsets):
                sets = sets_of(raw, offsets[i: j + 1], k)
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in b.columns[:3]], pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "cluster", "blocks", "set"])
    return run


def linked(sets: list[np.ndarray], num: int = NUM, den: int = DEN, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) with den * intersection >= num * union, exactly: the
    shingles that two or more sets share are the columns of a 0/1 matrix,
    multiplied with itself a group of columns at a time."""
    n = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets) if len(sets) else np.zeros(0, _U), np.repeat(np.arange(len(sets)), n)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, int)
    size = np.diff(np.r_[new, len(flat)])
    column = np.repeat(np.where(size > 1, np.cumsum(size > 1) - 1, -1), size)
    row, column = row[column >= 0], column[column >= 0]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [c, c + step])
        m = np.zeros((len(sets), step), dtype=np.float32)
        m[row[lo:hi], column[lo:hi] - c] = 1
        both += m @ m.T
    inter = both.astype(np.int64)
    return np.nonzero(np.triu((den * inter >= num * (n[:, None] + n[None, :] - inter)) & (inter > 0), 1))


def _verify(num: int, den: int):
    def run(key, g):
        g = g.drop_duplicates(["id", "set"]).sort_values(["id", "set"], ignore_index=True)
        ids = g["id"].to_numpy(np.int64)
        i, j = linked([np.frombuffer(s, dtype=_U) for s in g["set"]], num, den)
        root = roots(i, j, len(ids))
        child = np.flatnonzero(root != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[child], "b": ids[root[child]]})
    return run


def links(docs: DataFrame, members: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """A spanning forest (a, b) of the exact links inside each cluster of
    `members` (id, cluster, n)."""
    size = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    size = materialize(size.select("cluster", blocks.alias("blocks")), "cluster-sizes")
    # light rows get their cluster's blocks; sort-merge joins at every size, as these sides grow with the
    # corpus and a hot cluster's partition can be split; the sets are then shuffled once, by block pair
    placed = members.join(size.hint("merge"), "cluster").select("id", "cluster", "blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(placed.hint("merge"), "id")
    sets = texts.select("id", "cluster", "blocks", "text").mapInArrow(_to_sets(k), "id long, cluster long, blocks int, set binary")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (sets.withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("id", "set", "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    return dealt.groupBy("cluster", "i", "j").applyInPandas(_verify(num, den), "a long, b long")


def _one_node(rows: DataFrame, classes: DataFrame, same: list[str]) -> DataFrame:
    """(a, b) between the classes that hold texts of one doc_id.  Rows are told
    apart by the extremes of their sets' hashes; only such doc_ids go further."""
    ends = [f(c).alias(f"{n}_{c}") for c in same for n, f in (("lo", F.min), ("hi", F.max))]
    differ = " OR ".join(f"lo_{c} <> hi_{c}" for c in same)
    twice = rows.groupBy("doc_id").agg(*ends).filter(differ).select("doc_id")
    held = rows.join(twice, "doc_id", "left_semi").join(classes, same).select("doc_id", "id")
    low = held.groupBy("doc_id").agg(F.min("id").alias("a"))
    return held.join(low, "doc_id").select("a", F.col("id").alias("b"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of `docs` (doc_id, text)."""
    places = chunks_for(num, den) * WIDTH
    described = materialize(describe(docs, k, places), "sets")
    rows = described.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "f1", "f2"]
    classes = materialize(rows.groupBy(*same).agg(F.min("doc_id").alias("id")), "classes")
    signed = materialize(rows.join(classes.select(F.col("id").alias("doc_id"), *same), ["doc_id", *same], "left_semi")
                             .dropDuplicates(["doc_id", *same]).select(F.col("doc_id").alias("id"), "n_shingles", "sig"), "signatures")
    filed = materialize(signed.select("id", "sig").mapInArrow(_file(places), "key long, id long"), "keys")
    shared = filed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low")).filter("n > 1")
    meet = materialize(filed.join(shared, "key"), "meetings")
    few = meet.filter(F.col("n") <= KEY_ROWS).join(signed.select("id", "sig"), "id").select("key", "id", "sig")
    found = few.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_candidates(places), "a long, b long")
    many = meet.filter((F.col("n") > KEY_ROWS) & (F.col("id") != F.col("low"))).select(F.col("id").alias("a"), F.col("low").alias("b"))
    clusters = components(found.unionByName(many).distinct())
    members = materialize(clusters.select(F.col("node").alias("id"), F.col("component").alias("cluster"))
                                  .join(signed.groupBy("id").agg(F.sum("n_shingles").alias("n")), "id"), "members")
    joined = components(links(docs, members, k, num, den).unionByName(_one_node(rows, classes, same)))
    named = classes.join(joined.select(F.col("node").alias("id"), "component"), "id", "left").select(
        *same, F.coalesce("component", "id").alias("component"))
    result = described.join(named, same, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")).alias("component"))
    return result.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stand for their group, with their own columns."""
    go = near_duplicates(docs, **options).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(go.hint("merge"), docs["doc_id"] == go["_gone"], "left_anti")
