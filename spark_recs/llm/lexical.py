"""Documents ranked for each benchmark item by an Aho-Corasick scan of the texts.

All terms of the items, each guarded by a boundary on both sides, make one
automaton, which goes to the tasks and counts term occurrences straight from
the text; no index of the documents is made.  An output of the automaton is a
term number, which maps to the items that hold the term.

Two scans: the first counts what the weights need (documents, their terms, and
each item term's documents), the second scores every document for every item
and keeps each item's best `k` of the task, which are then merged by item.

Items are sent in blocks of at most about `BLOCK_BYTES` of text (one item at
least), so what is sent stays bounded however many items there are; an item is
in one block.

Defined results: null text and text without terms match nothing and count
nowhere; equal rows of items are one, and different texts of one item_id are one
item with the terms of all; an item without terms has no rows; a null item_id
is an item of that name; documents are rows, so equal doc_ids are ranked
separately, a null doc_id after all others of its score; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_recs.llm.text import process_state, punctuation_separators, row_slices, text_buffers

TOP = 10
BLOCK_BYTES = 4 << 20
CELLS = 1 << 20                # scores held at once in a task
BEST = "item int, doc_id long, score long"
STATS = "term int, n long"
_DOCS, _TERMS = -1, -2         # places of N and L among the term counts


def _folded() -> np.ndarray:
    """Bytes of terms as they are but A-Z as a-z; all others a space."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[punctuation_separators()] = 32
    return t


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_folded().tobytes()).split()


class ItemBlock:
    """The items of one block: their ids, the distinct terms, and per term the
    items that hold it, with their numbers of it."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        held: dict[int | None, Counter] = {}
        for item_id, text in rows:
            held.setdefault(item_id, Counter()).update(terms(text))
        self.ids = [i for i, c in held.items() if c]
        self.terms = sorted({t for c in held.values() for t in c})
        number = {t: i for i, t in enumerate(self.terms)}
        entries = sorted((number[t], i, n) for i, c in enumerate(c for c in held.values() if c) for t, n in c.items())
        of_term, self.item, self.times = (np.array(x, dtype=np.int64) for x in (zip(*entries) if entries else ([], [], [])))
        self.first = np.searchsorted(of_term, np.arange(len(self.terms) + 1))
        self.name = uuid.uuid4().hex

    def automaton(self):
        """Built once per worker process; the last block's is kept."""
        def build():
            import ahocorasick
            a = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                a.add_word(f" {t.decode('latin-1')} ", i)
            a.make_automaton()
            return a
        box = process_state("lexical-automaton", dict)
        if self.name not in box:
            box.clear()
            box[self.name] = build()
        return box[self.name]

    def occurrences(self, raw: np.ndarray, offsets: np.ndarray):
        """(n, row, term, tf): the texts' numbers of terms, and a line per text
        and item term that it holds."""
        lo = int(offsets[0])
        buf, off = _folded()[raw[lo: int(offsets[-1])]], offsets - lo
        inside = np.zeros(len(buf) + 1, dtype=bool)
        inside[1:] = buf != 32
        begins = inside[1:] & ~inside[:-1]
        at = off[:-1][off[:-1] < off[1:]]
        begins[at] = inside[at + 1]                      # a row begins anew
        n = np.diff(np.r_[0, np.cumsum(begins)][off])
        find, value = self.automaton().iter, itemgetter(1)
        out, ends = [], []
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            out += map(value, find(f" {buf[a:b].tobytes().decode('latin-1')} "))
            ends.append(len(out))
        row = np.repeat(np.arange(len(n)), np.diff(ends, prepend=0))
        key, tf = np.unique(row * len(self.terms) + np.array(out, dtype=np.int64), return_counts=True)
        return n, key // len(self.terms), key % len(self.terms), tf


def _slices(block: ItemBlock, batches, rows: int):
    for b in batches:
        col = b.column(b.schema.get_field_index("text"))
        raw, offsets = text_buffers(col)
        for i, j in row_slices(offsets):
            for a in range(i, j, rows):
                z = min(j, a + rows)
                yield b.slice(a, z - a), block.occurrences(raw, offsets[a: z + 1])


def _count(block: ItemBlock):
    def run(batches):
        df, n_docs, n_terms = np.zeros(len(block.terms), dtype=np.int64), 0, 0
        for _, (n, _, term, _) in _slices(block, batches, CELLS):
            df += np.bincount(term, minlength=len(df))
            n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([_DOCS, _TERMS, *held.tolist()], pa.int32()), pa.array([n_docs, n_terms, *df[held].tolist()], pa.int64())], ["term", "n"])
    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _best(item, key, null, score, k: int):
    """Places of each item's best k: highest score, then smallest doc_id, nulls last."""
    order = np.lexsort((key, null, -score, item))
    s = item[order]
    place = np.arange(len(s)) - np.searchsorted(s, s)
    return order[place < k]


def _rank(block: ItemBlock, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    n_items = len(block.ids)
    worth = weights[np.repeat(np.arange(len(block.terms)), np.diff(block.first))] * block.times
    # a term's part is below its weight times 10**6; sums below 2**53 are exact as doubles
    exact = np.bincount(block.item, weights=worth, minlength=n_items).max(initial=0) * 1e6 < 2 ** 53

    def scores(row, term, part, rows):
        at, size = block.first[term], np.diff(block.first)[term]
        line = np.repeat(np.arange(len(term)), size)
        entry = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size) + at[line]
        cell, value = row[line] * n_items + block.item[entry], part[line] * worth[entry]
        if exact:
            return np.bincount(cell, weights=value, minlength=rows * n_items).astype(np.int64)
        out = np.zeros(rows * n_items, dtype=np.int64)
        np.add.at(out, cell, value)
        return out

    def run(batches):
        kept = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)]
        least = np.ones(n_items, dtype=np.int64)
        for b, (n, row, term, tf) in _slices(block, batches, max(1, CELLS // n_items)):
            m = np.array([25 + 75 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)
            s = scores(row, term, 1_000_000_000 * tf // (1000 * tf + 8 * m[row]), b.num_rows)
            cell = np.flatnonzero(s)
            item = cell % n_items
            good = s[cell] >= least[item]
            if not good.any():
                continue
            cell, item = cell[good], item[good]
            col = b.column(b.schema.get_field_index("doc_id"))
            at = cell // n_items
            new = [item, np.array(col.fill_null(0), dtype=np.int64)[at], np.array(col.is_null(), dtype=bool)[at], s[cell]]
            kept = [np.concatenate(x) for x in zip(kept, new)]
            top = _best(*kept, k)
            kept = [x[top] for x in kept]
            full = np.bincount(kept[0], minlength=n_items) >= k
            low = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(low, kept[0], kept[3])
            least = np.where(full, low, 1)
        item, key, null, score = kept
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(key, pa.int64(), mask=null), pa.array(score, pa.int64())], ["item", "doc_id", "score"])
    return run


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The items' rows, block by block; more blocks until each is within the
    bound or holds one item."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    block = lambda n: F.pmod(F.xxhash64("item_id"), F.lit(n)).alias("block")
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-total // block_bytes))
    while n > 1 and (rows.groupBy(block(n)).agg(F.sum(F.octet_length("text")).alias("n"), F.count_distinct(F.coalesce("item_id", F.lit(-1))).alias("ids"))
                         .filter((F.col("n") > 2 * block_bytes) & (F.col("ids") > 1)).limit(1).count()):
        n *= 2
    for i in range(n):
        part = rows.filter(block(n) == i) if n > 1 else rows
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `k` highest-scoring documents
    with a score above 0."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for rows in item_blocks(items, block_bytes):
        block = ItemBlock(rows)
        if not block.ids:
            continue
        counted = dict(src.mapInArrow(_count(block), STATS).groupBy("term").agg(F.sum("n").alias("n")).collect())
        n_docs, n_terms = counted.get(_DOCS, 0), counted.get(_TERMS, 0)
        if not n_docs:
            continue
        weights = np.array([weight(n_docs, counted.get(t, 0)) for t in range(len(block.terms))], dtype=np.int64)
        best = src.mapInArrow(_rank(block, weights, n_docs, n_terms, k), BEST)
        names = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long"))
        out = out.unionByName(best.join(names, "item").select("item_id", "doc_id", "score"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
               .select("item_id", "rank", "doc_id", "score"))
