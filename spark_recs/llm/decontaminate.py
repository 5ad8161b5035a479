"""Benchmark passages found in documents by CGK embedding and bit-sampling LSH.

A leak is a run of a document's words within `MAX_EDIT` of an item's words in
word edit distance (insert, delete, replace; the limit is floor(MAX_EDIT *
words)).  Words are runs of letters and digits, A-Z as a-z; in scripts without
spaces each character is a word.

The CGK embedding walks over a word sequence: at step j it writes the word
under the pointer and moves on if bit j of the word's random bits is set, else
stays.  Two sequences with few edits fall back into step, so edit distance
becomes Hamming distance of what they write.  Each table samples `SAMPLES` of
the steps of one walk as its code.  Every word of every document starts a
walk; an item is embedded from every `ANCHOR`-th word on, so that some start
has few edits near by.  Items below `SHORT_WORDS` words have too few such starts
at the edit limit: they get short walks from every second word, and items below
`TINY_WORDS` from every word.  A shared code makes a candidate, which Myers' algorithm
verifies exactly over the whole item and an item-sized window around it, unless
the window lacks more of the item's words than edits are allowed.

Items are sent to the tasks in passes of at most `PASS_WORDS` words, so what is
sent stays bounded however long the benchmark is.  Documents aren't shuffled.

Items of fewer than `MIN_WORDS` words allow no edit: their whole run of words
is one key, and a document's equal run is the leak.

Defined results: null text and text without words match nothing; items of
fewer than `MIN_WORDS` words and of fewer than `MIN_LETTERS` letters match
nothing (too short to tell a leak); a null
item_id is reported as null; equal rows are judged separately, and reported
once per (doc_id, item_id); empty tables give no leaks; further columns are
ignored by `leaks` and kept by `keep_clean`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.text import UNSPACED, WordHasher, mix64, process_state, punctuation_separators, row_slices, shingles, text_buffers

MAX_EDIT = 0.2
WALKS, TABLES, SAMPLES, STEPS = 3, 4, 5, 24
SHORT_SAMPLES, SHORT_STEPS, SHORT_WORDS = 4, 8, 32   # tables for items of fewer words
TINY_SAMPLES, TINY_STEPS, TINY_WORDS = 3, 6, 12      # and of yet fewer
ANCHOR, SHORT_ANCHOR, TINY_ANCHOR, MIN_WORDS = 6, 2, 1, 5
MIN_LETTERS = 20                                     # bytes of the words of an item below MIN_WORDS
PLACES, SHORT_PLACES, TINY_PLACES = 1, 3, 2          # words that an item's code must have read
PASS_WORDS = 200_000
SLOTS = 20                                          # bits of the table that sifts codes
_U = np.uint64
_PAD = _U(0x5851F42D4C957F2D)


def word_hasher() -> WordHasher:
    return WordHasher(punctuation_separators(), characters=True)


def _tables(steps: int, samples: int) -> list[list[np.ndarray]]:
    rng = np.random.default_rng(steps)
    return [[np.sort(rng.choice(steps, samples, replace=False)) for _ in range(TABLES)] for _ in range(WALKS)]


def codes(symbols: np.ndarray, starts: np.ndarray, steps: int, samples: int):
    """For each table: a 64-bit code of the walk from each start.  `symbols`
    must go on for `steps` places after every start."""
    for walk, tables in enumerate(_tables(steps, samples)):
        bits = mix64(symbols + _U(walk * 0x9E3779B9 + 1))
        at = starts.copy()
        out = [np.full(len(starts), walk * TABLES + t + 1, dtype=_U) for t in range(TABLES)]
        for j in range(max(int(t[-1]) for t in tables) + 1):
            word = bits[at]
            for t, chosen in enumerate(tables):
                if j in chosen:
                    out[t] += word
                    out[t] *= _U(0x9E3779B97F4A7C15)
            at += ((word >> _U(j)) & _U(1)).astype(at.dtype)
        for t in range(TABLES):
            yield out[t]


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(distance, end) of the run of `text` closest to `item` (Myers, one bit per word)."""
    m = len(item)
    eq: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        eq[w] = eq.get(w, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text.tolist()):
        x = eq.get(w, 0)
        d0 = (((x & pv) + pv) ^ pv) | x | mv
        hp, hm = (mv | ~(d0 | pv)) & full, pv & d0
        score += 1 if hp & high else -1 if hm & high else 0
        hp, hm = hp << 1, hm << 1
        pv, mv = (hm | ~(d0 | hp)) & full, hp & d0 & full
        if score < best:
            best, end = score, j + 1
    return best, end


def reach(symbols: np.ndarray, starts: np.ndarray, steps: int, samples: int):
    """For each table: how many places of `symbols` the code from each start has read."""
    for walk, tables in enumerate(_tables(steps, samples)):
        bits = mix64(symbols + _U(walk * 0x9E3779B9 + 1))
        at, read = starts.copy(), []
        for j in range(steps):
            read.append(at.copy())
            at += ((bits[at] >> _U(j)) & _U(1)).astype(at.dtype)
        for chosen in tables:
            places = np.stack([read[j] for j in chosen])
            yield 1 + (places[1:] != places[:-1]).sum(axis=0)


class Items:
    """The embedded items of one pass."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        hasher = word_hasher()
        raw, offsets = text_buffers(pa.array([t for _, t in rows], pa.string()))
        h, first = hasher(raw, offsets)
        letters = np.diff(np.r_[0, np.cumsum(~hasher.sep[raw])][offsets])
        self.ids = [i for i, _ in rows]
        self.words = [h[a:b] for a, b in zip(first[:-1], first[1:])]
        self.distinct = [frozenset(w.tolist()) for w in self.words]
        self.exact: dict[int, dict[int, list[int]]] = {}  # words: key of the run: items
        for i, w in enumerate(self.words):
            if 0 < len(w) < MIN_WORDS and letters[i] >= MIN_LETTERS:
                self.exact.setdefault(len(w), {}).setdefault(int(shingles(w, len(w))[0]), []).append(i)
        self.families = []
        for steps, samples, anchor, enough, least, most in (
                (STEPS, SAMPLES, ANCHOR, PLACES, SHORT_WORDS, None),
                (SHORT_STEPS, SHORT_SAMPLES, SHORT_ANCHOR, SHORT_PLACES, TINY_WORDS, SHORT_WORDS),
                (TINY_STEPS, TINY_SAMPLES, TINY_ANCHOR, TINY_PLACES, MIN_WORDS, TINY_WORDS)):
            symbols, starts, owner, offset = [], [], [], []
            base = 0
            for i, w in enumerate(self.words):
                if least <= len(w) and (most is None or len(w) < most):
                    for a in range(0, len(w), anchor):
                        if a == 0 or len(w) - a >= steps // 2:
                            starts.append(base + a)
                            owner.append(i)
                            offset.append(a)
                    symbols += [w, np.full(steps, _PAD)]
                    base += len(w) + steps
            if starts:
                symbols, starts = np.concatenate(symbols), np.array(starts)
                owner, offset = np.array(owner), np.array(offset)
                tables = []
                for c, places in zip(codes(symbols, starts, steps, samples), reach(symbols, starts, steps, samples)):
                    # a code of one or two words meets any text that has them; the dense tables do without
                    order = np.argsort(c)
                    order = order[places[order] >= enough]
                    sieve = np.zeros(1 << SLOTS, dtype=bool)
                    sieve[c[order] >> _U(64 - SLOTS)] = True
                    tables.append((sieve, c[order], owner[order], offset[order]))
                self.families.append((steps, samples, tables))

    def matches(self, h: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """{(row, item): (distance, start word)} of the rows' leaks."""
        n, rows = np.diff(first), len(first) - 1
        found: dict[tuple[int, int], tuple[int, int]] = {}
        tried = set()
        row_of = np.repeat(np.arange(rows), n)
        place = np.arange(len(h)) - np.repeat(first[:-1], n)
        for size, known in self.exact.items():
            runs = shingles(h, size)
            for p in np.flatnonzero(np.isin(runs, np.array(list(known), dtype=_U))).tolist():
                if place[p] + size <= n[row_of[p]]:
                    for item in known[int(runs[p])]:
                        found.setdefault((int(row_of[p]), item), (0, int(place[p])))
        for steps, samples, tables in self.families:
            symbols = np.full(len(h) + rows * steps, _PAD)
            starts = np.arange(len(h)) + row_of * steps
            symbols[starts] = h
            for (sieve, known, owner, offset), c in zip(tables, codes(symbols, starts, steps, samples)):
                hit = np.flatnonzero(sieve[c >> _U(64 - SLOTS)])
                lo, hi = np.searchsorted(known, c[hit]), np.searchsorted(known, c[hit], side="right")
                for p, a, b in zip(hit[lo < hi].tolist(), lo[lo < hi].tolist(), hi[lo < hi].tolist()):
                    for k in range(a, b):
                        row, item = int(row_of[p]), int(owner[k])
                        start = int(place[p]) - int(offset[k])
                        if (row, item, start) in tried or found.get((row, item), (1,))[0] == 0:
                            continue
                        tried.add((row, item, start))
                        words = self.words[item]
                        limit = int(MAX_EDIT * len(words))
                        lo_w, hi_w = max(0, start - limit), start + len(words) + 2 * limit
                        text = h[first[row] + lo_w: min(first[row] + hi_w, first[row + 1])]
                        # each word of the item that the window lacks costs an edit at least
                        distinct = self.distinct[item]
                        if len(distinct) - len(distinct.intersection(text.tolist())) > limit:
                            continue
                        distance, end = best_match(words, text)
                        if distance <= limit:
                            new = (distance, max(0, lo_w + end - len(words)))
                            found[row, item] = min(new, found.get((row, item), new))
        return found


def _scan(rows, out):
    def run(batches):
        items, hasher = Items(rows), process_state("character-words", word_hasher)
        for b in batches:
            raw, offsets = text_buffers(b.column(b.schema.get_field_index("text")))
            for i, j in row_slices(offsets):
                h, first = hasher(raw, offsets[i: j + 1])
                got = out(b.slice(i, j - i), items, items.matches(h, first))
                if got.num_rows:
                    yield got
    return run


def _report(b, items, found):
    keys = b.column(0).to_pylist()
    rows = [(keys[r], items.ids[i], d, at) for (r, i), (d, at) in sorted(found.items())]
    cols = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "distance", "start_word"])


def _clean(b, items, found):
    gone = {r for r, _ in found}
    return b.filter(pa.array([r not in gone for r in range(b.num_rows)], pa.bool_())) if gone else b


def _passes(benchmark: DataFrame, pass_words: int):
    """The items' rows, at most about `pass_words` words at a time; an item is in one pass."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    alone = "".join(f"\\x{{{lo:X}}}-\\x{{{hi - 1:X}}}" for lo, hi in UNSPACED)
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(rf"[{alone}]|[0-9A-Za-z[^\x00-\x7F]&&[^{alone}]]+"))
    total = items.agg(F.sum(size).alias("n")).first()["n"] or 0
    n = -(-total // pass_words)
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def leaks(docs: DataFrame, benchmark: DataFrame, pass_words: int = PASS_WORDS) -> DataFrame:
    """(doc_id, item_id, distance, start_word) of every leak: the best match of
    each document with each item; start_word counts words as matched here."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, distance long, start_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for rows in _passes(benchmark, pass_words):
        out = out.unionByName(src.mapInArrow(_scan(rows, _report), schema))
    best = out.groupBy("doc_id", "item_id").agg(F.min(F.struct("distance", "start_word")).alias("m"))
    return best.select("doc_id", "item_id", "m.distance", "m.start_word")


def keep_clean(docs: DataFrame, benchmark: DataFrame, pass_words: int = PASS_WORDS) -> DataFrame:
    """The rows of `docs` without a leak, with their own columns."""
    columns = docs.columns
    out = docs.toDF(*[c if c == "text" else f"_c{i}" for i, c in enumerate(columns)])
    for rows in _passes(benchmark, pass_words):
        out = out.mapInArrow(_scan(rows, _clean), out.schema)
    return out.toDF(*columns)
