"""Toxicity by cumulative-link ordinal regression on sparse text features.

Grades 0 < 1 < ... < `GRADES` - 1 share one weight vector: P(grade >= j) =
sigmoid(w.x - t_j) with t_1 < t_2 < ...; the score is the expected severity,
the sum of P(grade >= j) over j >= 1.  A feature is the presence of a word (run
of letters and digits, A-Z as a-z) or of a word's beginning (`PREFIXES` bytes,
for inflected words) hashed into 2**`HASH_BITS` buckets; the
`FEATURES` buckets with the largest chi-square against the label are used.

The fit uses at most `SAMPLE` labelled documents of each label (by hash of
doc_id, so the choice is stable), and the thresholds are then moved to the
labels' real share of toxic documents.  Everything else covers all documents.
Where the labels hold no column `severity`, a toxic document's grade is the
third of toxic documents it falls into by its number of telling words (chi-square
features far more frequent in toxic documents).

Defined results: null or blank text has no features (severity of the
thresholds alone, not toxic); without both labels, severity is 0 and nothing is
toxic; equal doc_ids are scored separately; null labels and null doc_ids of
labels are left out; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize
from spark_recs.llm.text import WordHasher, process_state, punctuation_separators, row_slices, text_buffers

GRADES, HASH_BITS, FEATURES, SAMPLE = 4, 18, 256, 8192
PREFIXES = (4, 5)
MIN_DOCS, MIN_CHI, TELLING = 3, 30.0, 2.0  # documents and chi-square of a feature at least; log-odds of a telling word
STEPS, RATE, RIDGE = 250, 0.1, 2e-4


def _present(raw, offsets) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each row, as (row, bucket)."""
    hasher = process_state("plain-words", lambda: WordHasher(punctuation_separators()))
    h, first, *heads = hasher(raw, offsets, PREFIXES)
    row = np.repeat(np.arange(len(first) - 1, dtype=np.uint64), np.diff(first)) << np.uint64(HASH_BITS)
    both = np.unique(np.concatenate([row | x >> np.uint64(64 - HASH_BITS) for x in (h, *heads)]))
    return (both >> np.uint64(HASH_BITS)).astype(np.int64), (both & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64)


def _features(wanted: np.ndarray | None):
    """Rows (id, label, text) to (id, label, buckets); `wanted`: only these, by place."""
    def run(batches):
        for b in batches:
            raw, offsets = text_buffers(b.column(2))
            for i, j in row_slices(offsets):
                row, bucket = _present(raw, offsets[i: j + 1])
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, bucket), len(wanted) - 1)
                    good = wanted[at] == bucket
                    row, bucket = row[good], at[good]
                ends = np.searchsorted(row, np.arange(j - i + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), lists], ["id", "label", "buckets"])
    return run


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(rows: list[np.ndarray], grade: np.ndarray, n_features: int, grades: int = GRADES) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by Adam on the mean log-likelihood with a ridge;
    rows hold the places of the features that are present."""
    size = np.array([len(r) for r in rows])
    col = np.concatenate(rows) if size.sum() else np.zeros(0, int)
    row = np.repeat(np.arange(len(rows)), size)
    share = np.array([(grade >= j).mean() for j in range(1, grades)]).clip(1e-4, 1 - 1e-4)
    start = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(grades - 1))
    # thresholds: the first and the logs of the gaps, so that they stay ordered
    p = np.concatenate([np.zeros(n_features), start[:1], np.log(np.diff(start).clip(1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    n = len(rows)
    for step in range(1, STEPS + 1):
        w, gaps = p[:n_features], np.exp(p[n_features + 1:])
        t = p[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        eta = np.bincount(row, w[col], minlength=n)
        above = np.concatenate([np.ones((n, 1)), sigmoid(eta[:, None] - t[None, :]), np.zeros((n, 1))], axis=1)
        slope = above * (1 - above)
        i = np.arange(n)
        prob = np.maximum(above[i, grade] - above[i, grade + 1], 1e-9)
        d_eta = (slope[i, grade] - slope[i, grade + 1]) / prob / n
        d_t = np.zeros(grades - 1)
        for j in range(1, grades):
            d_t[j - 1] = (np.where(grade == j, -slope[:, j], 0) / prob).sum() / n + (np.where(grade + 1 == j, slope[:, j], 0) / prob).sum() / n
        tail = np.cumsum(d_t[::-1])[::-1]
        g = np.concatenate([np.bincount(col, d_eta[row], minlength=n_features), tail[:1], tail[1:] * gaps])
        g[:n_features] -= RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:n_features], p[n_features] + np.concatenate([[0], np.cumsum(np.exp(p[n_features + 1:]))])


class Model:
    def __init__(self, buckets: np.ndarray, w: np.ndarray, t: np.ndarray):
        self.buckets, self.w, self.t = buckets, w, t


def _grades(label: np.ndarray, rows: list[np.ndarray], telling: np.ndarray) -> np.ndarray:
    hits = np.array([telling[r].sum() for r in rows])
    cuts = np.quantile(hits[label == 1], [1 / 3, 2 / 3]) if (label == 1).any() else [0, 0]
    return np.where(label == 1, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits on at most `sample` labelled documents of each label; None without both."""
    grade = "severity" if "severity" in labels.columns else "toxic"
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(grade).cast("int").alias("_label")).dropna()
    share = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("_label") > 0).cast("int")).alias("t")).first()
    if not share["t"] or share["t"] == share["n"]:
        return None
    chosen = None
    for cond in (F.col("_label") > 0, F.col("_label") <= 0):
        part = known.filter(cond).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # 2 * sample rows of (long, int), whatever the size of the labels; their texts are fetched in one scan and stored
    src = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(chosen), "_id").select("_id", "_label", "text")
    src = materialize(src, "toxicity-sample")
    schema = "id long, label int, buckets array<int>"
    by = (src.mapInArrow(_features(None), schema).select("label", F.explode("buckets").alias("bucket")).groupBy("bucket")
             .agg(F.sum((F.col("label") > 0).cast("int")).alias("t"), F.sum((F.col("label") <= 0).cast("int")).alias("c"))
             .filter(F.col("t") + F.col("c") >= MIN_DOCS))
    size = src.agg(F.sum((F.col("_label") > 0).cast("int")).alias("t"), F.sum((F.col("_label") <= 0).cast("int")).alias("c")).first()
    nt, nc = size["t"] or 0, size["c"] or 0
    if not nt or not nc:
        return None
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    chi = (t * nc - c * nt) ** 2 / ((t + c) * (F.lit(float(nt + nc)) - t - c + 1))
    top = by.orderBy(chi.desc(), "bucket").limit(FEATURES).toPandas().sort_values("bucket", ignore_index=True)
    if not len(top):
        return None
    buckets = top["bucket"].to_numpy(np.int64)
    odds = np.log((top["t"].to_numpy() + 0.5) / (nt + 1)) - np.log((top["c"].to_numpy() + 0.5) / (nc + 1))
    got = src.mapInArrow(_features(buckets), schema).toPandas().sort_values("id", kind="stable", ignore_index=True)
    rows, label = [np.asarray(x, dtype=np.int64) for x in got["buckets"]], got["label"].to_numpy(np.int64)
    y = label.clip(0, GRADES - 1) if grade == "severity" else _grades(label, rows, odds > TELLING)
    w, cuts = fit_ordinal(rows, y, len(buckets))
    real, seen = share["t"] / share["n"], nt / (nt + nc)
    shift = math.log(seen / (1 - seen)) - math.log(real / (1 - real))
    return Model(buckets, w, cuts + shift)


def _score(model: Model | None):
    def run(batches):
        dense = np.zeros(1 << HASH_BITS)
        if model is not None:
            dense[model.buckets] = model.w
        for b in batches:
            raw, offsets = text_buffers(b.column(1))
            for i, j in row_slices(offsets):
                n = j - i
                if model is None:
                    above = np.zeros((n, 1))
                else:
                    row, bucket = _present(raw, offsets[i: j + 1])
                    eta = np.bincount(row, dense[bucket], minlength=n)
                    some = np.bincount(row, minlength=n) > 0
                    above = sigmoid(eta[:, None] - model.t[None, :])
                    above[~some, 0] = np.minimum(above[~some, 0], 0.49)
                severity = above.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), pa.array(np.round(severity, 6)), pa.array((above >= 0.5).sum(axis=1)), pa.array(above[:, 0] >= 0.5)],
                    ["doc_id", "expected_severity", "grade", "toxic"])
    return run


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, expected_severity, grade (grades reached with even odds) and toxic of each row."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInArrow(_score(model), "doc_id long, expected_severity double, grade long, toxic boolean")


def severity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
