"""Quality rules: base counts and a hashed n-gram log-likelihood ratio.

Words are runs of anything but white space; n-grams are the single words and
each word with the next one (the last with the end), hashed into `BUCKETS` buckets.  Two multinomials over
the buckets are counted: the trusted target (documents labelled quality 1) and
the raw corpus (all documents), each smoothed by `ALPHA` of its mean count.  A
document's score is the mean of log p_target - log p_raw over its n-grams, kept
as whole micro-nats so that a sum doesn't depend on its order.  A document is
kept if it passes the base rules and its score is at least `MIN_SCORE`.

Everything is DataFrame functions.  The corpus is counted where it is read, with
partial aggregates of at most `BUCKETS` rows.  Only the trusted documents' texts
are shuffled, to meet their labels: a bitmap of the trusted ids' hashes, `PARTS` x
4 KB whatever their number, lets nearly all others go before (where the trusted
ids outnumber its bits, it lets all pass, and the join alone decides).  The finished weights, `BUCKETS` numbers
whatever the corpus, become a constant of the scoring plan, so that scoring
and filtering are one pass without a shuffle.

Defined results: null or blank text has no words, all counts 0, fails the base
rules and has score null; without trusted documents every score is 0; equal
doc_ids are judged separately (all are trusted if one label says so); an empty
table gives no rows; further columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize

BUCKETS = 1 << 14
ALPHA = 0.05          # of the mean count of a bucket
MIN_SCORE = -0.12     # nats per n-gram
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
MICRO = 1_000_000
PARTS, PART_BITS = 256, 1 << 15  # of the bitmap: 1 MB
VERDICT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
_SPACE = r"[\x20\x09-\x0D]+"
#: Always true, but not deterministic to the optimizer: a filter on a column made with it stays above the
#: projections.  Pushed below them, every array expression would be written out where it is used, also
#: inside the function that runs for each word.
_GUARD = lambda: F.monotonically_increasing_id() >= 0
_TMP = ["_t", "_w", "_h", "_b", "_lines", "_win", "_pairs"]


def _hashes(docs: DataFrame) -> DataFrame:
    """Adds _t (text, null as empty), _w (words), _h (their 64-bit hashes) and
    _b (of each word with the next one, the last with the end of the text).
    Each stands in a projection of its own, so that none is evaluated twice."""
    h = F.col("_h")
    return (docs.withColumn("_t", F.coalesce("text", F.lit("")))
                .withColumn("_w", F.array_remove(F.split("_t", _SPACE), ""))
                .withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
                .withColumn("_b", F.zip_with(h, F.slice(h, 2, F.size(h)), lambda x, y: F.xxhash64(x, y))))


def _with_base(docs: DataFrame) -> DataFrame:
    """Adds the base columns, _h and _b; counts that need the text or the words
    come first, so that no later projection carries those.  Repeated words:
    windows of three are sorted with their places, those equal to a neighbour
    are repeated, and the places that they cover are counted; texts without a
    repeated window skip the sort."""
    h, w, lines = F.col("_h"), F.col("_w"), F.col("_lines")
    df = docs.withColumn("_t", F.coalesce("text", F.lit("")))
    df = (df.withColumn("_w", F.array_remove(F.split("_t", _SPACE), ""))
            .withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
            .withColumn("n_symbols", (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]+", ""))).cast("long")))
    df = df.withColumns({"_h": F.transform(w, lambda x: F.xxhash64(x)),
                         "n_words": F.size(w).cast("long"),
                         "word_chars": F.length(F.array_join(w, "")).cast("long"),
                         "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")})
    df = df.drop("_t", "_w", "_lines").withColumn("_b", F.zip_with(h, F.slice(h, 2, F.size(h)), lambda x, y: F.xxhash64(x, y)))
    third = F.zip_with("_b", F.slice(h, 3, F.size(h)), lambda x, y: F.xxhash64(x, y))
    df = df.withColumn("_win", F.when(F.size(h) >= 3, F.slice(third, 1, F.size(h) - 2)))
    pair = F.transform("_win", lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    df = df.withColumn("_pairs", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.sort_array(pair)))
    p = F.col("_pairs")
    near = lambda x, i: F.coalesce(x["x"] == F.get(p, i)["x"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(p, lambda x, i: near(x, i - 1) | near(x, i + 1)), lambda x: x["i"]))
    cover = F.aggregate(places, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
                        lambda a: a["n"])
    df = df.withColumn("n_repeat_words", F.when(_GUARD(), F.coalesce(cover, F.lit(0)).cast("long")))
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def _place(doc_id: Column) -> tuple[Column, Column]:
    """(part, bit) of an id in the bitmap."""
    at = F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(PARTS * PART_BITS))
    return F.floor(at / PART_BITS).cast("int"), F.pmod(at, F.lit(PART_BITS)).cast("int")


def of_trusted(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id and text of the rows of `docs` whose doc_id is in `trusted`."""
    ids = trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    part, bit = _place(F.col("doc_id"))
    bits = materialize(ids.groupBy(part.alias("_part")).agg(F.bitmap_construct_agg(bit.cast("long")).alias("_bits")), "trusted-bits")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = (docs.select("doc_id", "text").withColumn("_part", part)
                 .join(F.broadcast(bits), "_part")  # at most PARTS rows of 4 KB
                 .filter(F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1))
    # a sort-merge join at every size: the labels grow with the corpus.  Inner, as `ids` are distinct: the
    # optimizer moves a left semi join below the bitmap's, where every text would be shuffled
    return maybe.select("doc_id", "text").join(ids.hint("merge"), "doc_id")


def _by_bucket(docs: DataFrame, buckets: int, name: str) -> DataFrame:
    # explode_outer: explode adds a filter on its array, which the optimizer would push below the
    # projections and evaluate with every array expression written out
    grams = _hashes(docs.select("text")).select(F.explode_outer(F.concat("_h", "_b")).alias("x"))
    return grams.groupBy(F.pmod("x", F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias(name)).filter("bucket IS NOT NULL")


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents and of the trusted ones."""
    target = _by_bucket(of_trusted(docs, trusted), buckets, "target")
    return _by_bucket(docs, buckets, "raw").join(target, "bucket", "left").withColumn("target", F.coalesce("target", F.lit(0)))


def weights(counts: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA) -> list[int]:
    """round(1e6 * (log p_target - log p_raw)) of each bucket, at most `buckets` numbers."""
    got = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}
    n_raw, n_target = (sum(x[k] for x in got.values()) for k in (0, 1))
    if not n_target:
        return [0] * buckets
    out = []
    for b in range(buckets):
        raw, target = got.get(b, (0, 0))
        p = (target + alpha * n_target / buckets) / (n_target * (1 + alpha))
        q = (raw + alpha * n_raw / buckets) / (n_raw * (1 + alpha))
        out.append(round(MICRO * (math.log(p) - math.log(q))))
    return out


def judge(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA,
          min_score: float = MIN_SCORE) -> DataFrame:
    """`docs` with the base columns, `score` (micro-nats per n-gram) and `kept`."""
    clash = [c for c in docs.columns if c in VERDICT + ["score"] + _TMP]
    docs = docs.drop(*clash)
    w = weights(materialize(bucket_counts(docs, trusted, buckets), "bucket-counts"), buckets, alpha)
    table = F.split(F.lit(",".join(map(str, w))), ",").cast("array<bigint>")
    add = lambda a, x: a + F.get(table, F.pmod(x, F.lit(buckets)).cast("int"))
    total = F.aggregate("_b", F.aggregate("_h", F.lit(0).cast("long"), add), add)
    df = _with_base(docs)
    df = df.withColumn("score", F.when(_GUARD() & (F.size("_h") > 0), F.round(total / (2 * F.size("_h"))).cast("long")))
    return (df.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(round(MICRO * min_score))))
              .drop(*_TMP))


def keep(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    columns = docs.columns
    safe = docs.toDF(*[c if c in ("doc_id", "text") else f"_in_{c}" for c in columns])
    return judge(safe, trusted, **options).filter("kept").select(*safe.columns).toDF(*columns)
