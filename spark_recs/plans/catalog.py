"""The registered queries: one callable per operator key, each taking
(spark, sf_dir) and returning a DataFrame over the whole test tables.

Output conventions shared with the SQL oracle: integers are bigint, dates
are ``yyyy-MM-dd`` text, non-trivial doubles are rounded to 6 places, and
arrays are exploded or joined into text so values compare exactly.
"""

from __future__ import annotations

from functools import cached_property
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_recs.functions.columns import dot
from spark_recs.operators import als, ann, ann_index, bitmaps, ids, matrix, metrics, popularity, prepare, profiles, scoring, split
from spark_recs.operators.sequence import sequence_within
from spark_recs.session import scratch_path
from spark_recs.sources import bucketed, daily
from spark_recs.sources import fixtures as fx
from spark_recs.sources import schemas

K = 100           # list length of the popularity baselines and metrics
SAMPLE_SEED = 45  # seed of the subsamples
CELL_ROWS = 4     # listens per part of a (user, day) in the quantile-cell key: the tables have few a day
BETAS = [0, 10, 100, 1000]


def _day(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd").alias(c)


def _r6(c: str) -> F.Column:
    return F.round(F.col(c), 6).alias(c)


def _big(c: str) -> F.Column:
    return F.col(c).cast("long").alias(c)


class Tables:
    """Intermediate tables of one query, built lazily from the fixtures.
    ``stored``: for queries that use the sequence more than once, it is written
    and read again instead of being built by each use."""

    def __init__(self, spark: SparkSession, sf_dir: str, stored: bool = False):
        self.spark, self.sf_dir, self.stored = spark, sf_dir, stored

    @cached_property
    def tracks(self) -> DataFrame:
        return fx.tracks(self.spark, self.sf_dir)

    @cached_property
    def interactions(self) -> DataFrame:
        return fx.interactions(self.spark, self.sf_dir)

    @cached_property
    def log(self) -> DataFrame:
        return fx.all_interactions(self.spark, self.sf_dir)

    @cached_property
    def canon_log(self) -> DataFrame:
        return prepare.canonical_log(self.log, self.tracks)

    @cached_property
    def canon(self) -> DataFrame:
        return prepare.canonical_log(self.interactions, self.tracks)

    @cached_property
    def test(self) -> DataFrame:
        return prepare.canonical_log(fx.interactions_test(self.spark, self.sf_dir), self.tracks)

    @cached_property
    def seq(self) -> DataFrame:
        return split.temporal_sequence(self.canon, materialize=self.stored)

    @cached_property
    def train(self) -> DataFrame:
        return split.train_split(self.seq)

    @cached_property
    def val(self) -> DataFrame:
        return split.val_split(self.seq)

    @cached_property
    def item_map(self) -> DataFrame:
        return ids.item_id_map(self.seq)

    @cached_property
    def encoded(self) -> DataFrame:
        return ids.encode(self.seq, self.item_map, "recording_mbid", "left")


def _seq_out(df: DataFrame) -> DataFrame:
    return df.select(_big("user_id"), "recording_msid", _day("timestamp"), "recording_mbid",
                     _big("count"), _big("row_number"))


# ------------------------------------------------------------ sources / prep
def scan_interactions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.log.select(
        _big("user_id"), "recording_msid",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


def canonical_items(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.canon.select(_big("user_id"), "recording_msid", _day("timestamp"), "recording_mbid")


def interactions_by_day(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return (t.canon_log.groupBy("timestamp")
              .agg(F.count(F.lit(1)).alias("n_listens"), F.countDistinct("user_id").alias("n_users"))
              .select(_day("timestamp"), "n_listens", "n_users"))


def user_interaction_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return prepare.user_interaction_counts(fx.users(spark, sf_dir), t.log)


def item_interaction_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return prepare.item_interaction_counts(t.log, t.tracks)


def user_percentiles(spark, sf_dir):
    return prepare.percentile_profile(user_interaction_counts(spark, sf_dir))


def item_percentiles(spark, sf_dir):
    return prepare.percentile_profile(item_interaction_counts(spark, sf_dir))


# ------------------------------------------------------------------ splits
def user_sequence(spark, sf_dir):
    return _seq_out(Tables(spark, sf_dir).seq)


def split_temporal_train(spark, sf_dir):
    return _seq_out(Tables(spark, sf_dir).train)


def split_temporal_val(spark, sf_dir):
    return _seq_out(Tables(spark, sf_dir).val)


def split_random_train(spark, sf_dir):
    return _seq_out(split.train_split(split.random_sequence(Tables(spark, sf_dir).canon)))


def split_random_val(spark, sf_dir):
    return _seq_out(split.val_split(split.random_sequence(Tables(spark, sf_dir).canon)))


def split_random_val_anti(spark, sf_dir):
    seq = split.random_sequence(Tables(spark, sf_dir).canon)
    return _seq_out(split.val_by_anti_join(seq, split.train_split(seq)))


def sample_rows(spark, sf_dir):
    return _seq_out(split.sample(Tables(spark, sf_dir).train, 20, SAMPLE_SEED, by="row"))


def sample_users(spark, sf_dir):
    return _seq_out(split.sample(Tables(spark, sf_dir).train, 50, SAMPLE_SEED, by="user"))


def parquet_roundtrip(spark, sf_dir):
    """Write the sequenced log partitioned by split, read back the train
    partition (partition pruning replaces the two-column filter)."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "sequenced")
    schemas.write_parquet(split.with_split_column(t.seq), path, partition_by=["split"])
    stored = T.StructType(schemas.SEQUENCED.fields + [T.StructField("split", T.StringType())])
    back = spark.read.schema(stored).parquet(path)
    return _seq_out(back.filter(F.col("split") == "train"))


def sequence_quantile_cells(spark, sf_dir):
    """The temporal sequence with every (user, day) of over ``CELL_ROWS``
    listens cut into parts by sampled quantiles."""
    return _seq_out(split.temporal_sequence_by_quantiles(Tables(spark, sf_dir).canon, CELL_ROWS))


def _bucketed(spark, sf_dir):
    return bucketed.read_bucketed_log(spark, bucketed.write_bucketed_log(Tables(spark, sf_dir).canon))


def sequence_bucketed(spark, sf_dir):
    """The temporal sequence read from the bucketed log: no listen is shuffled."""
    return _seq_out(split.temporal_sequence(_bucketed(spark, sf_dir)))


def user_counts_bucketed(spark, sf_dir):
    """Listens per user, counted in the buckets."""
    return bucketed.user_counts(_bucketed(spark, sf_dir))


def daily_sink(spark, sf_dir):
    """The event log written by day, its odd days written a second time, and
    read back with each day's row count checked."""
    path = scratch_path(spark, "daily_log")
    log = fx.event_interactions(spark, sf_dir)
    daily.write_days(log, path, "ts")
    daily.write_days(log.filter(F.dayofmonth("ts") % 2 == 1), path, "ts")
    back = daily.read_days(spark, path, log.schema)
    return back.select(_big("user_id"), "item_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


def daily_profile(spark, sf_dir):
    """Percentiles of events per user and day, merged from stored day sketches,
    the second half of the month added after the first: what was merged, and
    whether every percentile is within the sketch's rank error."""
    log = fx.event_interactions(spark, sf_dir).filter(F.col("user_id").isNotNull())
    path = scratch_path(spark, "day_sketches")
    for half in (F.dayofmonth("ts") <= 15, F.dayofmonth("ts") > 15):
        profiles.add_days(log.filter(half), path, "ts")
    merged = profiles.merged_profile(profiles.stored_sketches(spark, path))
    worst = max(profiles.rank_errors(merged, profiles.user_day_counts(log, "ts")).values(), default=0.0)
    return merged.select("n_days", "n_values", F.lit(worst <= profiles.RANK_ERROR).alias("within_error"))


# -------------------------------------------------------------- popularity
def popularity_distinct_users_bitmap(spark, sf_dir):
    """Popularity by distinct listeners from stored bitmaps per item and day,
    kept by year, as the tables have few listens a day."""
    train = Tables(spark, sf_dir, stored=True).train
    path = scratch_path(spark, "day_bitmaps")
    schema = bitmaps.add_days(ids.encode(train, ids.user_id_map(train), "user_id", "inner"), path, unit="year",
                               tasks_per_day=spark.sparkContext.defaultParallelism)
    return popularity.from_stats(bitmaps.distinct_users(bitmaps.stored_bitmaps(spark, path, schema)), "distinct_users", K)


def popularity_interactions(spark, sf_dir):
    return popularity.popularity(Tables(spark, sf_dir).train, "interactions", K)


def popularity_distinct_users(spark, sf_dir):
    return popularity.popularity(Tables(spark, sf_dir).train, "distinct_users", K)


def popularity_damped(spark, sf_dir):
    return popularity.popularity(Tables(spark, sf_dir).train, "damped", K, beta=1000)


def popularity_beta_sweep(spark, sf_dir):
    return popularity.beta_sweep(Tables(spark, sf_dir).train, BETAS, K)


def popularity_list(spark, sf_dir):
    lst = popularity.as_list(popularity.popularity(Tables(spark, sf_dir).train, "interactions", K))
    return lst.select("n_items", F.array_join("items", ",").alias("items"))


# ------------------------------------------------------------------- ids
def item_id_map(spark, sf_dir):
    return Tables(spark, sf_dir).item_map


def item_id_map_sql(spark, sf_dir):
    return ids.item_id_map_sql(Tables(spark, sf_dir).seq)


def item_id_map_grown(spark, sf_dir):
    """The item map of the training log grown by the test log's new items."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "grown_map")
    ids.grow_id_map(t.canon.filter(F.col("user_id").isNotNull()), path, 0)
    return ids.grow_id_map(t.test, path, 1).select("track_id", "recording_mbid", _big("batch"))


def user_id_map(spark, sf_dir):
    return ids.user_id_map(Tables(spark, sf_dir).train)


def encode_train(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    return split.train_split(t.encoded).select(_big("user_id"), _big("track_id"))


def als_train_counts(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    return matrix.count_matrix(split.train_split(t.encoded))


def als_val_counts(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    return matrix.count_matrix(split.val_split(t.encoded))


def encode_test_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return matrix.count_matrix(ids.encode(t.test, t.item_map, "recording_mbid", "inner"))


def val_known_only(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    v = t.val.select("user_id", "recording_mbid")
    return ids.known_only(v, t.train, "user_id", "recording_mbid").select(_big("user_id"), "recording_mbid")


def val_counts_by_item(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return matrix.count_matrix(t.val, ("user_id", "recording_mbid"), "interactions_count", counted="timestamp")


def label_sets(spark, sf_dir):
    return matrix.label_rows(Tables(spark, sf_dir).test, "user_id", "recording_mbid")


def matrix_shape(spark, sf_dir):
    return matrix.matrix_shape(Tables(spark, sf_dir).train)


def matrix_shape_approx(spark, sf_dir):
    """Matrix shape from HyperLogLog++ sketches (``approx_count_distinct``,
    1 % standard error): whether both counts lie within five errors (or one) of
    the exact shape."""
    train = Tables(spark, sf_dir, stored=True).train
    approx = matrix.matrix_shape(train, approx=True, rsd=0.01).withColumnsRenamed({"num_users": "_u", "num_items": "_i"})
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(0.05 * F.col(b), F.lit(1.0))
    both = matrix.matrix_shape(train).unionByName(approx, allowMissingColumns=True)  # one row each
    both = both.agg(*[F.max(c).alias(c) for c in ("num_users", "num_items", "_u", "_i")])
    return both.select("num_users", "num_items", (near("_u", "num_users") & near("_i", "num_items")).alias("within_error"))


def interactions_coo(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    umap = ids.user_id_map(t.train, start=0)
    imap = ids.item_id_map(t.train, out="item_idx").withColumn("item_idx", F.col("item_idx") - 1)
    return matrix.coo(t.train, umap, imap)


def interactions_coo_weighted(spark, sf_dir):
    """Weighted COO of a subsample: the 50 % user sample's count table
    (user, interactions_count, item) summed into (user_idx, item_idx, weight)."""
    t = Tables(spark, sf_dir, stored=True)
    sub = split.sample(t.train, 50, SAMPLE_SEED, by="user")
    counts = matrix.count_matrix(sub, ("user_id", "recording_mbid"), "interactions_count")
    umap = ids.user_id_map(sub, start=0)
    imap = ids.item_id_map(sub, out="item_idx").withColumn("item_idx", F.col("item_idx") - 1)
    return matrix.coo(counts, umap, imap, weight="interactions_count")


# ---------------------------------------------------------------- metrics
def _metric_row(per_user: DataFrame) -> DataFrame:
    s = metrics.summarize(per_user)
    return s.select(_r6("precision"), _r6("map"), _r6("ndcg"), "n_users")


def eval_popularity(spark, sf_dir):
    """Baseline evaluation: train popularity top-100 for every test user."""
    t = Tables(spark, sf_dir)
    ranked = popularity.popularity(t.train, "interactions", K)
    return _metric_row(metrics.per_user_metrics_shared(ranked, t.test, K, users="labelled"))


def metrics_per_user(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    ranked = popularity.popularity(t.train, "damped", K, beta=1000)
    pu = metrics.per_user_metrics_shared(ranked, t.val, K, rec_users=t.train, users="both")
    return pu.select(_big("user_id"), "n_labels", "n_hits", _r6("precision"), _r6("ap"), _r6("ndcg"))


def metrics_at_k(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    ranked = popularity.popularity(t.train, "damped", K, beta=1000)
    return _metric_row(metrics.per_user_metrics_shared(ranked, t.val, K, rec_users=t.train, users="both"))


def eval_topk_left(spark, sf_dir):
    """Every user with recommendations counts, labelled or not."""
    t = Tables(spark, sf_dir, stored=True)
    ranked = popularity.popularity(t.train, "distinct_users", K)
    return _metric_row(metrics.per_user_metrics_shared(ranked, t.val, K, rec_users=t.train,
                                                       users="recommended"))


# --------------------------------------------------------- second source
def events_counts(spark, sf_dir):
    ev = fx.event_interactions(spark, sf_dir)
    return matrix.count_matrix(ev, ("user_id", "item_id"), "interactions_count")


def events_sequence(spark, sf_dir):
    """Temporal 80 % train cut of the event log: ``ts`` is unique, so the
    per-user order is strict."""
    ev = fx.event_interactions(spark, sf_dir).filter(F.col("user_id").isNotNull())
    seq = sequence_within(ev, ["user_id"], ["ts", "item_id"], F.to_date("ts"))
    return split.train_split(seq).select(
        _big("user_id"), _big("item_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), _big("count"), _big("row_number"))


# ------------------------------------------------- factor scoring and ANN
TOPK_VECTORS = 100           # neighbours per vector (the source's list length)
ANN_TABLES, ANN_SEED = 8, 20  # most tables; the effort is fitted to the recall target
ANN_RECALL = 0.9
EVAL_K_VECTORS = 100         # neighbours in the evaluation keys


def _vectors(spark, sf_dir):
    return fx.factor_table(spark, sf_dir)


def _exact(spark, sf_dir, k=TOPK_VECTORS):
    v = _vectors(spark, sf_dir)
    return scoring.blocked_topk(v, v, k, exclude_self=True)


def _ann(spark, sf_dir, k=TOPK_VECTORS):
    v = _vectors(spark, sf_dir)
    return ann.ann_topk(v, v, k, ANN_TABLES, ANN_SEED, exclude_self=True, recall=ANN_RECALL)


def _recs_out(df: DataFrame) -> DataFrame:
    return df.select(_big("user_id"), _big("rank"), _big("item_id"), _r6("score"))


def exact_topk(spark, sf_dir):
    """Exact maximum-inner-product top-100 of every vector among the others."""
    return _recs_out(_exact(spark, sf_dir))


def exact_topk_norm_bound(spark, sf_dir):
    """The exact lists, without the products that the norms exclude."""
    v = _vectors(spark, sf_dir)
    return _recs_out(scoring.NormBound(v, v, TOPK_VECTORS, exclude_self=True).top_k())


def _biased(spark, sf_dir, k=TOPK_VECTORS):
    """Both sides under their dense indexes, scored, and given their own ids
    back through the two maps; a vector is not recommended to itself."""
    v = _vectors(spark, sf_dir)
    users = v.select(F.col("id").alias("user_id"), "features", fx.user_bias().alias("bias"))
    items = v.select(F.col("id").alias("item_id"), "features", fx.item_bias().alias("bias"))
    umap, imap = ids.user_id_map(users), ids.user_id_map(items, "item_id", "item_idx")
    own = umap.join(imap, umap.user_id == imap.item_id).select(F.col("user_idx").alias("user_id"), F.col("item_idx").alias("item_id"))
    recs = scoring.blocked_topk(ids.encode(users, umap, "user_id", "inner").withColumnRenamed("user_idx", "id"),
                                ids.encode(items, imap, "item_id", "inner").withColumnRenamed("item_idx", "id"),
                                k, user_bias=F.col("bias"), item_bias=F.col("bias"), exclude=own)
    recs = recs.withColumnsRenamed({"user_id": "user_idx", "item_id": "item_idx"})
    return ids.decode(ids.decode(recs, umap, "user_idx"), imap, "item_idx")


def biased_topk(spark, sf_dir):
    """Biased factor scoring u·i + b_u + b_i, best 100 per user."""
    return _recs_out(_biased(spark, sf_dir))


def recs_long(spark, sf_dir):
    """Match matrix (one array per user) flattened back to ranked rows."""
    arrays = scoring.recs_as_arrays(_exact(spark, sf_dir))
    return scoring.flatten_recs(arrays).select(_big("user_id"), _big("rank"), _big("item_id"))


def ann_candidates(spark, sf_dir):
    """How many items each query meets in the buckets that it probes."""
    v = _vectors(spark, sf_dir)
    return ann.candidate_counts(v, v, ANN_TABLES, ANN_SEED, recall=ANN_RECALL, k=TOPK_VECTORS)


def ann_topk(spark, sf_dir):
    return _recs_out(_ann(spark, sf_dir))


def ann_recall(spark, sf_dir):
    r = ann.recall_at_k(_ann(spark, sf_dir, EVAL_K_VECTORS), _exact(spark, sf_dir, EVAL_K_VECTORS))
    return r.select(_r6("recall"), _big("n_queries"))


def _indexed(spark, sf_dir):
    """Lists from an index that was built, stored and loaded again."""
    v = _vectors(spark, sf_dir)
    path = ann_index.build(v, scratch_path(spark, "ann_index"), k=TOPK_VECTORS)
    return ann_index.search(spark, ann_index.load(spark, path), v, TOPK_VECTORS, recall=ANN_RECALL, exclude_self=True)


def ann_index_topk(spark, sf_dir):
    """Top-100 from the stored index: per vector, how many items its list has,
    whether they differ, and whether each score is the product of the two."""
    v = _vectors(spark, sf_dir)
    u = v.select(F.col("id").alias("user_id"), F.col("features").alias("uf"))
    i = v.select(F.col("id").alias("item_id"), F.col("features").alias("vf"))
    rows = _indexed(spark, sf_dir).join(u, "user_id").join(i, "item_id")
    return rows.groupBy(_big("user_id")).agg(
        F.count(F.lit(1)).alias("n_recs"), F.countDistinct("item_id").alias("n_items"),
        F.bool_and(F.abs(F.col("score") - dot(F.col("uf"), F.col("vf"))) < 1e-6).alias("scores_match"))


def ann_index_recall(spark, sf_dir):
    """Whether the stored index reaches its recall target over all vectors."""
    r = ann.recall_at_k(_indexed(spark, sf_dir), _exact(spark, sf_dir))
    return r.select(_big("n_queries"), (F.col("recall") >= ANN_RECALL).alias("recall_reached"))


def eval_topk_inner(spark, sf_dir):
    """Per-user rec table (approximate top-100) scored against the exact
    top-100 as labels; users with both count."""
    recs = _ann(spark, sf_dir, EVAL_K_VECTORS)
    labels = _exact(spark, sf_dir, EVAL_K_VECTORS).select("user_id", "item_id")
    pu = metrics.per_user_metrics(recs, labels, EVAL_K_VECTORS, users="both")
    return _metric_row(pu)


# -------------------------------------------------------------------- ALS
ALS_K = 100
ALS_SUBSET_K = 20
ALS_BOUND_BLOCK = 1024
SWEEP_CONCURRENT = 4
SWEEP = ((10, 25), (0.5, 1.0), (0.05, 0.1))  # rank, alpha, reg
_MODELS: dict = {}


def _als_data(spark, sf_dir):
    t = Tables(spark, sf_dir, stored=True)
    tr = matrix.count_matrix(split.train_split(t.encoded))
    va = matrix.count_matrix(split.val_split(t.encoded))
    return tr, va


def _als_model(spark, sf_dir, params=None):
    """Fitted model for (session, tables, params); fitted once per session
    and kept in the model store, as the source trains once and reloads."""
    params = params or als.ALSParams()
    key = (spark.sparkContext.applicationId, sf_dir, params)
    if key not in _MODELS:
        t = Tables(spark, sf_dir, stored=True)
        tr = matrix.count_matrix(split.train_split(t.encoded)).persist()
        als.check_int_ids(tr)
        model = als.fit(tr, params)
        path = als.save_in_store(model, params, item_map=t.item_map)
        tr.unpersist()
        _MODELS[key] = path
    return als.load_from_store(_MODELS[key])[0]


def _factor_shape(model):
    u, i = model.userFactors, model.itemFactors
    return (u.select(F.lit("user").alias("side"), _big("id"), F.size("features").cast("long").alias("n_features"))
             .unionByName(i.select(F.lit("item").alias("side"), _big("id"),
                                   F.size("features").cast("long").alias("n_features"))))


def als_factors(spark, sf_dir):
    """Factor export: user and item factor tables written as Parquet and
    read back; one row per user / item with its vector length."""
    model = _als_model(spark, sf_dir)
    up, ip = scratch_path(spark, "user_factors"), scratch_path(spark, "item_factors")
    als.export_factors(model, up, ip)
    u = schemas.read_parquet(spark, up, schemas.FACTORS)
    i = schemas.read_parquet(spark, ip, schemas.FACTORS)
    return (u.select(F.lit("user").alias("side"), _big("id"), F.size("features").cast("long").alias("n_features"))
             .unionByName(i.select(F.lit("item").alias("side"), _big("id"),
                                   F.size("features").cast("long").alias("n_features"))))


def als_model_roundtrip(spark, sf_dir):
    """Save a fitted model, load it back, read its factors."""
    model = _als_model(spark, sf_dir)
    path = als.save(model, scratch_path(spark, "models/roundtrip"))
    return _factor_shape(als.load(path))


def _score_facts(model, recs):
    """Per user: list length, whether scores fall with the rank, and whether
    each is the product of the two stored vectors (k rows per user)."""
    u = model.userFactors.select(F.col("id").cast("long").alias("user_id"), "features")
    of = lambda c: F.transform("recommendations", lambda r: r[c])
    lists = als.recommendations_struct(recs).select("user_id", of("track_id").alias("items"), of("rating").alias("scores"))
    n = F.size("scores") - 1
    falls = F.forall(F.zip_with(F.slice("scores", 1, n), F.slice("scores", 2, n), lambda a, b: a >= b), lambda x: x)
    rows = scoring.listed_products(lists.withColumn("flag", falls).join(u, "user_id"), model.itemFactors, 1e-6)
    return rows.groupBy("user_id").agg(F.sum("n").alias("n_recs"), F.bool_and("flag").alias("scores_fall"),
                                       (F.sum("n_off") == 0).alias("scores_match"))


def _list_facts(recs, train):
    """Per user: list length, distinct items, and items unknown to the training
    rows.  The known tracks are bits, a long per 64, so that the lists meet them
    where they are; grouped by user they are shuffled once, or not at all."""
    word, bit = F.shiftright(F.col("track_id").cast("long"), 6), F.pmod(F.col("track_id"), F.lit(64)).cast("int")
    known = train.select("track_id").distinct().groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_known"))
    # one row per 64 tracks
    rows = recs.join(F.broadcast(known), word == F.col("_word"), "left")
    return rows.select("user_id", "track_id", F.coalesce(F.getbit("_known", bit).cast("int"), F.lit(0)).alias("_seen")).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_recs"), F.countDistinct("track_id").alias("n_items"),
        (F.count(F.lit(1)) - F.sum("_seen")).alias("n_unknown"))


def _metric_facts(m):
    """Users of an evaluation and whether every metric lies in (0, 1]."""
    good = [(F.col(c) > 0) & (F.col(c) <= 1) for c in ("precision", "map", "ndcg")]
    return m.select(_big("n_users"), (good[0] & good[1] & good[2]).alias("metrics_in_range"))


def als_recommend_all(spark, sf_dir):
    model = _als_model(spark, sf_dir)
    return _score_facts(model, als.recommend_all(model, ALS_K))


def als_recommend_ids(spark, sf_dir):
    """Id-only lists, flattened to (user_id, rank, track_id): facts per user."""
    ids_ = als.recommend_ids(_als_model(spark, sf_dir), ALS_K)
    flat = scoring.flatten_recs(ids_, "reco").withColumnRenamed("item_id", "track_id")
    return _list_facts(flat, _als_data(spark, sf_dir)[0])


def als_recommend_subset(spark, sf_dir):
    """Lists of 20 for the users that have validation rows."""
    t = Tables(spark, sf_dir)
    model = _als_model(spark, sf_dir)
    return _score_facts(model, als.recommend_subset(model, t.val.select("user_id"), ALS_SUBSET_K))


def als_recommend_unseen(spark, sf_dir):
    """Top-100 per user among items not in the user's training rows;
    reports list length and how many listed items were seen (must be 0)."""
    tr, _ = _als_data(spark, sf_dir)
    recs = als.recommend_unseen(_als_model(spark, sf_dir), tr, ALS_K)
    seen = tr.select("user_id", "track_id").withColumn("_seen", F.lit(1))
    return (recs.join(seen, ["user_id", "track_id"], "left")
                .groupBy("user_id").agg(F.count(F.lit(1)).alias("n_recs"),
                                        F.count("_seen").alias("n_seen_in_recs")))


def _als_ann(spark, sf_dir, k=ALS_K):
    """Approximate top-k over the fitted factors: user vectors query the
    item vectors (maximum inner product through the norm augmentation)."""
    model = _als_model(spark, sf_dir)
    u, i = model.userFactors, model.itemFactors
    recs = ann.ann_topk(u, i, k, ANN_TABLES, ANN_SEED, exclude_self=False, recall=ANN_RECALL)
    return recs, u, i


def als_ann_topk(spark, sf_dir):
    """Approximate top-100 per user from the ALS factors: facts per user."""
    recs, _, _ = _als_ann(spark, sf_dir)
    return _list_facts(recs.select("user_id", F.col("item_id").alias("track_id")).repartition("user_id"), _als_data(spark, sf_dir)[0])


def als_ann_recall(spark, sf_dir):
    """Whether the approximate lists reach a recall@100 of 0.9 against the
    exact blocked top-100 over the same factors."""
    recs, u, i = _als_ann(spark, sf_dir)
    exact = scoring.blocked_topk(u, i, ALS_K)
    return ann.recall_at_k(recs, exact).select(_big("n_queries"), (F.col("recall") >= ANN_RECALL).alias("recall_reached"))


def als_norm_bound(spark, sf_dir):
    """The norm-bounded search over the fitted factors: all products there are,
    whether those computed are no more, and whether the lists are the exact ones."""
    model = _als_model(spark, sf_dir)
    u, i = model.userFactors, model.itemFactors
    search = scoring.NormBound(u, i, ALS_K, block=ALS_BOUND_BLOCK)
    flag = lambda df, c: df.select("user_id", "rank", "item_id", F.lit(1).alias(c))
    both = flag(search.top_k(), "a").join(flag(scoring.blocked_topk(u, i, ALS_K), "b"), ["user_id", "rank", "item_id"], "full")
    odd = both.filter("a IS NULL OR b IS NULL").limit(1).count()
    return search.products().select("n_products", F.col("n_scored").between(1, F.col("n_products")).alias("none_repeated"),
                                    F.lit(odd == 0).alias("lists_equal"))


def als_eval(spark, sf_dir):
    """ALS top-100 scored on the validation counts (every rec user counts)."""
    _, va = _als_data(spark, sf_dir)
    recs = als.recommend_all(_als_model(spark, sf_dir), ALS_K)
    return _metric_facts(als.evaluate(recs, va, ALS_K, users="recommended"))


def als_eval_test(spark, sf_dir):
    """The final score: ALS top-100 against the held-out test listens,
    encoded with the model's own item map (cold items drop out), for every
    user with both recommendations and test listens."""
    model, item_map = als.load_from_store(_MODELS_path(spark, sf_dir))
    t = Tables(spark, sf_dir)
    test = matrix.count_matrix(ids.encode(t.test, item_map, "recording_mbid", "inner"))
    recs = als.recommend_all(model, ALS_K)
    return _metric_facts(als.evaluate(recs, test, ALS_K, users="both"))


def als_stored_eval(spark, sf_dir):
    """Serving without the model: lists stored with the items' own ids (the
    model's map), read back and scored on the held-out test listens."""
    model, item_map = als.load_from_store(_MODELS_path(spark, sf_dir))
    path = scratch_path(spark, "als_recs")
    schemas.write_parquet(als.decode_recs(als.recommend_all(model, ALS_K), item_map)
                             .select("user_id", "rank", F.col("recording_mbid").alias("item_id")), path)
    labels = Tables(spark, sf_dir).test.filter("recording_mbid IS NOT NULL").select("user_id", F.col("recording_mbid").alias("item_id"))
    pu = metrics.per_user_metrics(spark.read.parquet(path), labels, ALS_K, users="both")
    return _metric_facts(metrics.summarize(pu))


def als_weighted_fit(spark, sf_dir):
    """A model of the 50 % user subsample's counts: one row per user / item
    of it with its vector length."""
    sub = split.sample(split.train_split(Tables(spark, sf_dir, stored=True).encoded), 50, SAMPLE_SEED, by="user")
    counts = matrix.count_matrix(sub).persist()  # the fit reads it twice
    model = als.fit(counts, als.ALSParams())
    counts.unpersist()
    return _factor_shape(model)


def _MODELS_path(spark, sf_dir, params=None):
    _als_model(spark, sf_dir, params)
    return _MODELS[(spark.sparkContext.applicationId, sf_dir, params or als.ALSParams())]


def als_sweep(spark, sf_dir):
    """Grid over rank, alpha and reg, ``SWEEP_CONCURRENT`` settings at a time: one
    CSV row per setting with model id, stage times, observed counts and metrics,
    read back; what the settings and the data fix is returned."""
    tr, va = (x.persist() for x in _als_data(spark, sf_dir))
    grid = [als.ALSParams(rank=r, alpha=a, reg=g) for r, a, g in product(*SWEEP)]
    rows = als.sweep(tr, va, grid, ALS_K, SWEEP_CONCURRENT)
    tr.unpersist(), va.unpersist()
    path = scratch_path(spark, "als_sweep_csv")
    schemas.write_csv(rows, path)
    back = schemas.read_csv(spark, path, rows.schema)
    timed = (F.col("train_time") > 0) & (F.col("recommendation_time") > 0) & (F.col("evaluation_time") > 0)
    m = [F.col(c).between(0, 1) for c in ("precision_at_k", "map_at_k", "ndcg_at_k")]
    return back.select(_big("rank"), "alpha", "reg", _big("max_iter"), "n_users", "users_scored", "val_rows", "cold_rows", timed.alias("timed"),
                       (m[0] & m[1] & m[2]).alias("metrics_in_range"),
                       F.regexp_extract("model_id", "alpha_.*", 0).alias("model_suffix"))


def experiment_results_csv(spark, sf_dir):
    """Popularity beta sweep evaluated on validation, written as CSV with a
    header and read back."""
    t = Tables(spark, sf_dir, stored=True)
    betas = [float(b) for b in BETAS]
    lists = popularity.beta_sweep(t.train, betas, K)
    rows = metrics.summarize(metrics.per_user_metrics_sweep(lists, t.val, K, "beta", betas, t.train), ("beta",))
    path = scratch_path(spark, "results_csv")
    schemas.write_csv(rows, path)
    schema = T.StructType([T.StructField("beta", T.DoubleType()), T.StructField("precision", T.DoubleType()),
                            T.StructField("map", T.DoubleType()), T.StructField("ndcg", T.DoubleType()),
                            T.StructField("n_users", T.LongType())])
    back = schemas.read_csv(spark, path, schema)
    return back.select("beta", _r6("precision"), _r6("map"), _r6("ndcg"), "n_users")


def eval_stored_recs(spark, sf_dir):
    """Score a stored rec table without the model: the biased scorer's top-100
    lists, with their own ids, written as Parquet, read back with an explicit
    schema, evaluated against the top-100 without biases."""
    path = scratch_path(spark, "stored_recs")
    schemas.write_parquet(_biased(spark, sf_dir, EVAL_K_VECTORS).select(_big("user_id"), "rank", _big("item_id")), path)
    recs = schemas.read_parquet(spark, path, schemas.RECS_LONG, strict_types=True)
    labels = _exact(spark, sf_dir, EVAL_K_VECTORS).select("user_id", "item_id")
    return _metric_row(metrics.per_user_metrics(recs, labels, EVAL_K_VECTORS, users="both"))


QUERIES = {name: fn for name, fn in list(globals().items())
           if callable(fn) and getattr(fn, "__module__", None) == __name__
           and not name.startswith("_") and name != "Tables"}
