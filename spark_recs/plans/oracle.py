"""DuckDB SQL for each registered query: an independent statement of the
same result over the same parquet tables (pre-registered as views)."""

from __future__ import annotations

from spark_recs.operators.prepare import PERCENTILES, percentile_columns
from spark_recs.sources.fixtures import SQL_VIEWS

K = 100
SAMPLE_SEED = 45
BETAS = [0, 10, 100, 1000]
RANDOM_SEED = 2023

PRELUDE = SQL_VIEWS + f""",
canon AS (
  SELECT i.user_id, i.recording_msid, CAST(i."timestamp" AS DATE) AS "timestamp",
         coalesce(t.recording_mbid, i.recording_msid) AS recording_mbid
  FROM interactions_v i JOIN tracks t ON t.recording_msid = i.recording_msid),
canon_log AS (
  SELECT i.user_id, i.recording_msid, CAST(i."timestamp" AS DATE) AS "timestamp",
         coalesce(t.recording_mbid, i.recording_msid) AS recording_mbid
  FROM all_interactions i JOIN tracks t ON t.recording_msid = i.recording_msid),
test_canon AS (
  SELECT i.user_id, i.recording_msid, CAST(i."timestamp" AS DATE) AS "timestamp",
         coalesce(t.recording_mbid, i.recording_msid) AS recording_mbid
  FROM interactions_test_v i JOIN tracks t ON t.recording_msid = i.recording_msid),
seq AS (
  SELECT user_id, recording_msid, "timestamp", recording_mbid,
         count(*) OVER (PARTITION BY user_id) AS "count",
         row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", recording_msid, recording_mbid) AS row_number
  FROM canon WHERE user_id IS NOT NULL),
train AS (SELECT * FROM seq WHERE row_number * 100 <= "count" * 80),
val AS (SELECT * FROM seq WHERE row_number * 100 > "count" * 80),
rseq AS (
  SELECT user_id, recording_msid, "timestamp", recording_mbid,
         count(*) OVER (PARTITION BY user_id) AS "count",
         row_number() OVER (PARTITION BY user_id ORDER BY
             md5(concat_ws('|', '{RANDOM_SEED}', user_id, recording_msid, "timestamp")),
             recording_msid, "timestamp", recording_mbid) AS row_number
  FROM canon WHERE user_id IS NOT NULL),
rtrain AS (SELECT * FROM rseq WHERE row_number * 100 <= "count" * 80),
item_map AS (
  SELECT row_number() OVER (ORDER BY recording_mbid) AS track_id, recording_mbid
  FROM (SELECT DISTINCT recording_mbid FROM seq WHERE recording_mbid IS NOT NULL)),
enc AS (SELECT s.*, m.track_id FROM seq s LEFT JOIN item_map m ON m.recording_mbid = s.recording_mbid),
item_stats AS (
  SELECT recording_mbid, count(recording_mbid) AS n_interactions, count(DISTINCT user_id) AS n_users
  FROM train GROUP BY recording_mbid),
pop_interactions AS (
  SELECT recording_mbid, CAST(n_interactions AS DOUBLE) AS score,
         row_number() OVER (ORDER BY n_interactions DESC, recording_mbid) AS "rank" FROM item_stats
  QUALIFY "rank" <= {K}),
pop_users AS (
  SELECT recording_mbid, CAST(n_users AS DOUBLE) AS score,
         row_number() OVER (ORDER BY n_users DESC, recording_mbid) AS "rank" FROM item_stats
  QUALIFY "rank" <= {K}),
pop_damped AS (
  SELECT recording_mbid, n_interactions / (n_users + 1000.0) AS score,
         row_number() OVER (ORDER BY n_interactions / (n_users + 1000.0) DESC, recording_mbid) AS "rank"
  FROM item_stats QUALIFY "rank" <= {K})
"""


def _seq_cols(src: str) -> str:
    return (f'SELECT CAST(user_id AS BIGINT) AS user_id, recording_msid, CAST("timestamp" AS VARCHAR) AS "timestamp", '
            f'recording_mbid, CAST("count" AS BIGINT) AS "count", CAST(row_number AS BIGINT) AS row_number FROM {src}')


def _hash_unit(seed: int, cols: list[str], buckets: int) -> str:
    key = "concat_ws('|', '" + str(seed) + "', " + ", ".join(cols) + ")"
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) % {buckets})"


def _idcg(n: str) -> str:
    return (f"CASE WHEN {n} <= 0 THEN 0.0 ELSE "
            f"list_sum(list_transform(range(1, {n} + 1), lambda j: 1.0 / ln(j + 1))) END")


def _per_user(hits: str, population: str, k: int = K) -> str:
    """hits(user_id, rank); population(user_id, n_labels) -> per-user metrics."""
    return f"""
  SELECT p.user_id, CAST(p.n_labels AS BIGINT) AS n_labels, CAST(coalesce(h.n_hits, 0) AS BIGINT) AS n_hits,
         CASE WHEN p.n_labels > 0 THEN coalesce(h.n_hits, 0) / {float(k)} ELSE 0.0 END AS precision,
         CASE WHEN p.n_labels > 0 THEN coalesce(h.ap, 0) / least(p.n_labels, {k}) ELSE 0.0 END AS ap,
         CASE WHEN p.n_labels > 0 THEN coalesce(h.dcg, 0) / ({_idcg(f'least(p.n_labels, {k})')}) ELSE 0.0 END AS ndcg
  FROM {population} p LEFT JOIN (
    SELECT user_id, count(*) AS n_hits, sum(c / "rank") AS ap, sum(1.0 / ln("rank" + 1)) AS dcg
    FROM (SELECT user_id, "rank", row_number() OVER (PARTITION BY user_id ORDER BY "rank") AS c FROM {hits})
    GROUP BY user_id) h ON h.user_id = p.user_id"""


def _shared_eval(pop: str, labels: str, population: str) -> str:
    """CTE text for a shared ranked list ``pop`` against ``labels``."""
    rec_users = "(SELECT DISTINCT user_id FROM train)"
    counts = f"(SELECT user_id, count(DISTINCT recording_mbid) AS n_labels FROM {labels} WHERE recording_mbid IS NOT NULL GROUP BY user_id)"
    if population == "labelled":
        popn = counts
        hits_filter = ""
    elif population == "both":
        popn = f"(SELECT * FROM {counts} WHERE user_id IN {rec_users})"
        hits_filter = f"WHERE l.user_id IN {rec_users}"
    else:
        popn = f"(SELECT r.user_id, coalesce(c.n_labels, 0) AS n_labels FROM {rec_users} r LEFT JOIN {counts} c ON c.user_id = r.user_id)"
        hits_filter = f"WHERE l.user_id IN {rec_users}"
    hits = (f"(SELECT l.user_id, p.\"rank\" FROM (SELECT DISTINCT user_id, recording_mbid FROM {labels}) l "
            f"JOIN {pop} p ON p.recording_mbid = l.recording_mbid {hits_filter})")
    return _per_user(hits, popn)


def _metric_row(per_user_sql: str) -> str:
    return (f"SELECT round(avg(precision), 6) AS precision, round(avg(ap), 6) AS map, "
            f"round(avg(ndcg), 6) AS ndcg, count(*) AS n_users FROM ({per_user_sql})")


def _q(body: str) -> str:
    return "WITH " + PRELUDE + "\n" + body


def oracle_sql() -> dict[str, str]:
    pct = ", ".join(f"CAST(quantile_disc(interaction_count, {p / 100.0}) AS BIGINT) AS {name}"
                    for p, name in zip(PERCENTILES, percentile_columns()))
    user_counts = ("SELECT u.user_id, count(i.recording_msid) AS interaction_count "
                   "FROM users_v u JOIN all_interactions i ON i.user_id = u.user_id GROUP BY u.user_id")
    item_counts = ("SELECT coalesce(t.recording_mbid, i.recording_msid) AS recording_mbid, "
                   "count(t.track_name) AS interaction_count FROM all_interactions i "
                   "JOIN tracks t ON t.recording_msid = i.recording_msid GROUP BY 1")
    sub_users = f"(SELECT * FROM train WHERE {_hash_unit(SAMPLE_SEED, ['user_id'], 100)} < 50)"
    q = {
        "scan_interactions": _q('SELECT CAST(user_id AS BIGINT) AS user_id, recording_msid, '
                                'strftime("timestamp", \'%Y-%m-%d %H:%M:%S\') AS "timestamp" FROM all_interactions'),
        "canonical_items": _q('SELECT CAST(user_id AS BIGINT) AS user_id, recording_msid, '
                              'CAST("timestamp" AS VARCHAR) AS "timestamp", recording_mbid FROM canon'),
        "interactions_by_day": _q('SELECT CAST("timestamp" AS VARCHAR) AS "timestamp", count(*) AS n_listens, '
                                  'count(DISTINCT user_id) AS n_users FROM canon_log GROUP BY "timestamp"'),
        "user_interaction_counts": _q(user_counts),
        "item_interaction_counts": _q(item_counts),
        "user_percentiles": _q(f"SELECT {pct} FROM ({user_counts})"),
        "item_percentiles": _q(f"SELECT {pct} FROM ({item_counts})"),
        "user_sequence": _q(_seq_cols("seq")),
        "split_temporal_train": _q(_seq_cols("train")),
        "split_temporal_val": _q(_seq_cols("val")),
        "split_random_train": _q(_seq_cols("rtrain")),
        "split_random_val": _q(_seq_cols('rseq WHERE row_number * 100 > "count" * 80')),
        "split_random_val_anti": _q(_seq_cols("rseq s WHERE NOT EXISTS (SELECT 1 FROM rtrain t "
                                              "WHERE t.user_id = s.user_id AND t.row_number = s.row_number)")),
        "sample_rows": _q(_seq_cols(f"train WHERE {_hash_unit(SAMPLE_SEED, ['user_id', 'recording_msid', '\"timestamp\"'], 100)} < 20")),
        "sample_users": _q(_seq_cols(f"train WHERE {_hash_unit(SAMPLE_SEED, ['user_id'], 100)} < 50")),
        "parquet_roundtrip": _q(_seq_cols("train")),
        "popularity_interactions": _q('SELECT recording_mbid, score, CAST("rank" AS BIGINT) AS "rank" FROM pop_interactions'),
        "popularity_distinct_users": _q('SELECT recording_mbid, score, CAST("rank" AS BIGINT) AS "rank" FROM pop_users'),
        "popularity_damped": _q('SELECT recording_mbid, score, CAST("rank" AS BIGINT) AS "rank" FROM pop_damped'),
        "popularity_beta_sweep": _q(
            "SELECT beta, recording_mbid, score, CAST(\"rank\" AS BIGINT) AS \"rank\" FROM ("
            "SELECT b.beta, s.recording_mbid, s.n_interactions / (s.n_users + b.beta) AS score, "
            "row_number() OVER (PARTITION BY b.beta ORDER BY s.n_interactions / (s.n_users + b.beta) DESC, "
            "s.recording_mbid) AS \"rank\" FROM item_stats s, "
            f"(SELECT unnest([{', '.join(f'CAST({float(b)} AS DOUBLE)' for b in BETAS)}]) AS beta) b) WHERE \"rank\" <= {K}"),
        "popularity_list": _q("SELECT count(*) AS n_items, string_agg(recording_mbid, ',' ORDER BY \"rank\") AS items "
                              "FROM pop_interactions"),
        "item_id_map": _q("SELECT CAST(track_id AS BIGINT) AS track_id, recording_mbid FROM item_map"),
        "item_id_map_sql": _q("SELECT CAST(track_id AS BIGINT) AS track_id, recording_mbid FROM item_map"),
        "user_id_map": _q("SELECT CAST(row_number() OVER (ORDER BY user_id) - 1 AS BIGINT) AS user_idx, user_id "
                          "FROM (SELECT DISTINCT user_id FROM train)"),
        "encode_train": _q('SELECT CAST(user_id AS BIGINT) AS user_id, CAST(track_id AS BIGINT) AS track_id '
                           'FROM enc WHERE row_number * 100 <= "count" * 80'),
        "als_train_counts": _q('SELECT CAST(track_id AS BIGINT) AS track_id, user_id, count(*) AS interactions_count '
                               'FROM enc WHERE row_number * 100 <= "count" * 80 GROUP BY track_id, user_id'),
        "als_val_counts": _q('SELECT CAST(track_id AS BIGINT) AS track_id, user_id, count(*) AS interactions_count '
                             'FROM enc WHERE row_number * 100 > "count" * 80 GROUP BY track_id, user_id'),
        "encode_test_counts": _q("SELECT CAST(m.track_id AS BIGINT) AS track_id, t.user_id, count(*) AS interactions_count "
                                 "FROM test_canon t JOIN item_map m ON m.recording_mbid = t.recording_mbid "
                                 "GROUP BY m.track_id, t.user_id"),
        "val_known_only": _q("SELECT CAST(user_id AS BIGINT) AS user_id, recording_mbid FROM val "
                             "WHERE user_id IN (SELECT user_id FROM train) "
                             "AND recording_mbid IN (SELECT recording_mbid FROM train)"),
        "val_counts_by_item": _q('SELECT user_id, recording_mbid, count("timestamp") AS interactions_count '
                                 "FROM val GROUP BY user_id, recording_mbid"),
        "label_sets": _q("SELECT p.user_id, p.recording_mbid, c.n_labels FROM "
                         "(SELECT DISTINCT user_id, recording_mbid FROM test_canon WHERE recording_mbid IS NOT NULL) p "
                         "JOIN (SELECT user_id, count(DISTINCT recording_mbid) AS n_labels FROM test_canon "
                         "WHERE recording_mbid IS NOT NULL GROUP BY user_id) c ON c.user_id = p.user_id"),
        "matrix_shape_approx": _q("SELECT count(DISTINCT user_id) AS num_users, count(DISTINCT recording_mbid) AS num_items, "
                                  "true AS within_error FROM train"),
        "matrix_shape": _q("SELECT count(DISTINCT user_id) AS num_users, count(DISTINCT recording_mbid) AS num_items FROM train"),
        "interactions_coo": _q(
            "SELECT CAST(u.user_idx AS BIGINT) AS user_idx, CAST(i.item_idx AS BIGINT) AS item_idx, p.weight FROM "
            "(SELECT user_id, recording_mbid, count(*) AS weight FROM train GROUP BY 1, 2) p "
            "JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx FROM (SELECT DISTINCT user_id FROM train)) u "
            "ON u.user_id = p.user_id "
            "JOIN (SELECT recording_mbid, row_number() OVER (ORDER BY recording_mbid) - 1 AS item_idx "
            "FROM (SELECT DISTINCT recording_mbid FROM train)) i ON i.recording_mbid = p.recording_mbid"),
        "interactions_coo_weighted": _q(
            "SELECT CAST(u.user_idx AS BIGINT) AS user_idx, CAST(i.item_idx AS BIGINT) AS item_idx, "
            "CAST(sum(c.interactions_count) AS BIGINT) AS weight FROM "
            f"(SELECT user_id, recording_mbid, count(*) AS interactions_count FROM {sub_users} GROUP BY 1, 2) c "
            "JOIN (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx "
            f"FROM (SELECT DISTINCT user_id FROM {sub_users})) u ON u.user_id = c.user_id "
            "JOIN (SELECT recording_mbid, row_number() OVER (ORDER BY recording_mbid) - 1 AS item_idx "
            f"FROM (SELECT DISTINCT recording_mbid FROM {sub_users})) i ON i.recording_mbid = c.recording_mbid "
            "GROUP BY u.user_idx, i.item_idx"),
        "eval_popularity": _q(_metric_row(_shared_eval("pop_interactions", "test_canon", "labelled"))),
        "metrics_per_user": _q(
            "SELECT CAST(user_id AS BIGINT) AS user_id, n_labels, n_hits, round(precision, 6) AS precision, "
            f"round(ap, 6) AS ap, round(ndcg, 6) AS ndcg FROM ({_shared_eval('pop_damped', 'val', 'both')})"),
        "metrics_at_k": _q(_metric_row(_shared_eval("pop_damped", "val", "both"))),
        "experiment_results_csv": _q(" UNION ALL ".join(
            f"SELECT CAST({float(b)} AS DOUBLE) AS beta, * FROM ("
            + _metric_row(_shared_eval(
                f"(SELECT recording_mbid, row_number() OVER (ORDER BY n_interactions / (n_users + {float(b)}) DESC, "
                f"recording_mbid) AS \"rank\" FROM item_stats QUALIFY \"rank\" <= {K})", "val", "both")) + ")"
            for b in BETAS)),
        "eval_topk_left": _q(_metric_row(_shared_eval("pop_users", "val", "recommended"))),
        "sequence_quantile_cells": _q(_seq_cols("seq")),
        "sequence_bucketed": _q(_seq_cols("seq")),
        "user_counts_bucketed": _q("SELECT user_id, count(*) AS n_listens FROM canon GROUP BY user_id"),
        "daily_sink": _q("SELECT CAST(user_id AS BIGINT) AS user_id, item_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM event_interactions"),
        "daily_profile": _q("SELECT count(DISTINCT day) AS n_days, count(*) AS n_values, true AS within_error "
                            "FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM event_interactions WHERE user_id IS NOT NULL)"),
        "popularity_distinct_users_bitmap": _q('SELECT recording_mbid, score, CAST("rank" AS BIGINT) AS "rank" FROM pop_users'),
        "item_id_map_grown": _q(
            "SELECT track_id, recording_mbid, 0::BIGINT AS batch FROM item_map UNION ALL "
            "SELECT (SELECT count(*) FROM item_map) + row_number() OVER (ORDER BY recording_mbid), recording_mbid, 1::BIGINT "
            "FROM (SELECT DISTINCT recording_mbid FROM test_canon WHERE recording_mbid IS NOT NULL "
            "AND recording_mbid NOT IN (SELECT recording_mbid FROM item_map))"),
        "events_counts": _q("SELECT user_id, item_id, count(*) AS interactions_count FROM event_interactions "
                            "GROUP BY user_id, item_id"),
        "events_sequence": _q(
            "SELECT CAST(user_id AS BIGINT) AS user_id, item_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, "
            "CAST(\"count\" AS BIGINT) AS \"count\", CAST(row_number AS BIGINT) AS row_number FROM ("
            "SELECT *, count(*) OVER (PARTITION BY user_id) AS \"count\", "
            "row_number() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS row_number "
            "FROM event_interactions WHERE user_id IS NOT NULL) WHERE row_number * 100 <= \"count\" * 80"),
    }
    q.update(_vector_sql())
    q.update(_als_sql())
    return q


# ----------------------------------------------------------- vector queries
TOPK_VECTORS, EVAL_K_VECTORS = 100, 100
ANN_TABLES, ANN_SEED, ANN_RECALL = 8, 20, 0.9


def _vec_prelude(dim: int) -> str:
    from spark_recs.operators.ann import BUCKET_ITEMS, MAX_BITS, SAMPLE_QUERIES, SLACK, hyperplanes
    from spark_recs.sources.fixtures import ITEM_BIAS_MOD, USER_BIAS_MOD
    planes = hyperplanes(dim, ANN_TABLES, MAX_BITS, ANN_SEED)
    constants = ", ".join(f"({t}, {j}, [{', '.join(repr(float(x)) for x in planes[t, j])}]::DOUBLE[])"
                          for t in range(ANN_TABLES) for j in range(MAX_BITS))
    tried = ", ".join(f"({1 << e})" for e in range(ANN_TABLES.bit_length()) if 1 << e <= ANN_TABLES)

    def topk(src: str, k: int) -> str:
        return (f'SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id '
                f'ORDER BY score DESC, item_id) AS "rank" FROM {src} QUALIFY "rank" <= {k}')

    m2 = "(SELECT max(list_inner_product(features, features)) FROM factors)"
    return f""",
vec_scores AS MATERIALIZED (
  SELECT q.id AS user_id, i.id AS item_id, list_inner_product(q.features, i.features) AS score,
         CAST(q.id % {USER_BIAS_MOD} AS DOUBLE) / 100.0 AS ub, CAST(i.id % {ITEM_BIAS_MOD} AS DOUBLE) / 100.0 AS ib
  FROM factors q JOIN factors i ON q.id <> i.id),
exact_k AS MATERIALIZED ({topk("vec_scores", TOPK_VECTORS)}),
exact_e AS ({topk("vec_scores", EVAL_K_VECTORS)}),
biased_k AS ({topk("(SELECT user_id, item_id, score + ub + ib AS score FROM vec_scores)", TOPK_VECTORS)}),
ann_bits AS MATERIALIZED (
  SELECT least({MAX_BITS}, greatest(0, CAST(ceil(log2(count(*) / {BUCKET_ITEMS}.0)) AS BIGINT))) AS b FROM factors),
planes AS MATERIALIZED (
  SELECT t, j, v FROM (VALUES {constants}) p(t, j, v) WHERE j < (SELECT b FROM ann_bits)),
slots AS (SELECT id, unnest(range({ANN_TABLES})) AS t FROM factors),
qproj AS MATERIALIZED (
  SELECT id, t, j, list_inner_product(x, v) AS p FROM (SELECT id, list_append(features, 0.0) AS x FROM factors), planes),
iproj AS MATERIALIZED (
  SELECT id, t, j, list_inner_product(x, v) AS p
  FROM (SELECT id, list_append(features, sqrt(greatest({m2} - list_inner_product(features, features), 0.0))) AS x FROM factors), planes),
qcodes AS MATERIALIZED (
  SELECT id, t, CAST(coalesce(sum(CASE WHEN p > 0 THEN 1::BIGINT << j ELSE 0 END), 0) AS BIGINT) AS code
  FROM slots LEFT JOIN qproj USING (id, t) GROUP BY id, t),
icodes AS MATERIALIZED (
  SELECT id AS item_id, t AS "table", CAST(coalesce(sum(CASE WHEN p > 0 THEN 1::BIGINT << j ELSE 0 END), 0) AS BIGINT) AS code
  FROM slots LEFT JOIN iproj USING (id, t) GROUP BY id, t),
masks AS (SELECT unnest(range(1::BIGINT << (SELECT b FROM ann_bits))) AS mask),
-- a query's buckets by what it costs to reach them: the squared margins of the bits that differ
qorder AS MATERIALIZED (
  SELECT id AS user_id, t, xor(code, mask) AS code, row_number() OVER (PARTITION BY id, t ORDER BY cost, mask) AS r
  FROM (SELECT s.id, s.t, m.mask, coalesce(sum(CASE WHEN (m.mask >> q.j) & 1 = 1 THEN q.p * q.p END), 0) AS cost
        FROM slots s CROSS JOIN masks m LEFT JOIN qproj q ON q.id = s.id AND q.t = s.t GROUP BY s.id, s.t, m.mask)
  JOIN qcodes USING (id, t)),
ann_sample AS MATERIALIZED (
  SELECT id FROM factors ORDER BY md5(concat_ws('|', '{ANN_SEED}', id)), id LIMIT {SAMPLE_QUERIES}),
pair_ranks AS MATERIALIZED (
  SELECT e.user_id, e.item_id, q.t, q.r FROM exact_k e JOIN ann_sample s ON s.id = e.user_id
  JOIN icodes i ON i.item_id = e.item_id JOIN qorder q ON q.user_id = e.user_id AND q.t = i."table" AND q.code = i.code),
ann_effort AS MATERIALIZED (
  SELECT tables, min(r) AS probes FROM (
    SELECT tables, r, sum(count(*)) OVER (PARTITION BY tables ORDER BY r) AS met, sum(count(*)) OVER (PARTITION BY tables) AS n
    FROM (SELECT tables, user_id, item_id, min(r) AS r FROM pair_ranks, (VALUES {tried}) x(tables) WHERE t < tables GROUP BY ALL)
    GROUP BY tables, r)
  WHERE met >= {ANN_RECALL + SLACK!r}::DOUBLE * n GROUP BY tables ORDER BY tables * min(r), tables LIMIT 1),
qprobes AS MATERIALIZED (
  SELECT user_id, t AS "table", code FROM qorder, ann_effort WHERE t < tables AND r <= probes),
ann_pairs AS (
  SELECT DISTINCT q.user_id, i.item_id FROM qprobes q JOIN icodes i ON q."table" = i."table" AND q.code = i.code
  WHERE q.user_id <> i.item_id),
ann_found AS MATERIALIZED ({topk("(SELECT * FROM ann_pairs JOIN vec_scores USING (user_id, item_id))", TOPK_VECTORS)}),
ann_full AS (SELECT user_id FROM ann_found WHERE "rank" = {TOPK_VECTORS}),
ann_k AS (
  SELECT user_id, item_id, score, "rank" FROM ann_found WHERE user_id IN (SELECT user_id FROM ann_full)
  UNION ALL SELECT user_id, item_id, score, "rank" FROM exact_k WHERE user_id NOT IN (SELECT user_id FROM ann_full)),
ann_e AS MATERIALIZED (SELECT * FROM ann_k)
"""


def _vector_sql(dim: int = 64) -> dict[str, str]:
    pre = PRELUDE + _vec_prelude(dim)

    def q(body: str) -> str:
        return "WITH " + pre + "\n" + body

    recs = lambda src: (f'SELECT CAST(user_id AS BIGINT) AS user_id, CAST("rank" AS BIGINT) AS "rank", '  # noqa: E731
                        f"CAST(item_id AS BIGINT) AS item_id, round(score, 6) AS score FROM {src}")
    inner_hits = "(SELECT a.user_id, a.\"rank\" FROM ann_e a JOIN exact_e e ON e.user_id = a.user_id AND e.item_id = a.item_id)"
    inner_pop = ("(SELECT user_id, count(DISTINCT item_id) AS n_labels FROM exact_e "
                 "WHERE user_id IN (SELECT user_id FROM ann_e) GROUP BY user_id)")
    return {
        "exact_topk": q(recs("exact_k")),
        "biased_topk": q(recs("biased_k")),
        "exact_topk_norm_bound": q(recs("exact_k")),
        "ann_index_topk": q(f"SELECT CAST(id AS BIGINT) AS user_id, least({TOPK_VECTORS}, count(*) OVER () - 1) AS n_recs, "
                            f"least({TOPK_VECTORS}, count(*) OVER () - 1) AS n_items, true AS scores_match FROM factors"),
        "ann_index_recall": q("SELECT count(*) AS n_queries, true AS recall_reached FROM factors"),
        "recs_long": q('SELECT CAST(user_id AS BIGINT) AS user_id, CAST("rank" AS BIGINT) AS "rank", '
                       "CAST(item_id AS BIGINT) AS item_id FROM exact_k"),
        "ann_candidates": q(
            'SELECT CAST(q.user_id AS BIGINT) AS user_id, count(i.ni) AS n_buckets, CAST(coalesce(sum(i.ni), 0) AS BIGINT) AS n_candidates '
            'FROM qprobes q LEFT JOIN (SELECT "table", code, count(*) AS ni FROM icodes GROUP BY 1, 2) i '
            'ON i."table" = q."table" AND i.code = q.code GROUP BY q.user_id'),
        "ann_topk": q(recs("ann_k")),
        "ann_recall": q("SELECT round(count(a.user_id) / count(*), 6) AS recall, count(DISTINCT e.user_id) AS n_queries "
                        "FROM exact_e e LEFT JOIN ann_e a ON a.user_id = e.user_id AND a.item_id = e.item_id"),
        "eval_topk_inner": q(_metric_row(_per_user(inner_hits, inner_pop, EVAL_K_VECTORS))),
        "eval_stored_recs": q(_metric_row(_per_user(inner_hits.replace("ann_e", "biased_k"), inner_pop.replace("ann_e", "biased_k"),
                                                    EVAL_K_VECTORS))),
    }


# ------------------------------------------------------- ALS (shape checks)
ALS_RANK, ALS_K, ALS_SUBSET_K = 25, 100, 20


def _als_sql() -> dict[str, str]:
    tr = 'enc WHERE row_number * 100 <= "count" * 80'
    n_items = f"(SELECT count(DISTINCT track_id) FROM {tr})"
    users = f"(SELECT DISTINCT user_id FROM {tr})"

    def factors(src: str) -> str:
        return _q(f"SELECT 'user' AS side, CAST(user_id AS BIGINT) AS id, {ALS_RANK}::BIGINT AS n_features "
                  f"FROM (SELECT DISTINCT user_id FROM {src}) UNION ALL "
                  f"SELECT 'item', CAST(track_id AS BIGINT), {ALS_RANK}::BIGINT FROM (SELECT DISTINCT track_id FROM {src})")

    def scored(k: int, src: str) -> str:
        return _q(f"SELECT DISTINCT CAST(user_id AS BIGINT) AS user_id, CAST(least({k}, {n_items}) AS BIGINT) AS n_recs, "
                  f"true AS scores_fall, true AS scores_match FROM {src}")

    lists = _q(f"SELECT CAST(user_id AS BIGINT) AS user_id, CAST(least({ALS_K}, {n_items}) AS BIGINT) AS n_recs, "
               f"CAST(least({ALS_K}, {n_items}) AS BIGINT) AS n_items, CAST(0 AS BIGINT) AS n_unknown FROM {users}")
    tested = "SELECT count(DISTINCT t.user_id) AS n_users, true AS metrics_in_range FROM test_canon t"
    grid = ", ".join(f"({r}::BIGINT, {a}::DOUBLE, {g}::DOUBLE, 'alpha_{a}_rank_{r}_reg_{g}_als')"
                     for r in (10, 25) for a in (0.5, 1.0) for g in (0.05, 0.1))
    return {
        "als_factors": factors(tr),
        "als_model_roundtrip": factors(tr),
        "als_weighted_fit": factors(f"{tr} AND {_hash_unit(SAMPLE_SEED, ['user_id'], 100)} < 50"),
        "als_recommend_all": scored(ALS_K, tr),
        "als_recommend_subset": scored(ALS_SUBSET_K, f"val WHERE user_id IN {users}"),
        "als_recommend_unseen": _q(f"SELECT CAST(user_id AS BIGINT) AS user_id, "
                                   f"CAST(least({ALS_K}, {n_items} - count(DISTINCT track_id)) AS BIGINT) AS n_recs, "
                                   f"CAST(0 AS BIGINT) AS n_seen_in_recs FROM {tr} GROUP BY user_id"),
        "als_recommend_ids": lists,
        "als_ann_topk": lists,
        "als_ann_recall": _q(f"SELECT count(*) AS n_queries, true AS recall_reached FROM {users}"),
        "als_norm_bound": _q(f"SELECT (SELECT count(*) FROM {users}) * {n_items} AS n_products, true AS none_repeated, true AS lists_equal"),
        "als_eval": _q(f"SELECT count(*) AS n_users, true AS metrics_in_range FROM {users}"),
        "als_eval_test": _q(f"{tested} JOIN item_map m ON m.recording_mbid = t.recording_mbid WHERE t.user_id IN {users}"),
        "als_stored_eval": _q(f"{tested} WHERE t.recording_mbid IS NOT NULL AND t.user_id IN {users}"),
        "als_sweep": _q(f"SELECT g.rank, g.alpha, g.reg, 10::BIGINT AS max_iter, (SELECT count(*) FROM {users}) AS n_users, (SELECT count(*) FROM {users}) AS users_scored, "
                        "v.val_rows, v.cold_rows, true AS timed, true AS metrics_in_range, replace(g.suffix, '.', '_') AS model_suffix "
                        f"FROM (VALUES {grid}) g(rank, alpha, reg, suffix), ("
                        f"SELECT count(*) AS val_rows, count(*) FILTER (track_id NOT IN (SELECT track_id FROM {tr})) AS cold_rows "
                        'FROM (SELECT DISTINCT track_id, user_id FROM enc WHERE row_number * 100 > "count" * 80)) v'),
    }
