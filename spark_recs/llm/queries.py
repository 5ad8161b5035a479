"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_recs.llm import (decontaminate, html, lexical, neardup, packing, pii, quality, records, topk, toxicity, unigram,
                            warc, whitening)
from spark_recs.llm.tokens import vocabulary_path

KEY = b"spark-recs-surrogates"  # the key of the registered runs; a deployment passes its own


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents labelled as of good quality."""
    return _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op1_html_extraction(spark, sf_dir):
    return html.extract(_table(spark, sf_dir, "pages"))


def op2_binary_records(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return records.record_digests(spark, docs, vocabulary_path(records.VOCABULARY), records.END_ID)


def op3_warc_archive(spark, sf_dir):
    root = warc.write_archive(_table(spark, sf_dir, "pages"))
    return warc.read_records(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_token_counts(spark, sf_dir):
    return unigram.token_counts(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.severity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontamination(spark, sf_dir):
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary_path(packing.VOCABULARY))


def op8_pii_surrogates(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return pii.pseudonymize(docs, KEY, count="n_entities").select("doc_id", "text", "n_entities")


def op9_quality_rules(spark, sf_dir):
    judged = quality.judge(_table(spark, sf_dir, "documents"), trusted(spark, sf_dir))
    return judged.select("doc_id", *quality.VERDICT, "score")


def op10_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark, sf_dir):
    return lexical.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_exact_topk(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_binary_records, op3_warc_archive, op4_token_counts, op5_toxicity, op6_decontamination,
    op7_best_fit_packing, op8_pii_surrogates, op9_quality_rules, op10_near_duplicates, op11_lexical_search,
    op12_exact_topk, op13_whitening)}

ORACLE = {
    "op3_warc_archive": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS d FROM pages),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS ref FROM p)
        SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, d AS payload_digest,
            CASE WHEN octet_length(b) >= 1000 AND page_id <> ref THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN octet_length(b) >= 1000 AND page_id <> ref THEN ref END AS refers_to
        FROM r""",
    "op10_near_duplicates": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
        r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
        c AS (SELECT x, min(y) AS component_id FROM r GROUP BY 1)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d JOIN c ON c.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        i AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
            FROM (SELECT DISTINCT item_id, text FROM benchmark)),
        times AS (SELECT item_id, t, count(*) AS times FROM i GROUP BY 1, 2),
        s AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
        m AS (SELECT r, doc_id, 25 + (75 * len(w) * n_docs) // n_terms AS m FROM d, s WHERE len(w) > 0),
        tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM times) GROUP BY 1, 2),
        wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, s GROUP BY t, n_docs),
        part AS (SELECT tf.r, tf.t, w * ((1000000000 * tf) // (1000 * tf + 8 * m)) AS v FROM tf JOIN wt USING (t) JOIN m USING (r)),
        scored AS (SELECT item_id, r, CAST(sum(times * v) AS BIGINT) AS score FROM part JOIN times USING (t) GROUP BY 1, 2)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored JOIN m USING (r) WHERE score > 0 QUALIFY rank <= 10""",
    "op12_exact_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY rank <= 20""",
}
