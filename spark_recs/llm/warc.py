"""A content-addressed WARC archive.

An archive is two tables in a shared folder:

- `payloads`: (sha256, payload), each distinct payload once;
- `records`: one row per record with its exact header bytes and the digest of
  its payload.

A record's bytes are header + block + CRLF CRLF, where the block is the payload
for a response and empty for a revisit; `reconstruct` restores them by a join,
`read_records` reads fields, length and digest from the restored bytes, and
`export_warc` writes them as ordinary .warc files.  Reading recomputes both
digests of every stored payload and fails on a difference.

Of records with equal payloads of at least `MIN_REVISIT` bytes the one with the
largest page_id is the response and the others revisit it.  Digests are grouped
with partial aggregates and light rows only; a payload travels once, keyed by
its own page.

Defined results: null html is an empty payload, a null url an empty target; a
null page_id is kept, is never the one revisited unless all of its payload's
are null, and equal page_ids are separate records (those equal to the largest
are all responses); empty tables give empty archives; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_recs.llm.store import open_fs
from spark_recs.session import scratch_path

MIN_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def record_id(page: Column, url: Column, sha256: Column) -> Column:
    """A URI that is the same whenever the archive is written again."""
    h = F.md5(F.concat_ws("\n", F.coalesce(page.cast("string"), F.lit("")), url, sha256))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def _header() -> Column:
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit(CRLF))
    revisit = F.col("type") == "revisit"
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", F.col("type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
                                 line("WARC-Payload-Length", F.col("payload_bytes").cast("string")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit(CRLF))


def write_archive(pages: DataFrame, root: str | None = None, min_revisit: int = MIN_REVISIT) -> str:
    """Archives `pages` (page_id, url, html); returns the archive's folder."""
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    src = pages.select(F.col("page_id").cast("long").alias("page_id"),
                       F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ").alias("url"), payload.alias("payload"))
    light = src.select("page_id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"),
                       F.octet_length("payload").cast("long").alias("payload_bytes"))
    light.write.parquet(f"{root}/pages")
    light = spark.read.schema(light.schema).parquet(f"{root}/pages")
    light.groupBy("sha256").agg(F.max("page_id").alias("ref")).write.parquet(f"{root}/refs")
    refs = spark.read.parquet(f"{root}/refs")

    revisit = (F.col("payload_bytes") >= min_revisit) & F.col("ref").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("ref"))
    records = (light.join(refs, "sha256")
                    .withColumn("type", F.when(revisit, "revisit").otherwise("response"))
                    .withColumn("refers_to", F.when(revisit, F.col("ref")))
                    .withColumn("record_id", record_id(F.col("page_id"), F.col("url"), F.col("sha256"))))
    (records.select("page_id", "sha256", F.encode(_header(), "UTF-8").alias("header"))
            .write.parquet(f"{root}/records"))

    # a payload is stored by the page that its digest refers to, without a page_id by any of its rows;
    # equal rows are dropped by the join's own keys, so no payload is shuffled twice
    own = src.withColumn("sha256", F.sha2("payload", 256)).select("page_id", "sha256", "payload")
    named = own.join(refs.filter("ref IS NOT NULL").select(F.col("ref").alias("page_id"), "sha256"),
                     ["page_id", "sha256"], "left_semi")
    nameless = own.filter("page_id IS NULL").join(refs.filter("ref IS NULL"), "sha256", "left_semi")
    (named.dropDuplicates(["page_id", "sha256"]).unionByName(nameless.dropDuplicates(["sha256"]))
          .select("sha256", "payload").write.parquet(f"{root}/payloads"))
    return root


def _checked(store: DataFrame) -> DataFrame:
    """Adds the recomputed SHA-1 and size; fails where SHA-256 differs from the key."""
    good = F.sha2("payload", 256) == F.col("sha256")
    sha1 = F.when(good, F.sha1("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("sha256"))))
    return store.withColumn("sha1", sha1).withColumn("size", F.octet_length("payload").cast("long"))


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """One row per record from the stored header bytes and the stored payload:
    page_id, url, record_type, refers_to, payload_bytes, payload_digest.  Fails
    if a header's digest isn't that of its payload."""
    head = F.decode("header", "UTF-8")
    # url and numbers hold no line break, so a field ends at the first \r
    field = lambda name: F.regexp_extract(head, rf"\r\n{name}: ([^\r\n]*)", 1)
    records = spark.read.parquet(f"{root}/records").select(
        "sha256", F.expr("try_cast(nullif(regexp_extract(decode(header, 'UTF-8'), '\\\\r\\\\nWARC-Page-ID: ([^\\\\r\\\\n]*)', 1), '') as bigint)").alias("page_id"),
        field("WARC-Target-URI").alias("url"), field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To-Page").alias("refers"), field("WARC-Payload-Digest").alias("digest"))
    store = _checked(spark.read.parquet(f"{root}/payloads")).select("sha256", "sha1", F.col("size").alias("payload_bytes"))
    same = F.col("digest") == F.concat(F.lit("sha1:"), F.col("sha1"))
    return records.join(store, "sha256").select(
        "page_id", "url", "payload_bytes",
        F.when(same, F.col("sha1")).otherwise(F.raise_error(F.lit("a header's digest differs"))).alias("payload_digest"),
        "record_type", F.when(F.col("refers") != "", F.col("refers").cast("long")).alias("refers_to"))


def reconstruct(spark: SparkSession, root: str) -> DataFrame:
    """(page_id, record): each record's exact bytes.  Revisits bring no payload,
    so they skip the join; many small responses may share one payload."""
    records = spark.read.parquet(f"{root}/records")
    store = _checked(spark.read.parquet(f"{root}/payloads")).filter("sha1 IS NOT NULL").select("sha256", "payload")
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    revisit = F.decode("header", "UTF-8").startswith("WARC/1.1\r\nWARC-Type: revisit\r\n")
    full = records.filter(~revisit).join(store, "sha256").select("page_id", F.concat("header", "payload", end).alias("record"))
    return full.unionByName(records.filter(revisit).select("page_id", F.concat("header", end).alias("record")))


_FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _parse(batches):
    for b in batches:
        rows = []
        for r in b.column(0):
            for head, block in parse_warc(r.as_buffer().to_pybytes()):
                page, again = head["WARC-Page-ID"], head["WARC-Type"] == "revisit"
                rows.append((int(page) if page else None, head["WARC-Target-URI"], int(head["WARC-Payload-Length"]) if again else len(block),
                             head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], int(head["WARC-Refers-To-Page"]) if again else None))
        cols = list(zip(*rows)) or [()] * 6
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [f.split()[0] for f in _FIELDS.split(", ")])


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """One row per record, from its restored bytes: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to.  A response's length and digest are
    those of its block, a revisit's those that its header states."""
    return reconstruct(spark, root).select("record").mapInArrow(_parse, _FIELDS)


def _export(folder: str):
    def run(batches):
        name, out, n = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc", None, 0
        for b in batches:
            for r in b.column(0):
                if out is None:
                    fs, path = open_fs(name)
                    fs.create_dir(path.rpartition("/")[0])
                    out = fs.open_output_stream(path)
                out.write(r.as_py())
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "n_records": [n]})
    return run


def export_warc(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """Writes the records as .warc files; one row per file when it is evaluated."""
    return reconstruct(spark, root).select("record").mapInArrow(_export(folder), "path string, n_records long")


def parse_warc(data: bytes):
    """(headers, block) of each record of a .warc file; checks response digests."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at) + 4
        lines = data[at:end - 4].decode().split("\r\n")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(head["Content-Length"])
        block = data[end: end + size]
        if data[end + size: end + size + 4] != b"\r\n\r\n":
            raise ValueError("a record doesn't end where its length says")
        if head["WARC-Type"] == "response" and head["WARC-Payload-Digest"] != "sha1:" + hashlib.sha1(block).hexdigest():
            raise ValueError("a record's payload is damaged")
        yield head, block
        at = end + size + 4
