"""Token ids in length-delimited binary record files with an offset index.

A shard is a run of records: length (u64), masked CRC-32C of the length (u32),
payload, masked CRC-32C of the payload (u32), all little-endian.  The payload
is one flag byte (0: the document has no id), the id (i64) and the token ids
(16 bits each for a vocabulary of up to 65,536, else 32).  Beside it lies an
index of (offset, framed length) pairs (u64), by which records are read in any
order without scanning.

Documents are range-partitioned by doc_id, so shards in partition order hold
ascending ids.  A task writes its shard under a name of its own and reports it
in the manifest; a repeated task leaves an unlisted file, never a listed
half-written one.

Defined results: null text is an empty sequence (the end id only); a null
doc_id is kept and comes first; equal doc_ids stay separate records, ordered by
text; an empty table gives an empty manifest; further columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spark_recs.llm.crc32c import Crc32c, masked
from spark_recs.llm.store import materialize, open_fs
from spark_recs.llm.text import process_state
from spark_recs.llm.tokens import encoder, text_slices
from spark_recs.session import scratch_path

VOCABULARY, END_ID = "word_bpe_49k.json", 2
SLICE_BYTES = 1 << 20
MANIFEST = "part int, path string, index_path string, n_records long, n_tokens long, wide boolean"
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _crc() -> Crc32c:
    return process_state("crc32c", Crc32c)


def frame(payloads: list[bytes]) -> tuple[bytes, np.ndarray]:
    """(framed records, framed lengths)."""
    crc = _crc()
    n = np.array([len(p) for p in payloads], dtype="<u8")
    of_length = masked(crc.many(n.view(np.uint8), np.full(len(n), 8)))
    of_data = masked(crc.many(np.frombuffer(b"".join(payloads), dtype=np.uint8), n))
    head = np.zeros(len(n), dtype=[("n", "<u8"), ("crc", "<u4")])
    head["n"], head["crc"] = n, of_length
    out = []
    for h, p, c in zip(head, payloads, of_data.astype("<u4")):
        out += [h.tobytes(), p, c.tobytes()]
    return b"".join(out), n.astype(np.int64) + 16


def unframe(data: bytes, lengths: np.ndarray) -> list[bytes]:
    """Payloads of framed records, both checksums verified."""
    crc, at = _crc(), np.cumsum(lengths) - lengths
    raw = np.frombuffer(data, dtype=np.uint8)
    heads = raw[at[:, None] + np.arange(12)]
    n = np.ascontiguousarray(heads[:, :8]).view("<u8").ravel().astype(np.int64)
    if (n != lengths - 16).any():
        raise ValueError("a record's length differs from the index")
    payloads = [data[a + 12: a + 12 + k] for a, k in zip(at, n)]
    tails = np.ascontiguousarray(raw[(at + 12 + n)[:, None] + np.arange(4)]).view("<u4").ravel()
    want = np.ascontiguousarray(heads[:, 8:]).view("<u4").ravel()
    if (masked(crc.many(np.ascontiguousarray(heads[:, :8]).ravel(), np.full(len(n), 8))) != want).any():
        raise ValueError("a record's length is damaged")
    if (masked(crc.many(np.frombuffer(b"".join(payloads), dtype=np.uint8), n)) != tails).any():
        raise ValueError("a record's payload is damaged")
    return payloads


def _writer(folder: str, vocabulary: str, end_id: int, wide: bool, special: bool):
    kind = "I" if wide else "H"

    def run(batches):
        enc, out, index, total, base = encoder(vocabulary, kind, special), None, [], 0, 0
        end = np.array([end_id], dtype=kind).tobytes()
        name = f"{folder}/shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        for b in batches:
            ids = b.column(0)
            for i, j, texts in text_slices(b.column(1), SLICE_BYTES):
                keys = ids.slice(i, j - i)
                known = np.array(keys.is_valid()).astype(np.uint8)
                key = np.array(keys.fill_null(0), dtype="<i8")
                payloads = [k.tobytes() + d.tobytes() + t + end for k, d, t in zip(known, key, enc.batch(texts))]
                data, lengths = frame(payloads)
                if out is None:
                    fs, path = open_fs(f"{name}.rec")
                    fs.create_dir(path.rpartition("/")[0])
                    out = fs.open_output_stream(path)
                out.write(data)
                index.append(np.stack([base + np.cumsum(lengths) - lengths, lengths], axis=1))
                total += int((lengths - 16 - 9).sum()) // (4 if wide else 2)
                base += len(data)
        if out is None:
            return
        out.close()
        rows = np.concatenate(index).astype("<u8")
        fs, path = open_fs(f"{name}.idx")
        with fs.open_output_stream(path) as f:
            f.write(rows.tobytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [f"{name}.rec"], "index_path": [f"{name}.idx"], "n_records": [len(rows)], "n_tokens": [total], "wide": [wide]})
    return run


def write_records(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, wide: bool = False, special: bool = False) -> DataFrame:
    """Writes `docs` (doc_id, text) in ascending doc_id order and returns the
    manifest, one row per shard.  `wide`: 32 bits an id.  `special`: as for ChunkEncoder."""
    folder = folder or scratch_path(docs.sparkSession, "records")
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                  .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return materialize(ranged.mapInArrow(_writer(folder, vocabulary, end_id, wide, special), MANIFEST), "manifest")


def _slices(index: np.ndarray):
    """Runs of adjacent index rows of about SLICE_BYTES each."""
    i, ends = 0, np.cumsum(index[:, 1])
    while i < len(index):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] - index[i, 1] + SLICE_BYTES, side="right")))
        yield index[i:j]
        i = j


def read_index(path: str) -> np.ndarray:
    fs, p = open_fs(path)
    with fs.open_input_file(p) as f:
        return np.frombuffer(f.read(), dtype="<u8").reshape(-1, 2).astype(np.int64)


def parse(payload: bytes, wide: bool) -> tuple[int | None, np.ndarray]:
    key = int.from_bytes(payload[1:9], "little", signed=True) if payload[0] else None
    return key, np.frombuffer(payload, dtype="<u4" if wide else "<u2", offset=9)


def read_at(path: str, index: np.ndarray, wide: bool) -> list[tuple[int | None, np.ndarray]]:
    """The records at these rows of the index, in their order."""
    fs, p = open_fs(path)
    with fs.open_input_file(p) as f:
        data = b"".join(f.read_at(int(n), int(o)) for o, n in index)
    return [parse(x, wide) for x in unframe(data, index[:, 1])]


def _digests(batches):
    for b in batches:
        for row in b.to_pylist():
            fs, p = open_fs(row["path"])
            start = row["start"]
            with fs.open_input_file(p) as f:
                for part in _slices(read_index(row["index_path"])):
                    keys, starts, counts, crcs = [], [], [], []
                    for x in unframe(f.read_at(int(part[:, 1].sum()), int(part[0, 0])), part[:, 1]):
                        key, ids = parse(x, row["wide"])
                        keys.append(key)
                        starts.append(start)
                        counts.append(len(ids))
                        crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        start += len(ids)
                    yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in zip(("doc_id", "start", "n_tokens", "ids_crc32"), (keys, starts, counts, crcs))})


def read_digests(manifest: DataFrame) -> DataFrame:
    """Reads every record back: doc_id, its place in the id stream, its length
    and the CRC-32 of its ids as 32-bit integers.  The running sum runs over the
    manifest, one row per shard."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    return placed.repartition(max(1, manifest.count())).mapInArrow(_digests, DIGEST)


def _shuffled(seed: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                index = read_index(row["index_path"])
                order = np.random.default_rng((seed, row["part"])).permutation(len(index))
                for i in range(0, len(order), 1024):
                    got = read_at(row["path"], index[order[i: i + 1024]], row["wide"])
                    yield pa.RecordBatch.from_pydict({"doc_id": pa.array([k for k, _ in got], pa.int64()), "ids": pa.array([x.astype(np.int32) for _, x in got], pa.list_(pa.int32()))})
    return run


def read_shuffled(manifest: DataFrame, seed: int) -> DataFrame:
    """(doc_id, ids) of every record, shards in random order and records of a
    shard in random order, through the index."""
    mixed = manifest.repartition(max(1, manifest.count()), F.xxhash64("part", F.lit(seed)))
    return mixed.mapInArrow(_shuffled(seed), "doc_id long, ids array<int>")


def record_digests(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    return read_digests(write_records(docs, vocabulary, end_id, special=True))
