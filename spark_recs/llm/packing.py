"""Sum-of-squares packing of documents into sequences of a fixed length.

A document's pieces are its ids cut into full sequences, the first piece taking
the remainder.  Pieces are hashed into blocks of about `BLOCK_PIECES`; a block
is packed by one task.  There a piece goes where the sum over gaps g of
(open sequences with g places left) squared becomes smallest; of equal choices,
the tightest.  A new sequence is begun only where no open one has room.  Large
pieces come first.

What a block leaves in sequences with over `LOOSE` of their places free is
packed again, whole sequences as pieces, over far fewer blocks, so the loss at
block edges stays small.

Defined results: null text is empty (the end id only); equal doc_ids are
separate documents of the same name; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_recs.llm.store import materialize
from spark_recs.llm.tokens import encoder, text_slices

VOCABULARY, END_ID, LENGTH = "byte_bpe_50k.json", 0, 2048
BLOCK_PIECES = 8192
LOOSE = 0.02
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLICE_BYTES = 1 << 20


def _cut(vocabulary: str, end_id: int, length: int, special: bool):
    def run(batches):
        enc, end = encoder(vocabulary, special=special), np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            for i, j, texts in text_slices(b.column(1), SLICE_BYTES):
                rows = []
                for key, ids in zip(b.column(0).slice(i, j - i).to_pylist(), enc.batch(texts)):
                    ids += end
                    n, at, piece = len(ids) // 4, 0, 0
                    while at < n:
                        size = n % length or length if at == 0 else length
                        rows.append((key, piece, at, size, zlib.crc32(ids[4 * at: 4 * (at + size)])))
                        at, piece = at + size, piece + 1
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def pieces(docs: DataFrame, vocabulary: str, end_id: int, length: int, special: bool = False) -> DataFrame:
    """One row per piece of each document (doc_id, text).  `special`: as for ChunkEncoder."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut(vocabulary, end_id, length, special), PIECES)


def sum_of_squares(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each size; sequences are numbered from 0."""
    count = np.zeros(length + 1, dtype=np.int64)      # open sequences by places left
    count[0] = 0
    open_at: list[list[int]] = [[] for _ in range(length + 1)]
    seq, off, made = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64), 0
    far = np.int64(1) << 60
    for i in np.lexsort((np.arange(len(sizes)), -sizes)):
        s = int(sizes[i])
        if s < length:
            # change of the sum if the piece goes to gap s + k, leaving k; a full sequence counts no more
            change = 2 * (count[: length - s] - count[s:length]) + 2
            change[0] = 1 - 2 * count[s]
            change[count[s:length] == 0] = far
            k = int(change.argmin())
        if s < length and change[k] < far:
            b = open_at[s + k].pop()
            count[s + k] -= 1
            seq[i], off[i], left = b, length - s - k, k
        else:
            b, made = made, made + 1
            seq[i], off[i], left = b, 0, length - s
        if left:
            count[left] += 1
            open_at[left].append(b)
    return seq, off


def _pack(length: int, size: str, seq: str, off: str, order: list[str]):
    def run(key, g):
        g = g.sort_values(order, kind="stable", na_position="first", ignore_index=True)
        b, o = sum_of_squares(g[size].to_numpy(), length)
        return g.assign(**{seq: (int(key[0]) << 32) + b, off: o})
    return run


def pack(cut: DataFrame, length: int, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces (with a column `length`)."""
    n = cut.count()
    blocks = max(1, -(-n // block_pieces))
    block = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks))
    first = materialize(
        cut.withColumn("block", block).groupBy("block").applyInPandas(
            _pack(length, "length", "seq", "off", ["doc_id", "piece", "ids_crc32"]),
            f"{PIECES}, block long, seq long, off long"), "packed")
    filled = first.groupBy("seq").agg(F.sum("length").alias("size"))
    loose = filled.filter(F.col("size") < length * (1 - LOOSE))
    again = (loose.withColumn("block", F.pmod(F.xxhash64("seq"), F.lit(max(1, blocks // 16))))
                  .groupBy("block").applyInPandas(_pack(length, "size", "to", "shift", ["seq"]),
                                                  "seq long, size long, block long, to long, shift long"))
    moved = again.select("seq", (F.col("to") + F.lit(1 << 62)).alias("to"), "shift")
    return (first.join(moved, "seq", "left")
                 .select("doc_id", "piece", "start", "length", "ids_crc32",
                         F.coalesce("to", "seq").alias("sequence_id"),
                         (F.col("off") + F.coalesce("shift", F.lit(0))).alias("offset")))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    return pack(materialize(pieces(docs, vocabulary, end_id, length, special=True), "pieces"), length)
