"""Token-id files with directly addressable codes.

An id is split into chunks of eight bits, least significant first.  Level 0 holds the
first chunk of every id; a continuation bitmap marks the ids that go on, and level 1
holds the second chunk of those only, and so on.  The place of an id's next chunk is
the number of marked ids before it, which a rank directory (ones before each 512 bits)
and one short popcount give.  So any id is read without decoding its block.

A file is a Parquet table whose rows are blocks of consecutive documents, in ascending
id order: Spark's commit protocol makes it safe against lost executors, and the block
itself is one self-describing byte string (layout in :func:`encode_block`).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterprep.llm.common import chunk_texts, scratch_dir, text_chunks
from rasterprep.llm.tokens import encoder, lower_where_safe

MAGIC = b"DAC1"
RANK_BITS = 512
#: Text bytes of a block, about; a longer document is one block, whole.
BLOCK_BYTES = 2 << 20

BLOCK_SCHEMA = "part int, block int, start long, n_docs int, n_ids long, data binary"
_HEAD = struct.Struct("<4sIQI")
_LEVEL = struct.Struct("<QQQ")


# --- blocks ---------------------------------------------------------------------------------

def encode_block(ids: np.ndarray, doc_ids: np.ndarray, has_id: np.ndarray, n_tokens: np.ndarray) -> bytes:
    """A block: magic, documents, ids, levels; the documents' ids, whether they have one,
    and the end of each in ids; per level the three sizes, the rank directory, the
    continuation bitmap and the chunks."""
    parts = [doc_ids.astype("<i8").tobytes(), has_id.astype(np.uint8).tobytes(),
             np.cumsum(n_tokens).astype("<u8").tobytes()]
    left, levels = ids.astype(np.uint32), 0
    while levels == 0 or len(left):
        more = left >> np.uint32(8)
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        ones = np.add.reduceat(goes_on, np.arange(0, len(left), RANK_BITS), dtype=np.uint32) if len(left) \
            else np.empty(0, np.uint32)
        rank = (np.cumsum(ones) - ones).astype("<u4")
        parts += [_LEVEL.pack(len(left), rank.nbytes, bitmap.nbytes), rank.tobytes(), bitmap.tobytes(),
                  (left & np.uint32(0xFF)).astype(np.uint8).tobytes()]
        left = more[goes_on]
        levels += 1
    return _HEAD.pack(MAGIC, len(doc_ids), len(ids), levels) + b"".join(parts)


class Block:
    """Reads a block's documents and any of its ids."""

    def __init__(self, data: bytes):
        magic, n_docs, self.n_ids, n_levels = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        at = _HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        self.has_id = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
        self.ends = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        at += 17 * n_docs
        self.levels = []
        for _ in range(n_levels):
            n, rank_bytes, map_bytes = _LEVEL.unpack_from(data, at)
            at += _LEVEL.size
            rank = np.frombuffer(data, "<u4", rank_bytes // 4, at)
            bitmap = np.frombuffer(data, np.uint8, map_bytes, at + rank_bytes)
            chunks = np.frombuffer(data, np.uint8, n, at + rank_bytes + map_bytes)
            self.levels.append((rank, bitmap, chunks))
            at += rank_bytes + map_bytes + n

    def _rank(self, level: int, i: int) -> int:
        """Marked ids of a level before its entry ``i``."""
        rank, bitmap, chunks = self.levels[level]
        if i >= len(chunks):
            return len(self.levels[level + 1][2]) if level + 1 < len(self.levels) else 0
        lo = i // RANK_BITS * RANK_BITS
        bits = np.unpackbits(bitmap[lo // 8:-(-(i + 1) // 8)], bitorder="little")[:i - lo]
        return int(rank[i // RANK_BITS]) + int(bits.sum())

    def get(self, i: int) -> int:
        """The ``i``-th id of the block: one chunk and one rank per level."""
        value = 0
        for level, (_, bitmap, chunks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def range(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` up to ``hi``; only their part of each level is touched."""
        values = np.zeros(hi - lo, np.uint32)
        spots = np.arange(hi - lo)
        for level, (_, bitmap, chunks) in enumerate(self.levels):
            if hi <= lo:
                break
            values[spots] |= chunks[lo:hi].astype(np.uint32) << np.uint32(8 * level)
            bits = np.unpackbits(bitmap[lo // 8:-(-hi // 8)], bitorder="little")[lo % 8:lo % 8 + hi - lo]
            spots = spots[bits.view(bool)]
            lo = self._rank(level, lo)
            hi = lo + len(spots)
        return values

    def document(self, k: int) -> np.ndarray:
        """The ids of the ``k``-th document."""
        return self.range(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


# --- writing and reading files ------------------------------------------------------------------

def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", blank_free: bool = True, lower: bool = True) -> None:
    """Tokenise every whole text, append ``end_id`` and write the ids to ``path`` in
    ascending id order (rows without an id first; repeated ids in any order).

    Null counts as empty.  Rows are dealt by id range, so files hold consecutive ids.
    ``blank_free`` and ``lower`` say that the tokenizer drops white space and lower-cases.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, blank_free)
        part, block, start = TaskContext.get().partitionId(), 0, 0
        for rows, data, offs in text_chunks(batches, "text", BLOCK_BYTES):
            ids, n = enc.encode(chunk_texts(lower_where_safe(data) if lower else data, offs))
            ids = np.insert(ids, np.cumsum(n), end_id)
            own = rows.column(0)
            blob = encode_block(ids, own.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                                own.is_valid().to_numpy(zero_copy_only=False), n + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([rows.num_rows], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([blob], pa.binary())],
                names=["part", "block", "start", "n_docs", "n_ids", "data"])
            block, start = block + 1, start + len(ids)

    picked = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    ordered = picked.repartitionByRange("id").sortWithinPartitions("id")
    ordered.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, ids)`` of every document of a written file: ``start`` counts the ids of
    all documents before it, ``ids`` are little-endian unsigned 32-bit integers."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row per written partition: the totals before each
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = Block(blob.as_py())
                starts = first + np.concatenate([[0], b.ends[:-1]]).astype(np.int64)
                blobs = [b.document(k).astype("<u4").tobytes() for k in range(len(b.ends))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b.doc_ids, mask=~b.has_id), pa.array(starts), pa.array(blobs, pa.binary())],
                    names=["id", "start", "ids"])

    # one row per written partition: bounded by what the driver schedules anyway
    placed = blocks.join(F.broadcast(base), "part").select((F.col("start") + F.col("base")).alias("start"), "data")
    return placed.mapInArrow(run, "id long, start long, ids binary")


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Write a file below the shared folder and read its documents back."""
    path = scratch_dir(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer, end_id, id_col, text_col)
    return read_documents(docs.sparkSession, path)
