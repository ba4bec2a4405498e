"""Helpers shared by the corpus operators: scratch tables, byte-bounded batches, hashes.

Python stages get Arrow batches from Spark; :func:`text_chunks` cuts them into
pieces of a few megabytes so that one very long text never forces a whole batch
of numpy temporaries into memory at once.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled by one round of numpy work.
CHUNK_BYTES = 4 << 20
#: Spark's setting that a query removes its shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Spark's setting for the bytes of an Arrow batch (it has only a number of rows otherwise), and ours.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """From now on the session hands rows to Python workers in batches of ``BATCH_BYTES``, about: ten
    thousand rows of whole texts are tens of megabytes, several times, in the executor and in its
    workers.  A limit that the session has stays."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


# --- tables shared between driver and executors ------------------------------------

def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's ``spark.checkpoint.dir``.

    On a cluster that setting names a folder all machines share, and is needed.  Only a
    local session without it (tests) uses a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="corpus-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that run meanwhile remove their shuffle files when they end, not when the driver
    happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet to a fresh shared folder and read it back: lineage ends
    there, a lost executor costs only the tasks that read it, and shuffle files go."""
    path = scratch_dir(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- text columns as byte arrays ----------------------------------------------------

def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    offs = np.frombuffer(offsets, np.int64, count=n + 1, offset=column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and n else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]] if n else raw[:0], offs - offs[0]


def text_chunks(batches: Iterator[pa.RecordBatch], text_col: str = "text",
                max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)`` of consecutive rows of about ``max_bytes`` of text.

    A chunk has at least one row, so a longer text is one chunk, whole.
    """
    for batch in batches:
        data, offs = utf8(batch.column(batch.schema.get_field_index(text_col)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1)
            yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def chunk_texts(data: np.ndarray, offs: np.ndarray) -> list[str]:
    """The texts of a chunk as Python strings."""
    raw = data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]


def then_released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; once they are all made, what Arrow and the C library keep of freed memory goes
    back to the system, so that an idle worker leaves it to the next stage."""
    yield from batches
    release_freed()


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, in a worker that gives freed memory back before it starts, as
    earlier stages may have left some, and when it ends."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_freed()
        yield from then_released(run(batches))

    return tidy


def release_freed() -> None:
    """Give back to the system what Arrow and the C library keep of freed memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:              # a C library without it
        pass


# --- hashing --------------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64) of a ``uint64`` array."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _byte_terms() -> np.ndarray:
    """A random 64-bit value for each (position below 256, byte)."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)


_TERMS: np.ndarray | None = None


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte slices ``data[start:end]`` (non-empty, ascending, disjoint).

    A slice's hash is the mixed sum of a random value for every (position, byte);
    it depends on the bytes alone, so it is the same in every task.
    """
    global _TERMS
    if not len(starts):
        return np.empty(0, np.uint64)
    if _TERMS is None:
        _TERMS = _byte_terms()
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    pos = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    raw = data[pos + np.repeat(starts, lens)]
    key = ((pos & 255) << 8) | raw
    terms = _TERMS[key]
    far = np.flatnonzero(pos > 255)
    if len(far):
        with np.errstate(over="ignore"):
            terms[far] = mix64(terms[far] + (pos[far] >> 8).astype(np.uint64) * _GOLDEN)
    with np.errstate(over="ignore"):
        return mix64(np.add.reduceat(terms, first) + lens.astype(np.uint64) * _GOLDEN)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def ascii_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, row)`` of the words ``[^\\x20\\x09-\\x0D]+`` of each text of a chunk."""
    n = len(data)
    if not n:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    row = np.searchsorted(offs, starts, side="right") - 1
    return starts, np.flatnonzero(end) + 1, row


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def id_crc(id_col: str = "doc_id"):
    """``crc32`` of the id's decimal text: it deals the folds of the learning operators."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def local_path(uri: str) -> str:
    return uri[len("file://"):] if uri.startswith("file://") else uri


def file_exists(path: str) -> bool:
    return os.path.exists(path)
