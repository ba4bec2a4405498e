"""Object-store sources: listing, bulk binary scan, targeted reads and decoding.

* ``list_objects``  -- one row per object; only ``path`` is selected, so Spark's
  ``binaryFile`` source never reads contents (``ReadSchema: struct<path:string>``).
* ``scan_files``    -- ``(path, content)`` for every object under a root (full scans).
* ``read_paths``    -- contents of the paths named by a manifest column only, read
  inside tasks through ``pyarrow.fs`` (sampled runs must not scan the archive).
* ``decode_rasters``-- bytes -> ``(height, width, pixels array<float>, dtype, error)`` with a
  pluggable decoder; decoding failures become data (``error``), not job failures.
* ``list_under``    -- distributed listing below a table of prefixes.

An absent object is data (``error`` starting with ``missing``).  Any other store error
(access denied, throttling, a broken connection) is retried and then fails the task:
an expired credential must not turn an archive into rejects.
"""

from __future__ import annotations

import functools
import io
import os
import time
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Decoder = Callable[[bytes], np.ndarray]

DECODED_FIELDS = [
    T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("pixels", T.ArrayType(T.FloatType())),
    T.StructField("dtype", T.StringType()),
    T.StructField("error", T.StringType()),
]

#: Kinds of numpy items that a band may hold: whole numbers, signed or not, and floats.
NUMERIC_KINDS = "iuf"
#: Files whose bytes a task holds at a time, and fetches at once.
FILES_PER_BATCH, IO_THREADS = 64, 8


def npy_decoder(data: bytes) -> np.ndarray:
    """Default decoder: a ``.npy`` payload holding a 2-D (or 3-D, band 1 is used) array."""
    arr = np.load(io.BytesIO(data), allow_pickle=False)
    if arr.ndim == 3:
        arr = arr[0]
    if arr.ndim != 2:
        raise ValueError(f"expected a 2-D band, got shape {arr.shape}")
    return arr


def list_objects(spark: SparkSession, root: str, suffix: str | None = None,
                 recursive: bool = True) -> DataFrame:
    """Object paths under ``root`` (optionally ending with ``suffix``)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(root).select("path")


def scan_files(spark: SparkSession, root: str, suffix: str | None = None) -> DataFrame:
    """S3 (full scan): ``(path, content)`` for every object under ``root``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(root).select("path", "content")


def path_key(c) -> "F.Column":
    """Scheme-free, leading-slash-free key so ``s3://b/k``, ``s3a://b/k`` and ``b/k`` agree."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(col, r"^[A-Za-z][A-Za-z0-9+.\-]*:", ""), r"^/+", "")


def _normalise_uri(path: str) -> str:
    if path.startswith("s3a://"):
        return "s3://" + path[len("s3a://"):]
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    if "://" not in path:
        return "file://" + os.path.abspath(path)
    return path


@functools.lru_cache(maxsize=64)
def _filesystem(scheme: str, authority: str):
    """One filesystem client per (scheme, bucket/host) and Python worker, not per file."""
    from pyarrow import fs as pafs
    root = f"{scheme}://{authority}/" if scheme != "file" else "file:///"
    return pafs.FileSystem.from_uri(root)[0]


def _resolve(path: str):
    """``(filesystem, path inside it)`` for a URI or local path; clients are cached."""
    from urllib.parse import urlsplit
    uri = _normalise_uri(path)
    parts = urlsplit(uri)
    if parts.scheme in ("s3", "gs", "gcs"):
        return _filesystem(parts.scheme, parts.netloc), parts.netloc + parts.path
    if parts.scheme == "file":
        return _filesystem("file", ""), parts.path
    if parts.scheme in ("hdfs", "viewfs"):
        return _filesystem(parts.scheme, parts.netloc), parts.path
    from pyarrow import fs as pafs
    return pafs.FileSystem.from_uri(uri)


def checked_band(arr) -> np.ndarray:
    """A decoder's result if it is a 2-D array, else ValueError: its type and rank are facts of
    the file, whatever the decoder returned."""
    if not isinstance(arr, np.ndarray):
        raise ValueError(f"expected a 2-D band, got {type(arr).__name__}")
    if arr.ndim != 2:
        raise ValueError(f"expected a 2-D band, got shape {arr.shape}")
    return np.asarray(arr)


def as_float32(arr: np.ndarray) -> np.ndarray:
    """A band's items as float32; ValueError where one has no such value (text, objects, whole
    numbers that float32 cannot hold exactly, floats beyond its range)."""
    if arr.dtype.kind not in NUMERIC_KINDS:
        raise ValueError(f"items of type {arr.dtype} are not numeric")
    with np.errstate(over="ignore"):
        out = np.ascontiguousarray(arr, dtype=np.float32)
    if arr.dtype == np.float32 or not arr.size:
        return out
    if arr.dtype.kind == "f":
        lost = np.isfinite(arr) & ~np.isfinite(out)
    else:
        lost = (arr > 1 << 24) | (arr < -(1 << 24)) if arr.dtype.itemsize > 2 else np.zeros(1, bool)
    if lost.any():
        raise ValueError(f"{arr[lost].flat[0]} of type {arr.dtype} does not fit float32")
    return out


def _store_bytes(path: str | None) -> tuple[bytes | None, str | None]:
    """``(bytes, None)`` or ``(None, error)`` of an object; store errors raise."""
    if path is None:
        return None, f"{MISSING} path"
    try:
        return _open_bytes(path), None
    except (FileNotFoundError, NotADirectoryError):
        return None, f"{MISSING} object"


MISSING = "missing"     # start of the ``error`` of an object that is not there
STORE_ATTEMPTS = 4


def _open_bytes(path: str) -> bytes:
    """An object's bytes; store errors are retried, then raised.  ``FileNotFoundError`` is not."""
    for attempt in range(STORE_ATTEMPTS):
        try:
            filesystem, inner = _resolve(path)
            with filesystem.open_input_stream(inner) as f:
                return f.read()
        except (FileNotFoundError, NotADirectoryError):
            raise
        except OSError:
            if attempt == STORE_ATTEMPTS - 1:
                raise
            time.sleep(0.2 * 2 ** attempt)
    raise AssertionError("unreachable")


def load_band(path: str | None, decoder: "Decoder") -> tuple[np.ndarray | None, str | None]:
    """``(2-D array, None)`` or ``(None, error)`` of one band file; store errors raise."""
    data, error = _store_bytes(path)
    return (None, error) if data is None else decoded_band(data, decoder)


def decoded_band(data: bytes, decoder: "Decoder") -> tuple[np.ndarray | None, str | None]:
    """``(2-D array, None)`` or ``(None, error)`` of a band's bytes."""
    try:
        return checked_band(decoder(data)), None
    except MemoryError:
        raise
    except Exception as e:  # the decoder's verdict on these bytes
        return None, f"decode: {type(e).__name__}: {e}"


def read_paths(df: DataFrame, path_col: str = "path", rows_per_batch: int = FILES_PER_BATCH,
               io_threads: int = IO_THREADS) -> DataFrame:
    """S3 (targeted): add ``content`` (binary) and ``error`` for each row's ``path_col``.

    Each task reads only its own rows' objects, so a sampled manifest reads only the sampled
    files; it fetches ``io_threads`` of them at once and holds at most ``rows_per_batch``.
    """
    import pyarrow as pa
    from concurrent.futures import ThreadPoolExecutor

    schema = T.StructType(df.schema.fields + [
        T.StructField("content", T.BinaryType()), T.StructField("error", T.StringType())])
    names = df.columns

    def run(batches: Iterator["pa.RecordBatch"]) -> Iterator["pa.RecordBatch"]:
        with ThreadPoolExecutor(max_workers=max(1, io_threads)) as pool:
            for batch in batches:
                for lo in range(0, batch.num_rows, rows_per_batch):
                    part = batch.slice(lo, rows_per_batch)
                    got = list(pool.map(_store_bytes, part.column(names.index(path_col)).to_pylist()))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array([g[0] for g in got], pa.binary()),
                         pa.array([g[1] for g in got], pa.string())], names=[*names, "content", "error"])

    return df.mapInArrow(run, schema)


def _decoded_columns(bands: list[tuple[np.ndarray | None, str | None]]) -> list:
    """The columns of ``DECODED_FIELDS`` for bands as ``load_band`` returns them: pixels are one
    list array over a single buffer."""
    import pyarrow as pa

    hs, ws, kinds, errs, flats, lengths = [], [], [], [], [], []
    for arr, error in bands:
        flat = None
        if arr is not None:
            try:
                flat = as_float32(arr).reshape(-1)
            except ValueError as e:
                error = f"decode: {e}"
        hs.append(int(arr.shape[0]) if flat is not None else None)
        ws.append(int(arr.shape[1]) if flat is not None else None)
        kinds.append(str(arr.dtype) if arr is not None else None)
        errs.append(error)
        lengths.append(0 if flat is None else flat.size)
        if flat is not None:
            flats.append(flat)
    offsets = np.zeros(len(bands) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    values = pa.array(np.concatenate(flats) if flats else np.zeros(0, np.float32), pa.float32())
    mask = pa.array([e is not None for e in errs], pa.bool_())
    return [pa.array(hs, pa.int32()), pa.array(ws, pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values, mask=mask),
            pa.array(kinds, pa.string()), pa.array(errs, pa.string())]


def decode_rasters(files: DataFrame, decoder: Decoder = npy_decoder, content_col: str = "content",
                   rows_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Decode ``content`` into ``height, width, pixels, dtype, error``; drops ``content``.

    Every other column is passed through.  A row whose bytes are missing or fail to decode,
    or whose items float32 cannot hold, gets NULL pixels and the error text; ``dtype`` is the
    type that the file has.  At most ``rows_per_batch`` decoded bands are held at a time.
    """
    import pyarrow as pa

    keep = [f for f in files.schema.fields if f.name not in (content_col, "error", "dtype")]
    schema = T.StructType(keep + DECODED_FIELDS)
    names = [f.name for f in keep]
    columns = files.columns

    def run(batches: Iterator["pa.RecordBatch"]) -> Iterator["pa.RecordBatch"]:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows_per_batch):
                part = batch.slice(lo, rows_per_batch)
                prior = (part.column(columns.index("error")).to_pylist() if "error" in columns
                         else [None] * part.num_rows)
                bands = []
                for data, error in zip(part.column(columns.index(content_col)), prior):
                    if error is not None or not data.is_valid:
                        bands.append((None, error or f"{MISSING} content"))
                    else:
                        bands.append(decoded_band(data.as_py(), decoder))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(columns.index(n)) for n in names], *_decoded_columns(bands)],
                    names=schema.fieldNames())

    return files.mapInArrow(run, schema)


def read_rasters(df: DataFrame, decoder: Decoder = npy_decoder, path_col: str = "path",
                 rows_per_batch: int = 256) -> DataFrame:
    """S3 + S4 fused for sampled runs: open each row's ``path`` and decode it in the same task.

    Equivalent to ``decode_rasters(read_paths(df))`` but the file bytes never
    travel back to the JVM: the task reads, decodes and emits
    ``height, width, pixels, dtype, error`` next to the row's other columns.  Pixels of
    a batch are built as one Arrow list array from a single concatenated buffer.
    """
    import pyarrow as pa
    from concurrent.futures import ThreadPoolExecutor

    keep = [f for f in df.schema.fields if f.name not in ("error", "dtype")]
    schema = T.StructType(keep + DECODED_FIELDS)
    names = [f.name for f in keep]

    def run(batches):
        with ThreadPoolExecutor(max_workers=IO_THREADS) as pool:
            for batch in batches:
                # output rows are decoded bands, far larger than the input paths: bound each batch
                for start in range(0, batch.num_rows, rows_per_batch):
                    part = batch.slice(start, rows_per_batch)
                    paths = part.column(part.schema.get_field_index(path_col)).to_pylist()
                    bands = list(pool.map(lambda path: load_band(path, decoder), paths))
                    cols = [part.column(part.schema.get_field_index(n)) for n in names]
                    yield pa.RecordBatch.from_arrays(cols + _decoded_columns(bands), names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def list_under(prefixes: DataFrame, prefix_col: str = "prefix", recursive: bool = True,
               partitions: int | None = None, rows_per_batch: int = 10_000) -> DataFrame:
    """S5, distributed: list every object under each row's prefix inside the tasks.

    The distinct prefixes are dealt over ``partitions`` tasks (default: the session's
    shuffle partitions) -- by an explicit count, since a prefix table is so few bytes that
    AQE would merge it into one task.  A task walks one folder at a time through
    ``pyarrow.fs`` and emits ``(prefix, path)`` rows in batches of ``rows_per_batch``, so
    neither it nor the driver holds a listing.  A prefix that does not exist lists
    nothing; a failing listing raises (task retry) rather than hiding objects.
    """
    import pyarrow as pa
    from pyarrow import fs as pafs

    schema = T.StructType([T.StructField("prefix", T.StringType()), T.StructField("path", T.StringType())])

    def objects(uri: str):
        filesystem, inner = _resolve(uri.rstrip("/"))
        scheme = uri.split("://", 1)[0] + "://" if "://" in uri else ""
        folders = [inner]
        while folders:
            for info in filesystem.get_file_info(pafs.FileSelector(folders.pop(), allow_not_found=True)):
                if info.type == pafs.FileType.Directory and recursive:
                    folders.append(info.path)
                elif info.type == pafs.FileType.File:
                    yield scheme + info.path

    def run(batches):
        found: list[tuple[str, str]] = []

        def emit():
            return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()),
                                               pa.array([f[1] for f in found], pa.string())],
                                              names=["prefix", "path"])

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                for path in objects(uri):
                    found.append((uri, path))
                    if len(found) >= rows_per_batch:
                        yield emit()
                        found = []
        if found:
            yield emit()

    wanted = prefixes.select(F.col(prefix_col).alias("prefix")).where("prefix IS NOT NULL").distinct()
    n = partitions or int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted.repartition(n).mapInArrow(run, schema)
