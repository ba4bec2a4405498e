"""Sinks and output sizing.

Datasets are written once, partitioned by ``split`` under ``{out}/data``;
profiles and reports live beside it (``{out}/profile``), never inside the
partitioned folder, so dynamic partition overwrite can rewrite some splits
without touching the rest.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterprep import schemas
from rasterprep.sources import footers as FT
from rasterprep.sources.objects import _open_bytes, _resolve

# --- sizing (P19, P20) ------------------------------------------------------------


def dataset_bytes(rows: Column, bytes_per_row: int = schemas.BYTES_PER_SAMPLE) -> Column:
    """``rows * bytes_per_row`` (360,000 bytes per full-size sample)."""
    return (rows.cast("long") * F.lit(int(bytes_per_row))).cast("long")


def dataset_gib(rows: Column, bytes_per_row: int = schemas.BYTES_PER_SAMPLE) -> Column:
    """The same in GiB, rounded half-even to 2 decimals."""
    return F.bround(dataset_bytes(rows, bytes_per_row).cast("double") / F.lit(float(1 << 30)), 2)


def partition_plan(rows: Column, cores: int, executors: int) -> Column:
    """P20: ``min(rows, cores * executors * 4)`` partitions for a split."""
    return F.least(rows.cast("long"), F.lit(int(cores) * int(executors) * 4).cast("long"))


def tasks_per_executor(partitions: Column, executors: int) -> Column:
    """P20: ``max(1, partitions div executors)``."""
    return F.greatest(F.lit(1).cast("long"), (partitions / F.lit(int(executors))).cast("long"))


def records_per_file(target_mb: float, bytes_per_row: float = schemas.BYTES_PER_SAMPLE) -> int:
    """Rows per file so that a file is about ``target_mb`` MiB."""
    return max(1, int(math.floor(target_mb * (1 << 20) / bytes_per_row)))


# --- byte encoding (P17, S17) -------------------------------------------------------


def to_bytes(df: DataFrame, columns: dict[str, str], on_overflow: str = "raise") -> DataFrame:
    """Replace array columns by their raw little-endian bytes (numpy ``tobytes``).

    ``columns`` maps column -> numpy dtype (e.g. ``{"image": "<f4", "label": "u1"}``).
    Runs as ``mapInArrow``: each batch's flat child values are cast once and
    sliced by the list offsets, no per-element Python.  Narrowing is checked: an integer
    outside the target type raises, or gives NULL bytes with ``on_overflow="null"``.
    """
    if on_overflow not in ("raise", "null"):
        raise ValueError(f"on_overflow must be 'raise' or 'null', got {on_overflow!r}")
    out_fields = []
    for f in df.schema.fields:
        out_fields.append(T.StructField(f.name, T.BinaryType(), f.nullable) if f.name in columns else f)
    schema = T.StructType(out_fields)
    names = [f.name for f in df.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = []
            for name in names:
                col = batch.column(batch.schema.get_field_index(name))
                if name not in columns:
                    arrays.append(col)
                    continue
                dtype = np.dtype(columns[name])
                offsets = col.offsets.to_numpy()
                wide = col.values.to_numpy(zero_copy_only=False)
                valid = col.is_valid().to_numpy(zero_copy_only=False).copy()
                if dtype.kind in "iu" and len(wide):
                    info = np.iinfo(dtype)
                    outside = ~((wide >= info.min) & (wide <= info.max))
                    if outside.any():
                        if on_overflow == "raise":
                            raise ValueError(f"column {name}: {wide[outside][0]} does not fit {dtype}")
                        before = np.concatenate([[0], np.cumsum(outside)])
                        valid &= before[offsets[1:]] == before[offsets[:-1]]
                with np.errstate(invalid="ignore"):
                    flat = wide.astype(dtype, copy=False)
                data = [flat[offsets[i]:offsets[i + 1]].tobytes() if valid[i] else None
                        for i in range(len(col))]
                arrays.append(pa.array(data, type=pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)


def pack_samples(samples: DataFrame) -> DataFrame:
    """Sink form of the tensor table: ``image`` float32 bytes, ``label`` uint8 bytes.

    Class indices are < 256; one that is not raises.
    """
    return to_bytes(samples, {"image": "<f4", "label": "u1"})


def pack_patch(patches: DataFrame) -> DataFrame:
    """S17, five-column packed form: ``patch_id, s1, s2, reference, labels`` as raw bytes.

    Expects ``s1``/``s2`` float tensors, ``reference`` class indices (< 256) and
    ``labels`` a 0/1 multi-hot vector; written as float32, float32, uint8, int8.
    """
    return to_bytes(patches.select("patch_id", "s1", "s2", "reference", "labels"),
                    {"s1": "<f4", "s2": "<f4", "reference": "u1", "labels": "i1"})


# --- dataset writers (S2, S9-S13) ----------------------------------------------------


def write_metadata(df: DataFrame, out: str, mode: str = "overwrite") -> None:
    """Persist an (enriched) metadata table as Parquet."""
    df.write.mode(mode).parquet(out)


def write_splits(samples: DataFrame, out: str, target_file_mb: float | None = 50,
                 bytes_per_row: int = schemas.BYTES_PER_SAMPLE, rowgroup_mb: float | None = None,
                 partitions: int | None = None, dynamic_overwrite: bool = True,
                 pilot_rows: int | None = None) -> str:
    """Write ``{out}/data/split=<s>/`` for every non-empty split (X2), Parquet.

    ``target_file_mb`` caps rows per file (``maxRecordsPerFile``, S10/S11);
    ``rowgroup_mb`` sets ``parquet.block.size``; ``partitions`` forces the number of
    output tasks (S12) by a shuffle, so that whatever computes ``samples`` keeps its own
    parallelism.  With ``pilot_rows`` so many rows are written to a pilot first and the rows of
    a file, which is one row group, follow from the bytes that their footers show: samples
    that compress well make no small files.  Dynamic partition overwrite replaces only the splits present in
    ``samples``; without it the whole dataset is replaced.
    """
    path = f"{out.rstrip('/')}/data"
    df = samples.repartition(partitions) if partitions else samples
    writer = df.write.mode("overwrite").partitionBy("split")
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if target_file_mb:
        if pilot_rows:
            bytes_per_row = measured_row_bytes(samples, out, pilot_rows) or bytes_per_row
        rows = records_per_file(target_file_mb, bytes_per_row)
        writer = writer.option("maxRecordsPerFile", rows)
        if pilot_rows:      # the file's rows close the row group, not the bytes that buffers take
            writer = writer.option("parquet.block.row.count.limit", rows).option("parquet.block.size", 1 << 40)
    if rowgroup_mb:
        writer = writer.option("parquet.block.size", int(rowgroup_mb * (1 << 20)))
    writer.parquet(path)
    return path


def measured_row_bytes(samples: DataFrame, out: str, pilot_rows: int) -> float | None:
    """Compressed bytes that a row of ``samples`` takes, from the footers of a pilot of at
    most ``pilot_rows`` rows, which stays in ``{out}/_pilot``; None without rows."""
    path = f"{out.rstrip('/')}/_pilot"
    samples.drop("split").limit(pilot_rows).coalesce(1).write.mode("overwrite").parquet(path)
    return FT.bytes_per_row(FT.dataset_footers(samples.sparkSession, path))


def batch_ids(df: DataFrame, batch_size: int, pos_col: str = "pos", out: str = "part") -> DataFrame:
    """S11 when the batch must be visible: ``part = pos div batch_size``."""
    return df.withColumn(out, (F.col(pos_col) / F.lit(int(batch_size))).cast("long"))


# --- versions of a dataset (S9) ---------------------------------------------------------

#: The document that names the version in use, beside the dataset.
CURRENT = "_current.json"
#: Tables of a version, each a folder ``{out}/{table}/version={id}``.
VERSION_TABLES = ("data", "rejects", "manifest")


def new_version() -> str:
    """A fresh version id; later ones sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def version_path(out: str, table: str, version: str) -> str:
    return f"{out.rstrip('/')}/{table}/version={version}"


def current_version(out: str) -> dict | None:
    """What :func:`publish` recorded last, or None for a dataset without versions."""
    try:
        return json.loads(_open_bytes(f"{out.rstrip('/')}/{CURRENT}"))
    except (FileNotFoundError, NotADirectoryError):
        return None


def publish(out: str, version: str, facts: dict, keep: int = 0) -> None:
    """Switch the dataset to a version whose tables are completely written.

    The switch is one small document, replaced in one step (a local file by a rename, an
    object by a put), so a reader sees the old version or the new one, and a run that fails
    before leaves the old one in use.  Then all versions but this and the ``keep`` latest
    others are removed, with what failed runs left behind.
    """
    write_small_file(f"{out.rstrip('/')}/{CURRENT}", json.dumps({"version": version, **facts}))
    for table in VERSION_TABLES:
        old = [v for v in _versions(out, table) if v != version]
        for v in old[:len(old) - keep]:
            filesystem, inner = _resolve(version_path(out, table, v))
            filesystem.delete_dir(inner)


def _versions(out: str, table: str) -> list[str]:
    from pyarrow import fs as pafs
    filesystem, inner = _resolve(f"{out.rstrip('/')}/{table}")
    found = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return sorted(i.base_name.split("=", 1)[1] for i in found if i.base_name.startswith("version="))


def table_path(out: str, table: str = "data") -> str:
    """Where the published version of a table is; ``{out}/{table}`` for one without versions."""
    now = current_version(out)
    return version_path(out, table, now["version"]) if now else f"{out.rstrip('/')}/{table}"


def read_split(spark: SparkSession, out: str, split: str | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Read the published dataset (one split by partition pruning); explicit schema keeps
    ``split`` a string."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(table_path(out))
    return df.where(F.col("split") == split) if split else df


# --- reports (S6, S8) -------------------------------------------------------------------


def write_validation_report(summary: DataFrame, missing: DataFrame, out: str) -> None:
    """One-row summary as a single JSON file, missing patches as their own JSON table."""
    base = out.rstrip("/")
    summary.coalesce(1).write.mode("overwrite").json(f"{base}/summary")
    missing.write.mode("overwrite").json(f"{base}/missing")


def write_profiles(profiles: DataFrame, out: str, fmt: str = "json") -> None:
    """Persist run profiles (array of step structs + summary) as JSON or Parquet."""
    profiles.write.mode("overwrite").format(fmt).save(out)


def profile_text(profiles: DataFrame) -> DataFrame:
    """S8 text rendering, ``(path, i, line)`` in order of ``i``: a header, the log messages,
    one line per step, the total, and the summary values that are present."""
    head = profiles.select("path", F.lit(0).cast("long").alias("i"), F.format_string(
        "run %s .. %s on %s", "start_time", "end_time",
        F.coalesce(F.col("host_info.hostname"), F.lit("?"))).alias("line"))
    logs = profiles.select("path", F.posexplode("logs").alias("n", "l")).select(
        "path", (F.lit(1 << 20) + F.col("n")).cast("long").alias("i"),
        F.format_string("[%s] %s", F.col("l.timestamp"), F.col("l.message")).alias("line"))
    steps = profiles.select("path", F.posexplode("steps").alias("n", "s")).select(
        "path", (F.lit(1 << 40) + F.col("n")).cast("long").alias("i"),
        F.concat(F.format_string("%s: %.2fs", F.col("s.name"), F.col("s.duration")),
                 F.when(F.col("s.epochs").isNotNull(), F.format_string(" epochs=%d", F.col("s.epochs")))
                 .otherwise(F.lit(""))).alias("line"))
    totals = profiles.select(
        "path", F.lit(1 << 50).cast("long").alias("i"),
        F.format_string("total_duration: %.2fs", F.col("summary.total_duration")).alias("line"))
    keys = [f.name for f in schemas.PROFILE_SCHEMA["summary"].dataType.fields if f.name != "total_duration"]
    values = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"summary.{k}").cast("string").alias("v")) for k in keys])
    summary = profiles.select("path", F.posexplode(values).alias("n", "e")).where("e.v IS NOT NULL").select(
        "path", (F.lit((1 << 50) + 1) + F.col("n")).cast("long").alias("i"),
        F.concat("e.k", F.lit(": "), "e.v").alias("line"))
    return head.unionByName(logs).unionByName(steps).unionByName(totals).unionByName(summary)


def write_profile_text(profiles: DataFrame, out: str) -> None:
    (profile_text(profiles).repartition("path").sortWithinPartitions("path", "i")
     .select("line").write.mode("overwrite").text(out))


def write_small_file(uri: str, text: str) -> None:
    """Write one small driver-side document (a run profile) to a local or remote path."""
    from pyarrow import fs as pafs
    target = uri
    if target.startswith("s3a://"):
        target = "s3://" + target[len("s3a://"):]
    elif "://" not in target:
        target = "file://" + os.path.abspath(target)
    filesystem, inner = pafs.FileSystem.from_uri(target)
    parent = inner.rsplit("/", 1)[0]
    if parent:
        filesystem.create_dir(parent, recursive=True)
    local = isinstance(filesystem, pafs.LocalFileSystem)
    first = f"{inner}.{uuid.uuid4().hex}" if local else inner      # an object store replaces in one step anyway
    with filesystem.open_output_stream(first) as f:
        f.write(text.encode("utf-8"))
    if local:
        os.replace(first, inner)
