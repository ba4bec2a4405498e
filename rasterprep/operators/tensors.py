"""Patch staging for the byte sink (the fast path of C7).

``raster.stage_tensors`` builds ``array<float>`` tensors with SQL higher-order
functions, which Spark evaluates element by element outside codegen.  When the
output is raw bytes (the sink form), the steps here do the same checks, padding,
channel stacking and class remapping with numpy, one patch at a time, in one kernel
(``pack_patch_arrays``).  Spark plans and partitions everything.

Output columns: ``*ids, *keep, reason, detail, height, width, channels, <one float32
LE, HWC tensor per band group>, label (uint8)``; ``reason`` NULL marks a good sample.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterprep import schemas
from rasterprep.operators.raster import band_entries
from rasterprep.sources.objects import MISSING, NUMERIC_KINDS, Decoder, as_float32, load_band, npy_decoder

IMAGE_GROUP = {"image": tuple(schemas.IMAGE_BANDS)}


def _class_table(lut: Sequence[int] | None) -> np.ndarray:
    table = np.asarray(lut if lut is not None else schemas.class_lut(), dtype=np.int64)
    if table.min() < 0 or table.max() > 255:
        raise ValueError("class indices must fit one byte")
    return table


def pack_patch_arrays(bands: Mapping[str, tuple[np.ndarray | None, str | None]],
                      groups: Mapping[str, Sequence[str]], label_band: str, table: np.ndarray,
                      pad_to: tuple[int, int] | None) -> dict:
    """Check, pad, stack and remap one patch: ``reason, detail, height, width, <groups>, label``.

    ``bands`` maps a band to ``(array, error)``; an error that starts with ``missing`` is an
    absent band, any other a broken one.  Image bands hold numbers that float32 can hold, the
    class map whole numbers of an integer type: any other type is a ``bad_dtype``, and no
    result of a decoder raises here.
    """
    out = dict.fromkeys(("reason", "detail", "height", "width", "label", *groups))
    absent = [b for b, (_, e) in bands.items() if e is not None and e.startswith(MISSING)]
    broken = [f"{b}: {e}" for b, (_, e) in bands.items() if e is not None and not e.startswith(MISSING)]
    if broken:
        return out | {"reason": "decode_error", "detail": "; ".join(broken)}
    if absent:
        return out | {"reason": "missing_band", "detail": ",".join(absent)}
    wrong, arrays = [], {}
    for b, (arr, _) in bands.items():
        if arr is not None and arr.dtype.kind not in (schemas.CLASS_KINDS if b == label_band else NUMERIC_KINDS):
            wrong.append(f"{b}: {arr.dtype}")
    if wrong:
        return out | {"reason": "bad_dtype", "detail": "; ".join(wrong)}
    for b, (arr, _) in bands.items():
        if pad_to is not None and arr is not None:
            arr = np.pad(arr, [(0, max(0, pad_to[0] - arr.shape[0])), (0, max(0, pad_to[1] - arr.shape[1]))])
        arrays[b] = arr
    if any(a is None or a.size == 0 for a in arrays.values()) or len({a.shape for a in arrays.values()}) != 1:
        return out | {"reason": "shape_mismatch"}
    codes = arrays[label_band]
    if codes.min() < 0 or codes.max() >= len(table):
        return out | {"reason": "code_out_of_range"}
    codes = codes.astype(np.int64)
    try:
        exact = {b: as_float32(arrays[b]) for members in groups.values() for b in members}
    except ValueError as e:
        return out | {"reason": "bad_dtype", "detail": str(e)}
    out["height"], out["width"] = codes.shape
    for name, members in groups.items():
        out[name] = np.stack([exact[b] for b in members], -1).astype("<f4").tobytes()
    out["label"] = table[codes].astype("u1").tobytes()
    return out


def _staged_schema(fields: list[T.StructField], groups: Mapping[str, Sequence[str]]) -> T.StructType:
    return T.StructType(
        fields + [T.StructField("reason", T.StringType()), T.StructField("detail", T.StringType()),
                  T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
                  T.StructField("channels", T.IntegerType())]
        + [T.StructField(g, T.BinaryType()) for g in groups] + [T.StructField("label", T.BinaryType())])


def _staged_batch(batch: pa.RecordBatch, passed: Sequence[str], rows: list[dict],
                  groups: Mapping[str, Sequence[str]], names: list[str]) -> pa.RecordBatch:
    kinds = {"reason": pa.string(), "detail": pa.string(), "height": pa.int32(), "width": pa.int32()}
    channels = sum(len(m) for m in groups.values())
    cols = [batch.column(batch.schema.get_field_index(k)) for k in passed]
    cols += [pa.array([r[k] for r in rows], t) for k, t in kinds.items()]
    cols.append(pa.array([channels] * len(rows), pa.int32()))
    cols += [pa.array([r[k] for r in rows], pa.binary()) for k in (*groups, "label")]
    return pa.RecordBatch.from_arrays(cols, names=names)


def stage_packed(patches: DataFrame, image_bands: Sequence[str] = schemas.IMAGE_BANDS,
                 label_band: str = schemas.REFERENCE_BAND, pad_to: tuple[int, int] | None = None,
                 keep: Sequence[str] = ("split",), lut: Sequence[int] | None = None) -> DataFrame:
    """Stage patches that arrive as one struct column per band (``raster.assemble_patch``)."""
    passed = ["patch_id"] + [k for k in keep if k in patches.columns]
    groups = {"image": tuple(image_bands)}
    bands = list(image_bands) + [label_band]
    table = _class_table(lut)
    out_schema = _staged_schema([patches.schema[k] for k in passed], groups)
    names = out_schema.fieldNames()

    def band(name: str, value) -> tuple[np.ndarray | None, str | None]:
        if value is None:
            return None, f"{MISSING} band"
        if value.get("error") is not None:
            return None, value["error"]
        pixels, h, w = value["pixels"], value["height"], value["width"]
        if pixels is None or h is None or w is None or len(pixels) != h * w:
            return None, None
        arr = np.asarray(pixels, np.float32).reshape(h, w)
        if name != label_band:
            return arr, None
        # pixels travel as float32: the type that the file had decides, or whole numbers where it is not known
        if value.get("dtype"):
            whole = np.dtype(value["dtype"]).kind in schemas.CLASS_KINDS
        else:
            whole = bool((arr == np.floor(arr)).all())
        return (arr.astype(np.int64) if whole else arr), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                columns = {b: part.column(part.schema.get_field_index(b)).to_pylist() for b in bands}
                rows = [pack_patch_arrays({b: band(b, columns[b][i]) for b in bands}, groups, label_band, table, pad_to)
                        for i in range(part.num_rows)]
                yield _staged_batch(part, passed, rows, groups, names)

    return patches.select(*passed, *[F.col(f"`{b}`") for b in bands]).mapInArrow(run, out_schema)


def split_packed(staged: DataFrame, keep: Sequence[str] = ("split",)) -> tuple[DataFrame, DataFrame]:
    """``(samples in sink form, rejects)`` of a staged frame."""
    dropped = ("reason", "detail")
    ids = [c for c in ("sample_id", "patch_id") if c in staged.columns]
    samples = staged.where(F.col("reason").isNull()).select(*[c for c in staged.columns if c not in dropped])
    rejects = staged.where(F.col("reason").isNotNull()).select(*ids, *dropped)
    return samples, rejects


def read_patches(meta: DataFrame, decoder: Decoder | None = None,
                 groups: Mapping[str, Sequence[str]] = IMAGE_GROUP,
                 label_band: str = schemas.REFERENCE_BAND, suffix: str = schemas.RASTER_SUFFIX,
                 pad_to: tuple[int, int] | None = None, keep: Sequence[str] = ("split",),
                 lut: Sequence[int] | None = None, io_threads: int = 8,
                 rows_per_batch: int = 64) -> DataFrame:
    """C7 without a pixel shuffle: each task reads, decodes and packs whole patches.

    ``meta`` rows carry ``patch_id``, ``s1_name``, ``s1_path``, ``s2_path``,
    ``reference_path`` (see ``raster.with_paths``).  ``groups`` names the output tensors
    and their bands.  A patch's band files are fetched concurrently (``io_threads``, like a
    bulk object-store fetch) and emitted in batches of at most ``rows_per_batch`` patches
    (~400 KB each at full size), so worker memory stays bounded.  Only the metadata is
    partitioned (by the caller); pixel data never crosses the network.  A store error
    fails the task; only absent and undecodable files make rejects.
    """
    from concurrent.futures import ThreadPoolExecutor

    decode = decoder or npy_decoder
    passed = [k for k in ("sample_id", "patch_id", *keep) if k in meta.columns]
    bands = list(dict.fromkeys(b for members in groups.values() for b in members)) + [label_band]
    s1 = [b for b in bands if b in schemas.S1_BANDS]
    s2 = [b for b in bands if b not in schemas.S1_BANDS and b != label_band]
    staged_in = meta.select(*passed, F.array(*band_entries(s1, s2, True, suffix)).alias("__bands"))
    table = _class_table(lut)
    out_schema = _staged_schema([meta.schema[k] for k in passed], groups)
    names = out_schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(max_workers=max(1, io_threads)) as pool:
            for batch in batches:
                for lo in range(0, batch.num_rows, rows_per_batch):
                    part = batch.slice(lo, rows_per_batch)
                    jobs = [[(e["band"], pool.submit(load_band, e["path"], decode)) for e in row]
                            for row in part.column(part.schema.get_field_index("__bands")).to_pylist()]
                    rows = [pack_patch_arrays({b: f.result() for b, f in row}, groups, label_band, table, pad_to)
                            for row in jobs]
                    yield _staged_batch(part, passed, rows, groups, names)

    return staged_in.mapInArrow(run, out_schema)


def unpack_samples(samples: DataFrame) -> DataFrame:
    """The array form (``image array<float>``, ``label array<int>``) of samples in sink form."""
    kinds = {"image": ("<f4", pa.float32(), T.FloatType()), "label": ("u1", pa.int32(), T.IntegerType())}
    schema = T.StructType([T.StructField(f.name, T.ArrayType(kinds[f.name][2], False), f.nullable)
                           if f.name in kinds else f for f in samples.schema.fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                cols = []
                for name in names:
                    col = part.column(part.schema.get_field_index(name))
                    if name in kinds:
                        dtype, item, _ = kinds[name]
                        flats = [np.frombuffer(x.as_py(), dtype) for x in col]
                        offs = np.concatenate([[0], np.cumsum([len(x) for x in flats])]).astype(np.int32)
                        flat = np.concatenate(flats) if flats else np.empty(0, dtype)
                        col = pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.astype(item.to_pandas_dtype())))
                    cols.append(col)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return samples.mapInArrow(run, schema)
