"""Patch-level raster operators: paths, band manifest, fetch, assemble, remap.

The tensor path is native Spark end to end except the byte decoder: band rows
are matched to files with an equi-join, pivoted onto one row per patch, checked,
stacked and remapped with higher-order SQL functions.  Failures are data: every
dropped patch appears in a rejects table with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.functions import arrays as A
from rasterprep.functions import paths as P
from rasterprep.sources.objects import Decoder, npy_decoder, path_key, read_rasters


def with_paths(meta: DataFrame, root: str, s1_folder: str = schemas.S1_FOLDER,
               s2_folder: str = schemas.S2_FOLDER,
               reference_folder: str = schemas.REFERENCE_FOLDER) -> DataFrame:
    """Append ``s1_path``, ``s2_path``, ``reference_path``; all other columns pass through.

    ``{root}/{s1_folder}/{s1 prefix}/{s1_name}``, ``{root}/{s2_folder}/{s2 prefix}/{patch_id}``,
    ``{root}/{reference_folder}/{s2 prefix}/{patch_id}``; NULL when an input is NULL.
    """
    base = root.rstrip("/") + "/"
    s2p = P.s2_prefix("patch_id")
    return meta.withColumns({
        "s1_path": P.join_path(f"{base}{s1_folder}/", P.s1_prefix("s1_name"), F.col("s1_name")),
        "s2_path": P.join_path(f"{base}{s2_folder}/", s2p, F.col("patch_id")),
        "reference_path": P.join_path(f"{base}{reference_folder}/", s2p, F.col("patch_id")),
    })


def band_entries(s1_bands: Sequence[str] = schemas.S1_BANDS,
                 s2_bands: Sequence[str] = schemas.S2_BANDS,
                 with_reference: bool = True, suffix: str = schemas.RASTER_SUFFIX) -> list[Column]:
    entries = [F.struct(F.lit(b).alias("band"),
                        P.band_file("s1_path", "s1_name", b, suffix).alias("path")) for b in s1_bands]
    entries += [F.struct(F.lit(b).alias("band"),
                         P.band_file("s2_path", "patch_id", b, suffix).alias("path")) for b in s2_bands]
    if with_reference:
        entries.append(F.struct(F.lit(schemas.REFERENCE_BAND).alias("band"),
                                P.band_file("reference_path", "patch_id", schemas.REFERENCE_BAND,
                                            suffix).alias("path")))
    return entries


def expand_band_paths(meta: DataFrame, s1_bands: Sequence[str] = schemas.S1_BANDS,
                      s2_bands: Sequence[str] = schemas.S2_BANDS, with_reference: bool = True,
                      suffix: str = schemas.RASTER_SUFFIX,
                      keep: Sequence[str] = ("split",)) -> DataFrame:
    """One row per (patch, band): ``(patch_id, band, path, *keep)``; 7 bands by default."""
    kept = [k for k in keep if k in meta.columns]
    return (meta.select("patch_id", *kept,
                        F.explode(F.array(*band_entries(s1_bands, s2_bands, with_reference, suffix)))
                        .alias("e"))
            .select("patch_id", "e.band", "e.path", *kept))


def fetch_bands(manifest: DataFrame, inventory: DataFrame, decoder: Decoder = npy_decoder) -> DataFrame:
    """Band manifest rows with the decoded band of their file, where the inventory lists it.

    Only paths are joined (on the normalised path); each task then opens the files of its own
    rows, so no pixel is shuffled.  A band without a listed file stays, with ``error``
    ``missing_band`` and nothing opened.
    """
    listed = inventory.select(path_key("path").alias("__pk")).distinct()
    keyed = manifest.withColumn("__pk", path_key("path"))
    found = keyed.join(listed.withColumn("__there", F.lit(True)), "__pk", "left")
    opened = read_rasters(found.withColumn("__file", F.when(F.col("__there"), F.col("path"))), decoder, "__file")
    return opened.withColumn("error", F.when(F.col("__there"), F.col("error")).otherwise(F.lit("missing_band"))).select(
        *manifest.columns, "height", "width", "pixels", "dtype", "error")


def assemble_patch(bands: DataFrame, band_names: Sequence[str], id_col: str = "patch_id",
                   value: str | Column = "pixels", keep: Sequence[str] = ()) -> DataFrame:
    """All bands of a patch on one row, one column per band name.

    ``max`` picks a deterministic value when a (patch, band) pair repeats; a
    missing band is NULL (see ``complete``).  Partial aggregation keeps a
    repeated patch from gathering all its rows in one task before the combine.
    """
    val = F.col(value) if isinstance(value, str) else value
    # keep columns are functions of the id (e.g. split), so grouping by them too is exact
    return (bands.groupBy(id_col, *keep)
            .pivot("band", list(band_names))
            .agg(F.max(val)))


def complete(band_names: Sequence[str]) -> Column:
    """All band columns are present."""
    cond = F.lit(True)
    for b in band_names:
        cond = cond & F.col(f"`{b}`").isNotNull()
    return cond


def code_lookup(df: DataFrame, code_col: str, out: str = "idx",
                codes: Sequence[int] = schemas.CLASS_CODES,
                lut_size: int = schemas.LUT_SIZE) -> DataFrame:
    """Relational form of P10: ``code -> idx`` via a broadcast join of the class table.

    Unlisted codes below ``lut_size`` map to 0; codes outside ``[0, lut_size)``
    get ``idx`` NULL and ``status = 'code_out_of_range'``.  The class table has
    ``len(codes)`` rows, a fixed bound, so the broadcast is safe at any scale.
    """
    spark = df.sparkSession
    lut = spark.createDataFrame([(int(c), i) for i, c in enumerate(codes)], f"__code int, {out} int")
    in_range = (F.col(code_col) >= 0) & (F.col(code_col) < lut_size)
    return (df.join(F.broadcast(lut), F.col(code_col) == F.col("__code"), "left")
            .withColumn(out, F.when(in_range, F.coalesce(F.col(out), F.lit(0))))
            .withColumn("status", F.when(in_range, F.lit("ok")).otherwise(F.lit("code_out_of_range")))
            .drop("__code"))


#: An ``error`` that marks an absent band; any other is a decoding error.
MISSING_PATTERN = "^missing"


def stage_tensors(patches: DataFrame, image_bands: Sequence[str] = schemas.IMAGE_BANDS,
                  label_band: str = schemas.REFERENCE_BAND, pad_to: tuple[int, int] | None = None,
                  keep: Sequence[str] = ("split",)) -> DataFrame:
    """Check, pad, stack and remap one row per patch; failures get a ``reason``.

    ``patches`` has one struct column per band (``height, width, pixels`` and
    optionally ``error``) as built by ``assemble_patch``.  The result has
    ``patch_id, *keep, reason, detail, height, width, image, label``; rows with
    ``reason`` NULL are good samples (see ``split_staged``).
    """
    bands = list(image_bands) + [label_band]
    kept = [k for k in keep if k in patches.columns]
    df = patches

    def b(name: str) -> Column:
        return F.col(f"`{name}`")

    has_error = "error" in patches.schema[bands[0]].dataType.fieldNames() \
        if bands[0] in patches.columns else False

    def failed(name: str) -> Column:
        return b(name)["error"].isNotNull() if has_error else F.lit(False)

    if pad_to is not None:
        th, tw = pad_to
        padded = {}
        for name in bands:
            c = b(name)
            h, w = A.padded_shape(c["height"], c["width"], th, tw)
            fields = [h.alias("height"), w.alias("width"),
                      A.pad_to_size(c["pixels"], c["height"], c["width"], th, tw).alias("pixels")]
            fields += [c[k].alias(k) for k in ("dtype", "error") if k in patches.schema[name].dataType.fieldNames()]
            padded[name] = F.when(c.isNotNull(), F.struct(*fields))
        df = df.withColumns(padded)
    first = b(image_bands[0])
    same_shape = F.lit(True)
    for name in bands:
        c = b(name)
        same_shape = same_shape & (c["height"] == first["height"]) & (c["width"] == first["width"]) \
            & A.shape_ok(c["pixels"], c["height"], c["width"])
    label_idx = A.remap_classes(b(label_band)["pixels"])
    # pixels are float32 here; the type that a band's file had is a column of its own
    typed = label_band in patches.columns and "dtype" in patches.schema[label_band].dataType.fieldNames()
    integer = b(label_band)["dtype"].rlike("^u?int") if typed else F.lit(True)
    absent = F.filter(F.array(*[F.when(b(n).isNull() | (failed(n) & b(n)["error"].rlike(MISSING_PATTERN)
                                                        if has_error else b(n).isNull()), F.lit(n))
                                for n in bands]), lambda x: x.isNotNull())
    broken = F.filter(F.array(*[F.when(failed(n) & ~b(n)["error"].rlike(MISSING_PATTERN),
                                       F.concat(F.lit(n + ": "), b(n)["error"]))
                                if has_error else F.lit(None).cast("string") for n in bands]),
                      lambda x: x.isNotNull())
    reason = (F.when(F.size(broken) > 0, F.lit("decode_error"))
              .when(F.size(absent) > 0, F.lit("missing_band"))
              .when(~F.coalesce(same_shape, F.lit(False)), F.lit("shape_mismatch"))
              .when(~integer | A.has_fraction(b(label_band)["pixels"]), F.lit("bad_dtype"))
              .when(A.has_null(label_idx), F.lit("code_out_of_range")))
    detail = (F.when(F.size(broken) > 0, F.array_join(broken, "; "))
              .when(F.size(absent) > 0, F.array_join(absent, ","))
              .when(F.coalesce(same_shape, F.lit(False)) & ~integer,
                    F.concat(F.lit(f"{label_band}: "), b(label_band)["dtype"]) if typed else F.lit(None).cast("string")))
    return df.select(
        "patch_id", *kept, reason.alias("reason"), detail.alias("detail"),
        first["height"].alias("height"), first["width"].alias("width"),
        A.stack_bands(*[b(n)["pixels"] for n in image_bands]).alias("image"),
        label_idx.alias("label"),
        F.lit(len(image_bands)).alias("channels"))


def split_staged(staged: DataFrame, keep: Sequence[str] = ("split",)) -> tuple[DataFrame, DataFrame]:
    """``(samples, rejects)`` from a staged frame; samples follow ``schemas.SAMPLES_SCHEMA``."""
    kept = [k for k in keep if k in staged.columns]
    samples = (staged.where(F.col("reason").isNull())
               .select("patch_id",
                       A.cast_items("image", "float").alias("image"),
                       A.cast_items("label", "int").alias("label"),
                       "height", "width", "channels", *kept))
    rejects = staged.where(F.col("reason").isNotNull()).select("patch_id", "reason", "detail")
    return samples, rejects


def to_tensors(patches: DataFrame, image_bands: Sequence[str] = schemas.IMAGE_BANDS,
               label_band: str = schemas.REFERENCE_BAND, pad_to: tuple[int, int] | None = None,
               keep: Sequence[str] = ("split",)) -> tuple[DataFrame, DataFrame]:
    """Stage and split in one call: ``(samples, rejects)``."""
    return split_staged(stage_tensors(patches, image_bands, label_band, pad_to, keep), keep)
