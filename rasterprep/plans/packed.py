"""The full-band packed dataset: ``patch_id, s1, s2, reference, labels`` as raw bytes.

Two radar bands and all twelve optical bands are padded to one size and stacked per
sensor, the reference map is remapped, the label list becomes a 0/1 vector.  A patch
that cannot be packed goes to the rejects with its reason, also one with a label
outside the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.operators import labels as LB
from rasterprep.operators import tensors as TZ
from rasterprep.sinks import writers as W
from rasterprep.sources import objects as O

GROUPS = {"s1": tuple(schemas.S1_BANDS), "s2": tuple(schemas.S2_BANDS_ALL)}


def packed_patches(meta: DataFrame, vocab: DataFrame, decoder: O.Decoder = O.npy_decoder,
                   suffix: str = schemas.RASTER_SUFFIX,
                   pad_to: tuple[int, int] | None = (schemas.PATCH_HEIGHT, schemas.PATCH_WIDTH),
                   partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(packed rows, rejects)`` of metadata with paths, ``labels`` and a row-unique ``sample_id``.

    Both come from one lazy staging; write it first where both are needed.
    """
    hot = LB.with_multi_hot(meta, vocab, "sample_id")
    hot = W.to_bytes(hot.select(*[c for c in meta.columns if c != "labels"], F.col("multi_hot").alias("labels")),
                     {"labels": "i1"}, on_overflow="null")
    rows = hot.repartition(int(partitions)) if partitions else hot
    staged = TZ.read_patches(rows, decoder, GROUPS, suffix=suffix, pad_to=pad_to, keep=("split", "labels"))
    reason = F.coalesce("reason", F.when(F.col("labels").isNull(), F.lit("unknown_label")))
    staged = staged.withColumn("reason", reason)
    keep = [c for c in ("sample_id", "patch_id", "s1", "s2", "label", "labels", "split") if c in staged.columns]
    packed = staged.where(F.col("reason").isNull()).select(*keep).withColumnRenamed("label", "reference")
    return packed, staged.where(F.col("reason").isNotNull()).select("sample_id", "patch_id", "reason", "detail")
