"""Metadata -> optional exact sample -> component validation -> summary report.

Instead of three list calls per patch, the folders the metadata points at are
listed page by page in the tasks (``sources.listing.list_frontier``), and the component
prefixes are merged with the listed paths (J1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterprep.operators import inventory as INV
from rasterprep.operators import sampling as S
from rasterprep.sinks import writers as W
from rasterprep.sources import listing as L


def check(meta: DataFrame, inventory: DataFrame, fraction: float = 1.0,
          id_col: str = "patch_id",
          schemes: tuple[str, ...] = ("s3",)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lazy C8: ``(validation rows, summary row, missing rows)``.

    Sampling is stratified by ``split`` when the column exists (M1), else one
    stratum (M2); ``fraction`` must be in (0, 1] (X11).
    """
    S.check_fraction(fraction)
    if fraction < 1.0:
        meta = S.sample_stratified(meta, fraction, id_col,
                                   strata=["split"] if "split" in meta.columns else None)
    validation = INV.validate_components(meta, inventory, id_col=id_col, schemes=schemes)
    return validation, INV.validation_summary(validation, fraction), INV.missing_components(validation)


def listing_prefixes(meta: DataFrame, components: tuple[str, ...] = ("s1_path", "s2_path", "reference_path"),
                     level: int = 1) -> DataFrame:
    """Distinct folders to list: each component folder cut back by ``level`` parts.

    ``level=1`` lists the tile folders that hold the patch folders (few list
    calls per thousand objects); ``level=0`` lists the patch folders themselves
    (the source's per-patch checks, best for tiny samples).
    """
    cols = [F.col(c) for c in components]
    folders = meta.select(F.explode(F.array(*cols)).alias("f")).where(F.col("f").isNotNull())
    cut = F.regexp_replace("f", r"/+$", "")
    for _ in range(level):
        cut = F.regexp_replace(cut, r"/[^/]*$", "")
    return folders.select(cut.alias("prefix")).distinct()


def check_files(spark: SparkSession, meta: DataFrame, out: str, fraction: float = 1.0,
                level: int = 1, schemes: tuple[str, ...] = ("s3",),
                page_size: int = L.PAGE_SIZE, reader: L.PageReader = L.read_page) -> None:
    """Run C8 and write the report to ``out``.

    Objects are listed below the folders the (sampled) metadata points at, in rounds of pages
    of ``page_size`` names that ``reader`` reads; the rounds stay in ``{out}/listing``.
    """
    S.check_fraction(fraction)
    if fraction < 1.0:
        meta = S.sample_stratified(meta, fraction, "patch_id",
                                   strata=["split"] if "split" in meta.columns else None)
    inventory = L.list_frontier(listing_prefixes(meta, level=level), f"{out.rstrip('/')}/listing",
                                page_size=page_size, reader=reader).select("path").distinct()
    _, summary, missing = check(meta, inventory, 1.0, schemes=schemes)
    summary = summary.withColumn("fraction_used", F.lit(float(fraction)))
    W.write_validation_report(summary, missing, out)
