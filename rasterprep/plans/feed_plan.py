"""The data side of training -- splits exist -> sizes -> steps -> planned feeds.

Output is one table per split with ``(epoch, pos, batch, shard, patch_id)``
ready to be joined to the samples (or read in that order by a loader).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.operators import feed as FD
from rasterprep.operators import inventory as INV
from rasterprep.operators.ranking import DEFAULT_DIGITS


def feed_plan(samples: DataFrame, epochs: int = 10, batch_per_replica: int = 16,
              replicas: int = 1, seed: int = 42, id_col: str | list[str] = "patch_id",
              digits: int = DEFAULT_DIGITS) -> dict[str, DataFrame]:
    """Plan tables keyed by split; raises when a split is missing.

    ``id_col`` may list several columns; where one patch is copied into a large share of the
    rows, include the data's row-unique ``sample_id`` so that the copies spread over buckets.

    Train is shuffled per epoch and batched with the remainder dropped;
    validation and test are planned as a single pass that keeps every sample.
    """
    INV.assert_splits_exist(samples, schemas.SPLITS)
    gb = batch_per_replica * replicas
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    keys = samples.select(*ids, "split")
    plans = {}
    for sp in schemas.SPLITS:
        part = keys.where(F.col("split") == sp).drop("split")
        plans[sp] = FD.plan_split(part, ids, epochs, gb, replicas, shuffle=(sp == "train"),
                                  seed=seed, digits=digits)
    return plans


def steps_table(samples: DataFrame, batch_per_replica: int = 16, replicas: int = 1) -> DataFrame:
    """S14 + P29: ``(split, samples, steps, samples_per_epoch)`` from the written table."""
    gb = batch_per_replica * replicas
    fallback = F.when(F.col("split") == "train", F.lit(30)).otherwise(F.lit(10))
    sizes = FD.dataset_sizes(samples)
    steps = F.when(F.col("samples") > 0, F.ceil(F.col("samples") / F.lit(gb))).otherwise(fallback)
    return sizes.select("split", "samples", steps.cast("long").alias("steps"),
                        (steps * F.lit(gb)).cast("long").alias("samples_per_epoch"))
