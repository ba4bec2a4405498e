"""Training-feed planning: epochs, shuffle, batches, shards.

The loader's order is planned as a table ``(epoch, pos, batch, shard, ...)``
instead of living inside a reader.  The shuffle is a *global* permutation by
``md5('{seed}:{epoch}:{id}')`` (stronger than a 2,000-element buffer), and
positions come from ``ranking.bucket_rank``: the table is shuffled once by
(epoch, hash bucket), never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterprep.operators.ranking import DEFAULT_DIGITS, bucket_rank, hash_key


def repeat_epochs(df: DataFrame, epochs: int, col: str = "epoch") -> DataFrame:
    """``epochs`` copies of every row tagged 0..epochs-1 (a generator, not a join)."""
    if epochs < 1:
        raise ValueError("epochs must be >= 1")
    return df.withColumn(col, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))))


def epoch_shuffle(df: DataFrame, id_col: str | Sequence[str], seed: int = 42,
                  epoch_col: str | None = "epoch", out: str = "pos",
                  digits: int = DEFAULT_DIGITS) -> DataFrame:
    """``pos`` = 0-based position in the epoch's shuffled order.

    Equals ``row_number() over (partition by epoch order by md5(seed:epoch:id), id) - 1``.
    ``id_col`` may list several columns (see ``sampling.sample_stratified`` on copies).
    """
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    if epoch_col:
        key = hash_key(seed, epoch_col, *ids)
        strata = [epoch_col]
    else:
        key = hash_key(seed, *ids)
        strata = []
    return bucket_rank(df, key, strata=strata, tiebreak=ids, out=out, total_col="__n", digits=digits)


def assign_batches(df: DataFrame, batch_size: int, pos_col: str = "pos", total_col: str = "__n",
                   out: str = "batch", drop_remainder: bool = True) -> DataFrame:
    """``batch = pos div batch_size``; the incomplete last batch is dropped by default."""
    b = F.lit(int(batch_size))
    res = df.withColumn(out, (F.col(pos_col) / b).cast("long"))
    if drop_remainder:
        res = res.where(F.col(out) < (F.col(total_col) / b).cast("long"))
    return res


def assign_shards(df: DataFrame, replicas: int, pos_col: str = "pos", out: str = "shard") -> DataFrame:
    """element-wise data sharding, ``shard = pos mod replicas``."""
    return df.withColumn(out, F.pmod(F.col(pos_col), F.lit(int(replicas))))


def steps_per_epoch(samples: Column, global_batch: Column | int, fallback: int) -> Column:
    """``ceil(samples / global_batch)``; ``fallback`` when samples is NULL or 0."""
    gb = F.lit(global_batch) if isinstance(global_batch, int) else global_batch
    return F.when(F.coalesce(samples, F.lit(0)) > 0, F.ceil(samples / gb)).otherwise(F.lit(fallback))


def global_batch(per_replica: Column | int, replicas: Column | int) -> Column:
    """Per-replica batch x replicas."""
    a = F.lit(per_replica) if isinstance(per_replica, int) else per_replica
    b = F.lit(replicas) if isinstance(replicas, int) else replicas
    return a * b


def scaled_lr(lr: float, gpus: Column, enabled: bool = True) -> Column:
    """Learning rate x GPUs when scaling is enabled and a GPU count is given."""
    base = F.lit(float(lr))
    if not enabled:
        return base
    return F.when(gpus.isNotNull(), base * gpus).otherwise(base)


def dataset_sizes(samples: DataFrame, split_col: str = "split") -> DataFrame:
    """Samples per split counted from the written table (Parquet footers, no profile needed)."""
    return samples.groupBy(split_col).agg(F.count(F.lit(1)).alias("samples"))


def profile_sizes(profiles: DataFrame, splits: Sequence[str] = ("train", "validation", "test"),
                  split_col: str = "split") -> DataFrame:
    """S14, the other source: samples per split as the conversion profiles record them."""
    entries = F.array(*[F.struct(F.lit(s).alias(split_col), F.col(f"summary.{s}_samples").alias("samples"))
                        for s in splits])
    return profiles.select(F.inline(entries))


def check_sizes(samples: DataFrame, profiles: DataFrame, split_col: str = "split") -> DataFrame:
    """S14 cross-check: ``(split, samples, recorded, agrees)`` of the table and its profile."""
    recorded = profile_sizes(profiles, split_col=split_col).withColumnRenamed("samples", "recorded")
    return (recorded.join(dataset_sizes(samples, split_col), split_col, "left")
            .select(split_col, F.coalesce("samples", F.lit(0)).alias("samples"), "recorded")
            .withColumn("agrees", F.col("samples").eqNullSafe(F.col("recorded"))))


def plan_split(samples: DataFrame, id_col: str | Sequence[str], epochs: int, batch_size: int, replicas: int,
               shuffle: bool = True, seed: int = 42, digits: int = DEFAULT_DIGITS) -> DataFrame:
    """C9 for one split: epochs -> (shuffle) -> batches -> shards as one planned table.

    Evaluation splits are planned with ``shuffle=False``: one pass in a fixed
    hashed order keeping the last partial batch, so every sample is read once.
    """
    if shuffle:
        df = repeat_epochs(samples, epochs)
        df = epoch_shuffle(df, id_col, seed=seed, digits=digits)
        df = assign_batches(df, batch_size)
    else:
        # one pass; a fixed hashed order (epoch-independent) keeps the ranking distributed
        ids = [id_col] if isinstance(id_col, str) else list(id_col)
        df = samples.withColumn("epoch", F.lit(0).cast("long"))
        df = bucket_rank(df, hash_key(seed, *ids), strata=[], tiebreak=ids, out="pos",
                         total_col="__n", digits=digits)
        df = assign_batches(df, batch_size, drop_remainder=False)
    return assign_shards(df, replicas).drop("__n")
