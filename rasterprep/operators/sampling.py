"""Exact, repeatable sampling and dataset splits.

Each stratum keeps exactly ``round_half_even(n * fraction)`` rows, the rows
with the smallest ``md5('{seed}:{id}')`` (ties by id).  That fixes the sample
size like a without-replacement draw, is independent of partitioning and task
retries, and equals this SQL::

    row_number() over (partition by split order by md5(concat('42:', id)), id)
        <= round_half_even(count(*) over (partition by split) * fraction)

Bernoulli sampling (``sampleBy``) only matches the fraction on average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.operators.ranking import _TOTAL, DEFAULT_DIGITS, bucket_sample, hash_key


def check_fraction(fraction: float, allow_above_one: bool = False) -> float:
    """X11: 0 < fraction <= 1 (the converter also accepts >= 1 as "all rows")."""
    f = float(fraction)
    if f <= 0 or (f > 1 and not allow_above_one):
        raise ValueError(f"fraction must be in (0, 1], got {fraction}")
    return f


def sample_size(n: Column, fraction: float) -> Column:
    """Rows kept from a stratum of ``n`` rows: half-even ``n * fraction``."""
    return F.bround(n.cast("double") * F.lit(float(fraction)), 0).cast("long")


def sample_stratified(df: DataFrame, fraction: float, id_col: str | Sequence[str],
                      strata: Sequence[str] | str | None = ("split",),
                      seed: int = schemas.SAMPLE_SEED, digits: int = DEFAULT_DIGITS) -> DataFrame:
    """M1: exactly ``round(n * fraction)`` rows per stratum; ``fraction >= 1`` returns ``df``.

    With ``strata`` empty/None this is M2 (one stratum: the whole table); a stratum column
    that ``df`` lacks raises.
    ``id_col`` names the column(s) identifying a row.  Rows sharing all of them
    tie and share a hash bucket; when an id can repeat massively (copies of one
    patch), add a row-unique column such as a path so copies spread over buckets.
    """
    if float(fraction) >= 1.0:
        return df
    check_fraction(fraction)
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    if isinstance(strata, str):
        strata = [strata]
    strata = list(strata or [])
    absent = [s for s in strata if s not in df.columns]
    if absent:
        raise ValueError(f"strata columns {absent} are not in the table; pass strata=None for one stratum")
    return bucket_sample(df, hash_key(seed, *ids), sample_size(F.col(_TOTAL), fraction),
                         strata=strata, tiebreak=ids, digits=digits)


def sample_random(df: DataFrame, fraction: float, id_col: str | Sequence[str],
                  seed: int = schemas.SAMPLE_SEED) -> DataFrame:
    """M2: exact-size sample of the whole table (used when there is no split column)."""
    return sample_stratified(df, fraction, id_col, strata=None, seed=seed)


def split_filter(df: DataFrame, splits: Sequence[str] = tuple(schemas.SPLITS),
                 col: str = "split") -> DataFrame:
    """Keep the known splits only; other values (and NULL) are dropped."""
    return df.where(F.col(col).isin(list(splits)))


def split_dataset(df: DataFrame, fraction: float, id_col: str | Sequence[str] = "patch_id",
                  splits: Sequence[str] = tuple(schemas.SPLITS), col: str = "split",
                  seed: int = schemas.SAMPLE_SEED, digits: int = DEFAULT_DIGITS) -> DataFrame:
    """M3: known splits only, then an exact per-split sample; one frame with ``split`` kept."""
    kept = split_filter(df, splits, col)
    return sample_stratified(kept, fraction, id_col, strata=[col], seed=seed, digits=digits)


def split_counts(df: DataFrame, col: str = "split", total_label: str = "total") -> DataFrame:
    """A2: rows per split plus a total row (``rollup``), as ``(split, rows)``."""
    return (df.rollup(col).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.coalesce(F.col(col), F.lit(total_label)).alias(col), "rows"))


def head(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """O3: first ``n`` rows in an explicit order (a top-k, planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)
