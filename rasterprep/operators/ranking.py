"""Exact ranks by a hashed key, without a one-task window per stratum.

A plain ``row_number().over(Window.partitionBy(stratum).orderBy(key))`` sorts a
whole stratum in one task; with three splits that is a third of the table in
one task.  Here the key is an md5 hex digest, so its leading ``digits`` hex
characters split every stratum into ``16**digits`` buckets of near-equal size:

1. count rows per (stratum, bucket) -- partial aggregation, output bounded by
   ``strata x 16**digits`` rows whatever the table size;
2. prefix-sum the counts inside each stratum (a window over that small table);
3. rank rows inside their bucket only (windows of about ``n / 16**digits`` rows)
   and add the bucket's offset.

Sampling (``bucket_sample``) drops the buckets that lie wholly outside the
sample before rows are ranked; AQE broadcasts the small bucket table when its
measured size allows.  A NULL id is a value like any other: it hashes as
``NULL_MARK`` and sorts first among ties.
The result equals ``row_number() over (partition by strata order by key, tie)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_DIGITS = 3          # 4,096 buckets per stratum (~24k rows each at 10^8 rows)
NULL_MARK = "\\N"           # stands for NULL in a hash key

_KEY = "__rank_key"
_BUCKET = "__rank_bucket"
_CNT = "__rank_cnt"
_START = "__rank_start"
_TOTAL = "__rank_total"
_TAKE = "__rank_take"
_RN = "__rank_rn"


def hash_key(seed: str | int | Column, *parts: Column | str) -> Column:
    """md5 hex of ``'{seed}:{part1}:...'``, the deterministic sort key of sampling and shuffling."""
    pieces: list[Column] = [seed if isinstance(seed, Column) else F.lit(str(seed))]
    for p in parts:
        pieces.append(F.lit(":"))
        text = (F.col(p) if isinstance(p, str) else p).cast("string")
        pieces.append(F.coalesce(text, F.lit(NULL_MARK)))
    return F.md5(F.concat(*pieces))


def _bucket_table(keyed: DataFrame, strata: Sequence[str]) -> DataFrame:
    counts = keyed.groupBy(*strata, _BUCKET).agg(F.count(F.lit(1)).alias(_CNT))
    w = (Window.partitionBy(*strata) if strata else Window.partitionBy()).orderBy(_BUCKET)
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts
            .withColumn(_START, F.sum(_CNT).over(cum) - F.col(_CNT))
            .withColumn(_TOTAL, F.sum(_CNT).over(
                Window.partitionBy(*strata) if strata else Window.partitionBy())))


def bucket_sample(df: DataFrame, key: Column, take: Column | None, strata: Sequence[str] = (),
                  tiebreak: Sequence[str] = (), digits: int = DEFAULT_DIGITS) -> DataFrame:
    """Keep the first ``take`` rows of every stratum in ``(key, *tiebreak)`` order.

    ``take`` is a Column over the stratum size ``n`` (exposed as column
    ``__rank_total``), e.g. ``F.bround(F.col('__rank_total') * 0.1)``.  Rows whose
    stratum value is NULL are dropped (grouping by a missing split yields no stratum).
    """
    strata = list(strata)
    keyed = df.withColumn(_KEY, key).withColumn(_BUCKET, F.substring(_KEY, 1, digits))
    for s in strata:
        keyed = keyed.where(F.col(s).isNotNull())
    plan = (_bucket_table(keyed, strata)
            .withColumn(_TAKE, take)
            .where(F.col(_START) < F.col(_TAKE))
            .select(*strata, _BUCKET, _START, _CNT, _TAKE))
    # one pass after the count: the join keeps only rows of buckets that reach into the
    # sample; only those rows (about the sample's size) are ranked inside their bucket
    joined = keyed.join(plan, on=[*strata, _BUCKET], how="inner")
    w = Window.partitionBy(*strata, _BUCKET).orderBy(F.col(_KEY), *[F.col(t) for t in tiebreak])
    return (joined.withColumn(_RN, F.row_number().over(w))
            .where(F.col(_START) + F.col(_RN) <= F.col(_TAKE))
            .select(*df.columns))


def bucket_rank(df: DataFrame, key: Column, strata: Sequence[str] = (),
                tiebreak: Sequence[str] = (), out: str = "pos",
                digits: int = DEFAULT_DIGITS, total_col: str | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside its stratum in ``(key, *tiebreak)`` order.

    The table is shuffled once, by (stratum, bucket), which spreads even a hot
    stratum over ``16**digits`` window groups.  The small bucket table joins on
    the same keys, so the big side is not shuffled again.  ``total_col`` also
    returns the stratum size.  Rows with a NULL stratum value are dropped.
    """
    strata = list(strata)
    keyed = df.withColumn(_KEY, key).withColumn(_BUCKET, F.substring(_KEY, 1, digits))
    for s in strata:
        keyed = keyed.where(F.col(s).isNotNull())
    offsets = _bucket_table(keyed, strata).select(*strata, _BUCKET, _START, _TOTAL)
    w = Window.partitionBy(*strata, _BUCKET).orderBy(F.col(_KEY), *[F.col(t) for t in tiebreak])
    ranked = keyed.withColumn(_RN, F.row_number().over(w))
    joined = ranked.join(offsets, on=[*strata, _BUCKET], how="inner")
    res = joined.withColumn(out, (F.col(_START) + F.col(_RN) - 1).cast("long"))
    extra = [out]
    if total_col:
        res = res.withColumn(total_col, F.col(_TOTAL))
        extra.append(total_col)
    return res.select(*df.columns, *extra)


# --- order-preserving index ---------------------------------------------------------------

#: Values that cut the order of :func:`ordered_index` into ranges.
RANGE_CUTS = 255


def range_cuts(df: DataFrame, col: str, cuts: int = RANGE_CUTS) -> list:
    """At most ``cuts`` values of ``col`` in ascending order, chosen by a hash, so that they cut
    distinct values into ranges of like numbers.  They are all that reaches the driver."""
    picked = df.select(col).where(F.col(col).isNotNull()).orderBy(F.xxhash64(col), col).limit(cuts)
    return sorted({r[0] for r in picked.collect()})


def range_of(c: Column | str, marks: Sequence, kind) -> Column:
    """The number of ``marks`` (ascending) that are at most ``c``: the range that it falls into.

    The marks are literals, looked up in two steps of about their square root.
    """
    col = F.col(c) if isinstance(c, str) else c
    if not marks:
        return F.lit(0)
    width = max(1, int(len(marks) ** 0.5))
    groups = [marks[lo:lo + width] for lo in range(0, len(marks), width)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda m: m <= col))

    heads = F.array(*[F.lit(g[0]).cast(kind) for g in groups])
    tails = F.array(*[F.array(*[F.lit(m).cast(kind) for m in g]) for g in groups])
    at = below(heads)
    return F.when(at > 0, (at - 1) * width + below(F.get(tails, at - 1))).otherwise(F.lit(0))


def ordered_index(df: DataFrame, col: str, out: str = "idx", sums: Sequence[str] = (),
                  cuts: int = RANGE_CUTS) -> DataFrame:
    """Add ``out``, the 0-based position of each row in the order of ``col`` (unique, not null),
    and for every column of ``sums`` the sum ``<column>_before`` over the rows before.

    Rows are dealt over ranges of ``col`` and ranked within their range; the counts (and
    sums) of earlier ranges are added by a join with a table of ``cuts`` + 1 rows.  So no task
    sorts the whole column, whatever the number of values.  Only the choice of the cuts runs
    at once.
    """
    marks = range_cuts(df, col, cuts)
    kind = df.schema[col].dataType
    dealt = df.withColumn(_BUCKET, range_of(col, marks, kind))
    per = dealt.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_CNT), *[F.sum(s).alias(f"__sum_{s}") for s in sums])
    # every range gives its numbers to all later ones: at most (cuts + 1)**2 / 2 small rows
    later = per.where(F.col(_BUCKET) < len(marks)).withColumn(
        _BUCKET, F.explode(F.sequence(F.col(_BUCKET) + 1, F.lit(len(marks)))))
    start = later.groupBy(_BUCKET).agg(F.sum(_CNT).alias(_START), *[F.sum(f"__sum_{s}").alias(f"__sum_{s}") for s in sums])
    order = Window.partitionBy(_BUCKET).orderBy(col)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn(_RN, F.row_number().over(order)).withColumns(
        {f"{s}_before": F.coalesce(F.sum(s).over(before), F.lit(0)) for s in sums})
    found = ranked.join(start, _BUCKET, "left")
    return found.select(
        *df.columns, (F.coalesce(_START, F.lit(0)) + F.col(_RN) - 1).cast("long").alias(out),
        *[(F.col(f"{s}_before") + F.coalesce(f"__sum_{s}", F.lit(0))).alias(f"{s}_before") for s in sums])
