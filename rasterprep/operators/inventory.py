"""Inventory validation: do the component folders of each patch hold any object?

The source checks every patch with three list calls against the object store.
Here the store is listed once (``sources.listing``) and the distinct component prefixes
are merged with the object paths in sorted ranges: a prefix exists if the first path at or
after it starts with it.  Each object is shuffled once, as it is, whatever the depth of its
path (J1, J2, A1, X12, A7).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterprep.functions import paths as P
from rasterprep.operators.ranking import range_cuts, range_of

DEFAULT_COMPONENTS = {"s1": "s1_path", "s2": "s2_path", "ref": "reference_path"}


def folder_key(c: Column | str) -> Column:
    """Normalised folder key: any ``scheme:`` prefix and leading/trailing slashes removed.

    ``s3://b/k``, ``s3a://b/k/``, ``file:///b/k`` and ``/b/k`` all give ``b/k``.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(col, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?/*|/+$", "")


def existing_prefixes(prefixes: DataFrame, inventory: DataFrame, path_col: str = "path",
                      ranges: int | None = None) -> DataFrame:
    """The distinct ``folder`` keys of ``prefixes`` below which some object lies.

    Prefixes (closed by "/") and object paths go into one sorted order, cut into ``ranges``
    (default: the session's shuffle partitions); a running window carries each path back to
    the prefixes before it.  The cuts are object paths themselves, so where a range has no
    path after a prefix, the next range's cut is the first one.  Choosing the cuts reads
    the paths once more, and is all that runs at once; the result is lazy.
    """
    spark = inventory.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    objects = inventory.select(folder_key(path_col).alias("key")).where("key IS NOT NULL")
    marks = range_cuts(objects, "key", max(1, n - 1))
    asked = prefixes.select("folder").where("folder IS NOT NULL").distinct().select(
        F.concat("folder", F.lit("/")).alias("key"), F.col("folder"))
    both = objects.select("key", F.lit(None).cast("string").alias("folder")).unionByName(asked)
    # descending, so that the frame that carries the last path seen only grows
    order = Window.partitionBy("range").orderBy(F.col("key").desc())
    seen = F.last(F.when(F.col("folder").isNull(), F.col("key")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = F.get(F.array(*[F.lit(m) for m in marks]), F.col("range")) if marks else F.lit(None).cast("string")
    return (both.withColumn("range", range_of("key", marks, "string"))
            .withColumn("first", F.coalesce(seen, following))
            .where(F.col("folder").isNotNull() & F.startswith("first", "key"))
            .select("folder"))


def validate_components(meta: DataFrame, inventory: DataFrame, id_col: str = "patch_id",
                        components: Mapping[str, str] = DEFAULT_COMPONENTS,
                        path_col: str = "path", schemes: tuple[str, ...] = ("s3",),
                        keep: Sequence[str] = ()) -> DataFrame:
    """One row per metadata row: ``(id, all_exist, <name>_exists..., *keep)``.

    A component exists when its path is a valid URI (X3: by default ``s3://``)
    and at least one inventory object lies under it.  Invalid paths count as
    missing, as a failed list call does in the source.

    A row without a valid path gets a salted key that no folder has, so invalid rows spread
    over all partitions of the joins.  The table of existing prefixes (see
    :func:`existing_prefixes`) is the *same* DataFrame on the right of every component join,
    so Spark builds it once and reuses the exchange.
    """
    names = list(components)
    asked = meta.select(F.explode(F.array(*[
        F.when(P.valid_uri(components[n], schemes), folder_key(components[n])) for n in names])).alias("folder"))
    folders = existing_prefixes(asked, inventory, path_col)
    # folder keys have no leading slash, so this key matches none
    nowhere = F.concat(F.lit("/"), F.pmod(F.xxhash64(id_col), F.lit(1 << 20)).cast("string"))
    out = meta.select(id_col, *keep,
                      *[F.when(P.valid_uri(components[n], schemes), folder_key(components[n]))
                        .otherwise(nowhere).alias(f"__k_{n}") for n in names])
    flags = []
    for n in names:
        right = folders.alias(f"__f_{n}")
        hit = F.col(f"__f_{n}.folder")
        out = (out.join(right, F.col(f"__k_{n}") == hit, "left")
               .withColumn(f"{n}_exists", hit.isNotNull())
               .drop(hit))
        flags.append(f"{n}_exists")
    all_exist = F.lit(True)
    for f in flags:
        all_exist = all_exist & F.col(f)
    return out.select(id_col, all_exist.alias("all_exist"), *flags, *keep)


def missing_components(validation: DataFrame) -> DataFrame:
    """The rows with at least one missing component."""
    return validation.where(~F.col("all_exist"))


def missing_of(meta: DataFrame, inventory: DataFrame, path: str, id_col: str = "patch_id",
               path_col: str = "path") -> DataFrame:
    """J2, single component: metadata rows whose ``path`` folder holds no object (``left_anti``)."""
    keyed = meta.withColumn("__k", folder_key(path))
    folders = existing_prefixes(keyed.select(F.col("__k").alias("folder")), inventory, path_col)
    return (keyed
            .join(folders, F.col("__k") == F.col("folder"), "left_anti").drop("__k"))


def validation_summary(validation: DataFrame, fraction: float = 1.0) -> DataFrame:
    """A1: one row ``(all_files_found, not_found, total_checked, fraction_used)``.

    The list of missing patches is not nested into this row: it is unbounded,
    so it stays a table (``missing_components``) and is written beside the summary.
    """
    return validation.agg(
        F.count_if(F.col("all_exist")).alias("all_files_found"),
        F.count_if(~F.col("all_exist")).alias("not_found"),
        F.count(F.lit(1)).alias("total_checked"),
    ).withColumn("fraction_used", F.lit(float(fraction)))


def splits_missing(present: DataFrame, expected: Sequence[str], col: str = "split") -> DataFrame:
    """Expected split names with no row in ``present`` (non-empty result means failure)."""
    spark = present.sparkSession
    wanted = spark.createDataFrame([(s,) for s in expected], f"{col} string")
    have = present.select(col).where(F.col(col).isNotNull()).distinct()
    return wanted.join(have, col, "left_anti")


def assert_splits_exist(present: DataFrame, expected: Sequence[str], col: str = "split") -> None:
    """X12 as a guard: raise when any expected split is missing (fail early)."""
    missing = [r[0] for r in splits_missing(present, expected, col).collect()]
    if missing:
        raise FileNotFoundError(f"missing splits: {sorted(missing)}")


def row_count(df: DataFrame, name: str) -> DataFrame:
    """``(table_name, rows)`` as a one-row frame (stays lazy; no driver count)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
