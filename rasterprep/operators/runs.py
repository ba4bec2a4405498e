"""Run-profile analytics: records, filters, speedup, curves, grids (C1-C6, J7, J8, W4, W5, ...).

A profile is one JSON document per run (``sources.metadata.read_profiles``):
``steps`` is a short array of ``(name, duration, ...)`` structs and ``summary``
a struct of metrics.  Step lookups are array expressions on that row
(last duplicate wins), so parsing a run never shuffles.  Across runs, the
baseline of a speedup is joined per fraction; the baseline table has one row
per fraction and is checked for duplicates before use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterprep.functions import paths as P

CONVERSION_STEPS = ["read_metadata", "spark_init", "write_train", "write_validation", "write_test"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- per-profile expressions ------------------------------------------------------

def step(steps: Column | str, name: str) -> Column:
    """P25: the step struct named ``name``; the last duplicate wins; NULL when absent."""
    return F.try_element_at(F.filter(_col(steps), lambda s: s["name"] == F.lit(name)), F.lit(-1))


def step_duration(steps: Column | str, name: str) -> Column:
    return step(steps, name)["duration"]


def has_steps(steps: Column | str, names: Sequence[str]) -> Column:
    """Every step in ``names`` is present."""
    def named(n: str):
        return lambda s: s["name"] == F.lit(n)

    cond = F.lit(True)
    for n in names:
        cond = cond & F.exists(_col(steps), named(n))
    return F.coalesce(cond, F.lit(False))


def total_duration(steps: Column | str) -> Column:
    """A3: sum of all step durations (nested steps included, as the source records them)."""
    return F.aggregate(_col(steps), F.lit(0.0), lambda a, s: a + F.coalesce(s["duration"], F.lit(0.0)))


def top_level_duration(steps: Column | str) -> Column:
    """A3 without nested steps: a step counts unless it lies inside another one's time span."""
    def start(s):
        return F.unix_micros(F.try_to_timestamp(s["timestamp"])) / F.lit(1e6)

    every = _col(steps)
    top = F.filter(every, lambda s: ~F.exists(every, lambda o: (
        (start(o) <= start(s)) & (start(o) + o["duration"] >= start(s) + s["duration"])
        & (o["duration"] > s["duration"]))))
    return total_duration(top)


def object_key(path: Column | str) -> Column:
    """``scheme://bucket/key`` -> ``key``; a path without scheme is kept without leading slashes."""
    # a single regex: scheme + bucket, or a local ``file:`` / leading-slash prefix
    return F.regexp_replace(_col(path), r"^(?:file:/*|[A-Za-z][A-Za-z0-9+.\-]*://[^/]*/|/+)", "")


# --- record builders (C2-C5) ------------------------------------------------------

def conversion_runs(profiles: DataFrame, key_col: str = "key", min_fraction: float = 0.001) -> DataFrame:
    """``fraction, executor, total_time`` and the five conversion step durations.

    Fraction and executor come from the last ``frac_``/``exec_`` key parts (P22);
    runs without them or below ``min_fraction`` are dropped (X6); a missing
    required step drops the run (the source would fail on it).
    """
    df = profiles.select(
        P.run_fraction(key_col, last=True).alias("fraction"),
        P.run_executors(key_col, last=True).alias("executor"),
        F.col("summary.total_duration").alias("total_time"),
        *[step_duration("steps", s).alias(s) for s in CONVERSION_STEPS])
    df = df.where((F.col("fraction") >= min_fraction) & F.col("executor").isNotNull())
    return df.where(F.col("total_time").isNotNull() & required(CONVERSION_STEPS))


def required(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def conversion_runs_ext(profiles: DataFrame, key_col: str = "key", part_index: int = 6,
                        min_fraction: float = 0.001) -> DataFrame:
    """As C2 without executor (fraction from key part ``part_index``, X9), plus sample and
    partition counts per split; ``{split}_partitions`` falls back to ``{split}_rdd_partitions``."""
    parts = P.path_parts(key_col)
    frac = F.nullif(F.substring(F.get(parts, part_index), 6, 1 << 20), F.lit("")).try_cast("double")
    cols = [frac.alias("fraction"), F.col("summary.total_duration").alias("total_time"),
            *[step_duration("steps", s).alias(s) for s in CONVERSION_STEPS]]
    for sp in ("train", "validation", "test"):
        cols.append(F.col(f"summary.{sp}_samples").alias(f"{sp}_samples"))
    for sp in ("train", "validation", "test"):
        cols.append(F.coalesce(F.col(f"summary.{sp}_partitions"),
                               F.col(f"summary.{sp}_rdd_partitions")).alias(f"{sp}_partitions"))
    df = profiles.where(P.has_run_depth(key_col, part_index + 1, part_index)).select(*cols)
    return df.where((F.col("fraction") >= min_fraction) & F.col("total_time").isNotNull()
                    & required(CONVERSION_STEPS))


def exec_only(key: Column | str, executors: int = 8) -> Column:
    """The run was made with ``executors`` executors (a ``/exec_<n>/`` key part)."""
    return _col(key).contains(f"/exec_{executors}/")


def training_runs_batch(profiles: DataFrame, key_col: str = "key", executors: int = 8,
                        min_fraction: float = 0.001) -> DataFrame:
    """C4: runs under ``/exec_{executors}/`` (X7), fraction = first ``frac_`` part, GPUs from
    ``train_gpu<n>_profile.json`` (older ``train_<n>gpu`` accepted)."""
    df = profiles.where(exec_only(key_col, executors)).select(
        P.run_fraction(key_col, last=False).alias("fraction"),
        P.gpu_count_any(key_col).alias("num_gpus"),
        F.col("summary.global_batch_size").alias("batch_size"),
        F.col("summary.total_duration").alias("total_time"),
        step_duration("steps", "training").alias("train_time"),
        step_duration("steps", "evaluation").alias("test_time"),
        F.col("summary.test_accuracy").alias("test_accuracy"))
    return df.where((F.col("fraction") >= min_fraction) & F.col("num_gpus").isNotNull()
                    & F.col("train_time").isNotNull() & F.col("test_time").isNotNull())


def training_runs_lr(profiles: DataFrame, key_col: str = "key") -> DataFrame:
    """Fraction by ``frac_([0-9.]+)`` (P24), GPUs by ``gpu(\\d+)_profile.json``, both
    ``training`` and ``evaluation`` steps required (X8), no fraction floor; adds learning rate."""
    df = profiles.where(has_steps("steps", ["training", "evaluation"])).select(
        P.fraction_regex(key_col).alias("fraction"),
        P.gpu_count(key_col, P.GPU_FILE_PATTERN_LOOSE).alias("num_gpus"),
        F.col("summary.global_batch_size").alias("batch_size"),
        F.col("summary.learning_rate").alias("learning_rate"),
        F.col("summary.total_duration").alias("total_time"),
        step_duration("steps", "training").alias("train_time"),
        step_duration("steps", "evaluation").alias("test_time"),
        F.col("summary.test_accuracy").alias("test_accuracy"))
    return df.where(F.col("fraction").isNotNull() & F.col("num_gpus").isNotNull())


# --- relational "last value wins" (W4, A8) -----------------------------------------

def last_value(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
               out: str | None = None) -> DataFrame:
    """Per key, the value of the last row in ``order`` (``max_by`` on an ordering struct).

    Partially aggregated: a hot key is combined map-side, never gathered in one task.
    """
    ordering = F.struct(*[F.col(o) for o in order])
    return df.groupBy(*keys).agg(F.max_by(F.col(value), ordering).alias(out or value))


# --- across runs ------------------------------------------------------------------

def baseline_table(runs: DataFrame, baseline_col: str, baseline_value, time_col: str = "total_time",
                   key: str = "fraction") -> DataFrame:
    """J7 (build side): one baseline time per ``key``; a duplicate baseline raises at run time."""
    base = (runs.where(F.col(baseline_col) == F.lit(baseline_value))
            .groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.max(time_col).alias("__base")))
    return base.select(key, F.when(F.col("__n") == 1, F.col("__base"))
                       .otherwise(F.raise_error(F.concat(F.lit("duplicate baseline for "),
                                                         F.col(key).cast("string"))))
                       .cast("double").alias("__base"))


def speedup(runs: DataFrame, baseline_col: str, baseline_value, time_col: str = "total_time",
            key: str = "fraction", out: str = "speedup") -> DataFrame:
    """``baseline_time(key) / time``; NULL without a baseline or for a zero time.

    The baseline side has one row per key (aggregated), so the join never
    multiplies rows; AQE broadcasts it when it is small.
    """
    base = baseline_table(runs, baseline_col, baseline_value, time_col, key)
    return (runs.join(base, key, "left")
            .withColumn(out, F.try_divide(F.col("__base"), F.col(time_col).cast("double")))
            .drop("__base"))


def speedup_window(runs: DataFrame, baseline_col: str, baseline_value, time_col: str = "total_time",
                   key: str = "fraction", out: str = "speedup") -> DataFrame:
    """The same speedup without a join: baseline time as a windowed ``max`` per key; a
    duplicate baseline raises, as in ``speedup``."""
    w = Window.partitionBy(key)
    is_base = F.col(baseline_col) == F.lit(baseline_value)
    base = F.max(F.when(is_base, F.col(time_col))).over(w)
    checked = F.when(F.count_if(is_base).over(w) <= 1, base).otherwise(F.raise_error(
        F.concat(F.lit("duplicate baseline for "), F.col(key).cast("string"))))
    return runs.withColumn(out, F.try_divide(checked.cast("double"), F.col(time_col).cast("double")))


def curve_points(runs: DataFrame, x: str, y: str, key: str = "fraction") -> DataFrame:
    """A5: points of each curve numbered along x: ``(key, point, x, y)`` (one row per point)."""
    w = Window.partitionBy(key).orderBy(F.col(x), F.col(y))
    return runs.select(key, F.row_number().over(w).cast("long").alias("point"), x, y)


def group_curves(runs: DataFrame, x: str, y: str, key: str = "fraction") -> DataFrame:
    """A5 nested form: one row per curve with its points sorted by x (curves are small)."""
    return runs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(x), F.col(y)))).alias("points"))


def ideal_line(runs: DataFrame, x: str) -> DataFrame:
    """The line ``y = x`` for x = 1..max(x)."""
    return (runs.agg(F.max(x).cast("long").alias("__m"))
            .select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("__m"))).alias("x"))
            .withColumn("y", F.col("x")))


def sort_runs(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """O1: runs in ``by`` order (an explicit sort; run tables have one row per run)."""
    return runs.orderBy(*by)


def append_records(frames: Sequence[DataFrame]) -> DataFrame:
    """One frame from several record kinds; columns missing in a kind are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def run_grid(fractions: DataFrame, values: Sequence[int], value_col: str, fraction_col: str = "fraction") -> DataFrame:
    """Every fraction paired with every configuration value (a generator, not a join)."""
    arr = F.array(*[F.lit(int(v)) for v in values])
    return fractions.select(fraction_col, F.explode(arr).alias(value_col))


# --- record filters (X5, X6, X10) ------------------------------------------------

def suffix_filter(df: DataFrame, suffix: str, col: str = "path") -> DataFrame:
    """Keep rows whose object key ends with ``suffix``."""
    return df.where(F.col(col).endswith(suffix))


def run_record_filter(df: DataFrame, min_fraction: float = 0.001, fraction: str = "fraction",
                      executor: str | None = "executor") -> DataFrame:
    """Drop records without a fraction, below ``min_fraction`` or without an executor count."""
    cond = F.col(fraction) >= F.lit(float(min_fraction))
    if executor:
        cond = cond & F.col(executor).isNotNull()
    return df.where(cond)


def drop_null_records(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop records a parser rejected (all of ``cols`` NULL; default: every column)."""
    cols = list(cols or df.columns)
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNotNull()
    return df.where(cond)
