"""Run profiles -> records -> speedup -> curve tables (the data behind the figures).

Three configurations, each ``(records, x, baseline)``: conversion runs over
executors (baseline 1), training runs over GPUs for batch scaling and for
learning-rate scaling (baseline 1 GPU).  Drawing is out of scope; the outputs
are the curve points and the ideal line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterprep.operators import runs as RU
from rasterprep.sources import metadata as M

CONFIGS = {
    "conversion": (RU.conversion_runs, "executor", "conversion_profile.json"),
    "conversion_ext": (RU.conversion_runs_ext, None, "conversion_profile.json"),
    "training_batch": (RU.training_runs_batch, "num_gpus", "_profile.json"),
    "training_lr": (RU.training_runs_lr, "num_gpus", "_profile.json"),
}


def write_quarantine(spark: SparkSession, root: str, out: str, suffix: str = "_profile.json") -> DataFrame:
    """The profiles below ``root`` that no record can be made from, written as ``{out}/rejects``
    (``path, reason, detail``) and returned, so that a file the report leaves out is named."""
    _, rejects = M.read_profiles_checked(spark, root, suffix)
    rejects.write.mode("overwrite").json(f"{out.rstrip('/')}/rejects")
    return spark.read.schema(rejects.schema).json(f"{out.rstrip('/')}/rejects")


def load_runs(spark: SparkSession, root: str, kind: str,
              parser: Callable[[DataFrame], DataFrame] | None = None,
              suffix: str | None = None) -> DataFrame:
    """S7 + a record parser (U3): built-in ``kind`` or any ``DataFrame -> DataFrame`` callable.

    The parser sees one row per profile file with ``path`` and ``key`` (object key).
    """
    default_parser, _, default_suffix = CONFIGS.get(kind, (None, None, "_profile.json"))
    profiles = M.read_profiles(spark, root, suffix=suffix or default_suffix)
    keyed = profiles.withColumn("key", RU.object_key("path"))
    return (parser or default_parser)(keyed)


def experiment_report(spark: SparkSession, root: str, kind: str,
                      time_col: str = "total_time") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(runs with speedup sorted, curve points, ideal line)`` for one configuration.

    ``conversion_ext`` runs carry no executor count, hence no speedup: their one curve is
    the time over the fraction, and their ideal line is empty.
    """
    _, x, _ = CONFIGS[kind]
    runs = load_runs(spark, root, kind)
    if x is None:
        curves = RU.curve_points(runs.withColumn("curve", F.lit(kind)), "fraction", time_col, key="curve")
        return RU.sort_runs(runs, ["fraction"]), curves, RU.ideal_line(runs.where(F.lit(False)), "fraction")
    with_speedup = RU.speedup(runs, x, 1, time_col=time_col)
    curves = RU.curve_points(with_speedup, x, "speedup")
    ideal = RU.ideal_line(runs, x)
    return RU.sort_runs(with_speedup, ["fraction", x]), curves, ideal


def curve_labels(curves: DataFrame) -> DataFrame:
    """Legend text per curve (P27): ``5%`` for fraction 0.05."""
    from rasterprep.functions.paths import fraction_label
    return curves.select("fraction", fraction_label("fraction").alias("label")).distinct()
