"""Metadata -> exact split sample -> whole patches in tasks -> split datasets.

The sampled metadata (small) is written first, with a row-unique ``sample_id``; every
later count and join uses it.  Each split's patches are read, decoded and packed by the
tasks and written as they come; no pixel is shuffled or kept.  The write itself counts good
and bad patches.  Bad ones are staged once more into a small table, from which recovered
samples are appended to the dataset and the others go to ``rejects``: every requested row
ends in one of the two, or the job fails.  All tables belong to a version that becomes
current only then.
"""

from __future__ import annotations

import json
import os
import platform
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.operators import raster as R
from rasterprep.operators import sampling as S
from rasterprep.operators import tensors as TZ
from rasterprep.session import shuffle_partitions
from rasterprep.sinks import writers as W
from rasterprep.sources import objects as O

BAND_FIELDS = ("height", "width", "pixels", "dtype", "error")
PACKED_COLUMNS = ("sample_id", "patch_id", "image", "label", "height", "width", "channels", "split")


@dataclass
class StepLog:
    """Wall-clock steps of a driver program, recorded also on failure (a profile's ``steps``)."""

    steps: list[dict] = field(default_factory=list)
    summary: dict = field(default_factory=dict)
    logs: list[dict] = field(default_factory=list)
    start: float = field(default_factory=time.time)

    def run(self, name: str, fn, **meta):
        t0 = time.time()
        try:
            return fn()
        finally:
            self.steps.append({"name": name, "duration": time.time() - t0,
                               "timestamp": _iso(t0), **meta})

    def record(self, key: str, value) -> None:
        self.summary[key] = value

    def log(self, message: str) -> None:
        self.logs.append({"timestamp": _iso(time.time()), "message": message})

    def to_json(self) -> str:
        summary = dict(self.summary)
        summary["total_duration"] = sum(s["duration"] for s in self.steps)
        host = {"hostname": platform.node(), "platform": platform.platform(), "cpu_count": os.cpu_count()}
        return json.dumps({"start_time": _iso(self.start), "end_time": _iso(time.time()), "host_info": host,
                           "steps": self.steps, "summary": summary, "logs": self.logs}, indent=2)

    def to_text(self) -> str:
        """The same as a text report: header, messages, steps with their metadata, summary."""
        data = json.loads(self.to_json())
        lines = [f"run {data['start_time']} .. {data['end_time']} on {data['host_info']['hostname']}"]
        lines += [f"[{m['timestamp']}] {m['message']}" for m in data["logs"]]
        for s in data["steps"]:
            extra = " ".join(f"{k}={v}" for k, v in s.items() if k not in ("name", "duration", "timestamp"))
            lines.append(f"{s['name']}: {s['duration']:.2f}s {extra}".rstrip())
        lines += [f"{k}: {v}" for k, v in data["summary"].items()]
        return "\n".join(lines) + "\n"


def _iso(t: float) -> str:
    import datetime as _dt
    return _dt.datetime.fromtimestamp(t).isoformat()


def stage(meta: DataFrame, suffix: str = schemas.RASTER_SUFFIX, decoder: O.Decoder = O.npy_decoder,
          pad_to: tuple[int, int] | None = None, read: str = "patches",
          partitions: int | None = None) -> DataFrame:
    """Staged patches of (sampled) metadata, with ``reason`` NULL for good samples.

    ``read='patches'`` reads whole patches in tasks and packs bytes (``tensors.read_patches``);
    ``read='paths'`` reads band rows and builds array tensors with SQL functions
    (``raster.stage_tensors``), for tables that go on as arrays.  Only files named by
    ``meta`` are opened.  With ``partitions`` the metadata is spread round-robin first -- not
    by patch id, so copies of one patch cannot pile up in one task.
    """
    rows = meta.repartition(int(partitions)) if partitions else meta
    if read == "patches":
        return TZ.read_patches(rows, decoder, suffix=suffix, pad_to=pad_to)
    if read == "paths":
        bands = O.read_rasters(R.expand_band_paths(rows, suffix=suffix), decoder, "path")
        wide = R.assemble_patch(bands.withColumn("value", F.struct(*BAND_FIELDS)),
                                schemas.IMAGE_BANDS + [schemas.REFERENCE_BAND], value="value", keep=["split"])
        return R.stage_tensors(wide, pad_to=pad_to)
    raise ValueError(f"unknown read mode {read!r}")


def conversion_partitions(spark: SparkSession, rows: int, cores: int | None = None,
                          executors: int | None = None, target_bytes: int = 128 << 20) -> int:
    """P20 for the tensor stage: ``min(rows, max(cores * executors * 4, bytes / target))``.

    The first term is the source's plan (4 tasks per core); the second keeps a
    partition near ``target_bytes`` of output when the archive is much larger
    than the cluster.
    """
    if cores and executors:
        tasks = shuffle_partitions(cores, executors)
    else:
        tasks = spark.sparkContext.defaultParallelism * 4
    by_size = -(-rows * schemas.BYTES_PER_SAMPLE // target_bytes)
    return max(1, min(max(rows, 1), max(tasks, by_size)))


def _observed(staged: DataFrame) -> tuple[DataFrame, Observation]:
    """Staged rows that count themselves, good and bad and per split, while they are written.

    The counts belong to the write's own tasks and count a partition once, also where a task
    had to be repeated.
    """
    seen = Observation()
    good = F.col("reason").isNull()
    return staged.observe(
        seen, F.count_if(~good).alias("bad"), F.count_if(good).alias("good"),
        *[F.count_if(good & (F.col("split") == sp)).alias(sp) for sp in schemas.SPLITS]), seen


def convert(spark: SparkSession, meta: DataFrame, out: str, fraction: float = 1.0,
            suffix: str = schemas.RASTER_SUFFIX, decoder: O.Decoder = O.npy_decoder,
            pad_to: tuple[int, int] | None = None, target_file_mb: float | None = 50,
            encode_bytes: bool = True, cores: int | None = None, executors: int | None = None,
            keep_versions: int = 0) -> dict:
    """Run C7; returns the profile summary.

    Writes a new version of ``{out}/data`` (split datasets), ``{out}/rejects`` and
    ``{out}/manifest`` (the sampled rows) and, once all is written and accounted for, makes it
    the current one (``writers.publish``); a run that fails before leaves the earlier
    version in use.  ``{out}/profile/conversion_profile.json`` and ``.txt`` are replaced.
    Counts per split: requested (sampled) and written (D6), observed while writing; requested
    = written + rejected, else the job fails.  ``encode_bytes=False`` writes array tensors;
    ``keep_versions`` earlier versions stay readable.
    """
    log, out, version = StepLog(), out.rstrip("/"), W.new_version()
    data, rejects, listed = (W.version_path(out, t, version) for t in W.VERSION_TABLES)
    if "s1_path" not in meta.columns:
        raise ValueError("metadata needs s1_path/s2_path/reference_path (see raster.with_paths)")

    def manifest() -> DataFrame:
        sampled = S.split_dataset(meta.drop("sample_id"), fraction, id_col="patch_id")
        sampled = sampled.withColumn("sample_id", F.monotonically_increasing_id())
        sampled.write.parquet(listed)
        return spark.read.schema(sampled.schema).parquet(listed)

    def prepare() -> None:
        """Settings and an empty dataset, so that one without samples can be read."""
        spark.createDataFrame([], schema).write.partitionBy("split").parquet(data)

    def good(staged: DataFrame) -> DataFrame:
        samples = TZ.split_packed(staged)[0].select(*PACKED_COLUMNS)
        return samples if encode_bytes else TZ.unpack_samples(samples)

    def append(rows: DataFrame) -> None:
        writer = rows.write.mode("append").partitionBy("split")
        if target_file_mb:
            writer = writer.option("maxRecordsPerFile", W.records_per_file(target_file_mb))
        writer.parquet(data)

    sampled = log.run("read_metadata", manifest)
    requested = {r["split"]: r["rows"] for r in S.split_counts(sampled.select("split")).collect()}
    schema = good(stage(sampled, suffix, decoder, pad_to)).schema
    log.run("spark_init", prepare)
    slots = executors or 1
    written, bad = dict.fromkeys(schemas.SPLITS, 0), 0
    for sp in schemas.SPLITS:
        n = int(requested.get(sp, 0))
        parts = conversion_partitions(spark, n, cores, executors)
        log.record(f"{sp}_requested", n)
        log.record(f"{sp}_rdd_partitions", parts if n else 0)
        log.record(f"{sp}_tasks_per_executor", max(1, parts // slots) if n else 0)
        log.record(f"{sp}_total_data_size_gb", round(n * schemas.BYTES_PER_SAMPLE / (1 << 30), 2))

        def write_split(sp=sp, n=n, parts=parts) -> dict:
            if not n:   # X2: an empty split has no folder
                return {"good": 0, "bad": 0}
            staged, seen = _observed(
                stage(sampled.where(F.col("split") == sp), suffix, decoder, pad_to, partitions=parts))
            append(good(staged))
            return seen.get

        counts = log.run(f"write_{sp}", write_split, rows=n)
        written[sp] += counts["good"]
        bad += counts["bad"]

    def reject() -> int:
        """Stage what was rejected once more, into one table; append what is good now."""
        if not bad:
            spark.createDataFrame([], schemas.REJECTS_SCHEMA).write.parquet(rejects)
            return 0
        done = spark.read.schema(schema).parquet(data).select("sample_id")
        missing = sampled.join(done, "sample_id", "left_anti")
        staged, seen = _observed(stage(missing, suffix, decoder, pad_to,
                                       partitions=conversion_partitions(spark, bad, cores, executors)))
        staged.write.mode("overwrite").parquet(f"{out}/restaged")
        again = spark.read.schema(staged.schema).parquet(f"{out}/restaged")
        counts = seen.get
        if counts["good"]:
            append(good(again))
        for sp in schemas.SPLITS:
            written[sp] += counts[sp]
        TZ.split_packed(again)[1].write.parquet(rejects)
        return counts["bad"]

    rejected = int(log.run("write_rejects", reject))
    for sp in schemas.SPLITS:
        log.record(f"{sp}_samples", int(written[sp]))
    total = int(sum(written.values()))
    log.record("total_rows", total)
    log.record("rejected", rejected)
    log.record("dataset_size_gb", round(total * schemas.BYTES_PER_SAMPLE / (1 << 30), 2))
    log.log(f"{total} samples written, {rejected} rejected")
    wanted = int(requested.get("total", 0))
    if wanted == total + rejected:
        log.run("publish", lambda: W.publish(out, version, {"samples": total, "rejected": rejected}, keep_versions))
    W.write_small_file(f"{out}/profile/conversion_profile.json", log.to_json())
    W.write_small_file(f"{out}/profile/conversion_profile.txt", log.to_text())
    if wanted != total + rejected:
        raise RuntimeError(f"{wanted} rows requested, {total} written, {rejected} rejected")
    return json.loads(log.to_json())["summary"]
