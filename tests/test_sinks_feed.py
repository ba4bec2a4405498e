import glob
import json

import pytest
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.operators import raster as R
from rasterprep.plans import check as CK
from rasterprep.plans import feed_plan as FP
from rasterprep.sinks import writers as W
from rasterprep.sources import metadata as M


def test_write_metadata_roundtrip(spark, tmp_path):
    meta = spark.createDataFrame([("S2A_MSIL2A_X_N_R_T_1_2", "S1A_IW_G_1_2_3_4", "train")],
                                 "patch_id string, s1_name string, split string")
    W.write_metadata(R.with_paths(meta, "s3://b/a"), str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m")).first()
    assert back.s1_path == "s3://b/a/BigEarthNet-S1/S1A_IW_G_1_2/S1A_IW_G_1_2_3_4"


def test_validation_report_files(spark, tmp_path):
    meta = spark.createDataFrame([("p1", "s3://b/x/p1", "s3://b/y/p1", "s3://b/z/p1"),
                                  ("p2", "s3://b/x/p2", "s3://b/y/p2", "s3://b/z/p2")],
                                 "patch_id string, s1_path string, s2_path string, reference_path string")
    inv = spark.createDataFrame([("s3://b/x/p1/a",), ("s3://b/y/p1/a",), ("s3://b/z/p1/a",), ("s3://b/x/p2/a",)],
                                "path string")
    _, summary, missing = CK.check(meta, inv, 1.0)
    W.write_validation_report(summary, missing, str(tmp_path / "rep"))
    files = glob.glob(str(tmp_path / "rep" / "summary" / "part-*.json"))
    assert len(files) == 1
    s = json.loads(open(files[0]).readline())
    assert (s["all_files_found"], s["not_found"], s["total_checked"]) == (1, 1, 2)
    assert [r.patch_id for r in spark.read.json(str(tmp_path / "rep" / "missing")).collect()] == ["p2"]


def test_records_per_file_and_rowgroups(spark, tmp_path):
    assert W.records_per_file(50) == int(50 * 2**20 // schemas.BYTES_PER_SAMPLE) == 145
    df = spark.range(0, 100).select(F.col("id").cast("string").alias("patch_id"),
                                    F.lit("train").alias("split"))
    W.write_splits(df, str(tmp_path / "o"), target_file_mb=30 * 360000 / 2**20, rowgroup_mb=1)
    files = glob.glob(str(tmp_path / "o" / "data" / "split=train" / "*.parquet"))
    assert len(files) >= 4  # at most 30 rows per file
    assert W.read_split(spark, str(tmp_path / "o"), "train").count() == 100


def test_profile_text(spark, tmp_path):
    (tmp_path / "a_profile.json").write_text(json.dumps({
        "start_time": "2024-01-01T00:00:00", "end_time": "2024-01-01T00:00:04", "host_info": {"hostname": "h"},
        "steps": [{"name": "read_metadata", "duration": 1.234}, {"name": "training", "duration": 2.0, "epochs": 3}],
        "summary": {"total_duration": 3.234, "train_samples": 7},
        "logs": [{"timestamp": "t0", "message": "hello"}]}))
    prof = M.read_profiles(spark, str(tmp_path))
    lines = [r.line for r in W.profile_text(prof).orderBy("i").collect()]
    assert lines == ["run 2024-01-01T00:00:00 .. 2024-01-01T00:00:04 on h", "[t0] hello", "read_metadata: 1.23s",
                     "training: 2.00s epochs=3", "total_duration: 3.23s", "train_samples: 7"]


def test_feed_plan_on_dataset(spark):
    rows = [(f"p{i}", schemas.SPLITS[i % 3]) for i in range(300)]
    samples = spark.createDataFrame(rows, "patch_id string, split string")
    plans = FP.feed_plan(samples, epochs=2, batch_per_replica=8, replicas=2, seed=42)
    train = plans["train"].collect()
    assert len(train) == 2 * (100 // 16) * 16
    assert {r.epoch for r in train} == {0, 1}
    e0 = sorted(r.pos for r in train if r.epoch == 0)
    assert e0 == list(range(96))
    val = plans["validation"].collect()
    assert len(val) == 100 and max(r.batch for r in val) == 6
    steps = {r.split: r for r in FP.steps_table(samples, 8, 2).collect()}
    assert steps["train"].steps == 7 and steps["train"].samples_per_epoch == 112
    with pytest.raises(FileNotFoundError):
        FP.feed_plan(samples.where("split != 'test'"), epochs=1)
