"""Versions of the converted dataset, and counts taken while it is written."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from test_convert import _archive, _frame

from rasterprep.plans import convert as C
from rasterprep.sinks import writers as W


def test_failed_rerun_leaves_the_old_data_in_use(spark, tmp_path, monkeypatch):
    rows = _archive(tmp_path / "a", [("ok", "train"), ("ok", "validation"), ("bad", "test")])
    out = str(tmp_path / "out")
    C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy")
    before = W.current_version(out)
    assert before["samples"] == 2 and before["rejected"] == 1

    def torn(data):
        raise MemoryError("the worker is lost")

    with pytest.raises(Exception, match="the worker is lost"):
        C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy", decoder=torn)
    assert W.current_version(out) == before
    assert W.read_split(spark, out).count() == 2
    # also if it fails at the very end
    monkeypatch.setattr(W, "write_small_file", lambda *a: (_ for _ in ()).throw(OSError("denied")))
    with pytest.raises(OSError, match="denied"):
        C.convert(spark, _frame(spark, rows[:1], tmp_path / "a"), out, suffix=".npy")
    monkeypatch.undo()
    assert W.current_version(out) == before and W.read_split(spark, out).count() == 2
    assert len(os.listdir(tmp_path / "out" / "data")) > 1
    # the next good run takes over and removes what the failed ones left
    C.convert(spark, _frame(spark, rows[:1], tmp_path / "a"), out, suffix=".npy")
    assert W.read_split(spark, out).count() == 1 and W.current_version(out)["samples"] == 1
    for table in W.VERSION_TABLES:
        assert os.listdir(tmp_path / "out" / table) == [f"version={W.current_version(out)['version']}"]


def test_earlier_versions_can_be_kept(spark, tmp_path):
    rows = _archive(tmp_path / "a", [("ok", "train"), ("ok", "test")])
    out, seen = str(tmp_path / "out"), []
    for n in (2, 1, 2):
        C.convert(spark, _frame(spark, rows[:n], tmp_path / "a"), out, suffix=".npy", keep_versions=1)
        seen.append(W.current_version(out)["version"])
    assert sorted(seen) == seen
    assert spark.read.parquet(W.version_path(out, "data", seen[1])).count() == 1
    assert sorted(os.listdir(tmp_path / "out" / "data")) == [f"version={v}" for v in seen[1:]]


def test_splits_without_versions_are_read_as_before(spark, tmp_path):
    df = spark.createDataFrame([("p", "train"), ("q", "test")], "patch_id string, split string")
    W.write_splits(df, str(tmp_path / "out"), target_file_mb=None)
    assert W.current_version(str(tmp_path / "out")) is None
    assert W.read_split(spark, str(tmp_path / "out"), "test").first()["patch_id"] == "q"


def test_no_second_read_of_the_dataset_without_rejects(spark, tmp_path, monkeypatch):
    rows = _archive(tmp_path / "a", [("ok", "train"), ("ok", "test")])
    reads = []
    real = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **k: (reads.append(p), real(self, *p, **k))[1])
    s = C.convert(spark, _frame(spark, rows, tmp_path / "a"), str(tmp_path / "out"), suffix=".npy")
    assert (s["train_samples"], s["test_samples"], s["total_rows"], s["rejected"]) == (1, 1, 2, 0)
    assert not [p for p in reads if "/data/" in p[0]]


RETRY = """
    import os, sys
    sys.path[:0] = [{repo!r}, {tests!r}]
    from pathlib import Path
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "2").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from test_convert import _archive, _frame
    from rasterprep.plans import convert as C
    from rasterprep.sources.objects import npy_decoder
    tmp = Path({tmp!r})
    rows = _archive(tmp / "a", [("ok", "train")] * 7 + [("bad", "train")] * 2)

    def once(data):
        mark = tmp / "failed"
        if len(os.listdir(tmp / "seen")) > 20 and not mark.exists():
            mark.write_bytes(b"")
            raise MemoryError("a task is lost after it has staged some patches")
        (tmp / "seen" / str(len(os.listdir(tmp / "seen")))).write_bytes(b"")
        return npy_decoder(data)

    (tmp / "seen").mkdir()
    s = C.convert(spark, _frame(spark, rows, tmp / "a"), str(tmp / "out"), suffix=".npy", decoder=once,
                  cores=1, executors=1)
    n = spark.read.parquet(str(tmp / "out" / "data")).count()
    print("COUNTS", s["total_rows"], s["rejected"], n, (tmp / "failed").exists())
"""


def test_counts_are_right_after_a_repeated_task(tmp_path):
    here = os.path.dirname(os.path.abspath(__file__))
    code = textwrap.dedent(RETRY).format(repo=os.path.dirname(here), tests=here, tmp=str(tmp_path))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "COUNTS 7 2 7 True" in done.stdout, done.stdout + done.stderr[-2000:]
