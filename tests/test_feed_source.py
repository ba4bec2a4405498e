"""The loader's side: buffered shuffle, the batch source, footers and quarantined profiles."""

import glob
import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rasterprep.operators import buffered as B
from rasterprep.plans import report
from rasterprep.sinks import writers as W
from rasterprep.sources import feed_source as FS
from rasterprep.sources import footers as FT
from rasterprep.sources import metadata as M


def simulated(items, draws, size):
    """The same buffer, one row at a time."""
    held, out = [], []
    for x in items:
        if len(held) < size:
            held.append(x)
            continue
        k = min(int(draws.random() * size), size - 1)
        out.append(held[k])
        held[k] = x
    return out + [held[i] for i in draws.permutation(len(held))]


@pytest.mark.parametrize("n,size,cut", [(0, 5, 3), (3, 5, 2), (5, 5, 5), (200, 7, 1), (200, 7, 64), (5000, 2000, 333)])
def test_buffer_equals_a_plain_simulation(n, size, cut):
    want = simulated(list(range(n)), B.shard_draws(1, 2, 3), size)
    buffer, got = B.ShuffleBuffer(B.shard_draws(1, 2, 3), size), []
    for lo in range(0, n, cut):
        out = buffer.push(pa.record_batch({"x": list(range(lo, min(n, lo + cut)))}))
        got += out.column("x").to_pylist() if out is not None else []
    rest = buffer.drain()
    assert got + (rest.column("x").to_pylist() if rest is not None else []) == want
    assert sorted(want) == list(range(n))


def test_buffered_shuffle_is_the_same_for_any_partitioning(spark):
    df = spark.range(3000).select("id", (F.col("id") % 4).alias("shard"), F.lit("x").alias("pos"))
    df = df.unionByName(spark.createDataFrame([(-1, None, "x"), (-2, None, "x")], "id long, shard long, pos string"))
    orders = []
    for parts in (1, 5):
        got = B.buffered_shuffle(df.repartition(parts), "id", seed=9, epoch=1, buffer=100)
        rows = sorted((r["shard"] is None, r["shard"], r["pos"], r["id"]) for r in got.collect())
        orders.append(rows)
    assert orders[0] == orders[1] and len(orders[0]) == 3002
    for shard in range(4):
        ids = [r[3] for r in orders[0] if r[1] == shard]
        assert ids == simulated([i for i in range(3000) if i % 4 == shard], B.shard_draws(9, 1, shard), 100)
    assert B.buffered_shuffle(df.where("false"), "id").count() == 0


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("feed") / "train")
    rows = [(f"p{i}", bytes([i % 256] * 4), i) for i in range(1003)]
    df = spark.createDataFrame(rows, "patch_id string, image binary, n int").repartition(6)
    FS.write_feed(df, path, shards=4, chunk_rows=32)
    return path, rows


def test_feed_batches(spark, feed):
    path, rows = feed
    df = FS.read_feed(spark, path, epochs=2, batch_size=10, buffer=50)
    assert df.columns == ["epoch", "shard", "batch", "pos", "patch_id", "image", "n"]
    got = df.collect()
    image = {p: (b, n) for p, b, n in rows}
    for e in range(2):
        seen = [r for r in got if r["epoch"] == e]
        assert len({r["patch_id"] for r in seen}) == len(seen)
        for s in range(4):
            mine = sorted((r for r in seen if r["shard"] == s), key=lambda r: r["pos"])
            assert len(mine) == 250 and [r["pos"] for r in mine] == list(range(250))
            assert all(r["batch"] == r["pos"] // 10 for r in mine)
    assert all((bytes(r["image"]), r["n"]) == image[r["patch_id"]] for r in got)
    order = [[r["patch_id"] for r in sorted((r for r in got if (r["epoch"], r["shard"]) == (e, 0)), key=lambda r: r["pos"])]
             for e in range(2)]
    assert order[0] != order[1]
    again = FS.read_feed(spark, path, epochs=2, batch_size=10, buffer=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    every = FS.read_feed(spark, path, batch_size=10, drop_remainder=False)
    assert sorted(r["patch_id"] for r in every.collect()) == sorted(image)


def test_a_shard_reads_only_its_files(spark, feed, tmp_path):
    import shutil
    path = str(tmp_path / "train")
    shutil.copytree(feed[0], path)
    for s in (0, 2, 3):
        for f in glob.glob(f"{path}/shard={s}/chunk=*/*.parquet"):
            open(f, "wb").write(b"broken")
    df = FS.read_feed(spark, path, epochs=3, batch_size=10)
    one = df.where("shard = 1 AND epoch IN (0, 2)")
    got = one.collect()
    assert len(got) == 500 and {(r["epoch"], r["shard"]) for r in got} == {(0, 1), (2, 1)}
    assert one.rdd.getNumPartitions() == 2
    assert df.where("shard = 7").count() == 0 and df.where("shard = 1 AND batch = 3").count() == 30
    with pytest.raises(Exception):
        df.where("shard = 0").collect()


def test_feed_columns_may_not_clash(spark, tmp_path):
    with pytest.raises(ValueError, match="batch"):
        FS.write_feed(spark.createDataFrame([("a", 1)], "patch_id string, batch int"), str(tmp_path), 2)


# --- footers -----------------------------------------------------------------------------------

def test_row_groups_follow_measured_bytes(spark, tmp_path):
    # half of every sample is zeros: it compresses to much less than its size
    rng = np.random.default_rng(0)
    rows = [(f"p{i}", "train" if i % 4 else "test", rng.bytes(3000) + bytes(7000)) for i in range(1200)]
    df = spark.createDataFrame(rows, "patch_id string, split string, image binary")
    target = 0.25
    W.write_splits(df, str(tmp_path / "o"), target_file_mb=target, partitions=1, pilot_rows=200)
    foot = FT.dataset_footers(spark, str(tmp_path / "o" / "data"))
    groups = [r for r in foot.collect() if r["split"] == "train"]
    full = sorted(r["compressed"] for r in groups)[1:]            # all but the last of the files
    assert len(full) >= 8 and all(abs(b - target * 2**20) < 0.2 * target * 2**20 for b in full)
    got = {r["split"]: r for r in FT.sizes(foot).collect()}
    assert (got["train"]["samples"], got["test"]["samples"]) == (900, 300)
    assert got["train"]["files"] == got["train"]["row_groups"] == len(groups)
    for r in groups:
        meta = pq.read_metadata(r["path"].removeprefix("file:"))
        assert meta.num_row_groups == 1 and meta.num_rows == r["rows"]
    # by the constant, files of such samples come out far too small
    W.write_splits(df, str(tmp_path / "c"), target_file_mb=target, partitions=1, bytes_per_row=10_000)
    small = FT.dataset_footers(spark, str(tmp_path / "c" / "data")).agg(F.max("compressed")).first()[0]
    assert small < 0.5 * target * 2**20


def test_footers_of_files_without_rows(spark, tmp_path):
    with pq.ParquetWriter(tmp_path / "e.parquet", pa.schema([("x", pa.int64())])):
        pass
    r = FT.dataset_footers(spark, str(tmp_path)).first()
    assert (r["row_group"], r["rows"], r["split"]) == (None, 0, None)
    assert FT.bytes_per_row(FT.dataset_footers(spark, str(tmp_path))) is None


# --- quarantine ----------------------------------------------------------------------------------

def test_every_broken_profile_is_listed(spark, tmp_path):
    good = {"start_time": "t", "steps": [{"name": "a", "duration": 1.0}], "summary": {"total_duration": 1.0}, "logs": []}
    files = {"ok": json.dumps(good), "cut": json.dumps(good)[:40], "empty_steps": json.dumps(good | {"steps": []}),
             "no_summary": json.dumps({k: v for k, v in good.items() if k != "summary"}), "text": "not json",
             "wrong": json.dumps(good | {"steps": "many"}), "list": "[1, 2]"}
    for name, text in files.items():
        (tmp_path / f"{name}_profile.json").write_text(text)
    (tmp_path / "other.json").write_text("not a profile")
    good_rows, rejects = M.read_profiles_checked(spark, str(tmp_path))
    kept = {r["path"].rsplit("/", 1)[1] for r in good_rows.collect()}
    lost = {r["path"].rsplit("/", 1)[1]: (r["reason"], r["detail"]) for r in rejects.collect()}
    assert kept == {"ok_profile.json"} and kept | set(lost) == {f"{n}_profile.json" for n in files}
    assert lost["cut_profile.json"][0] == lost["text_profile.json"][0] == lost["wrong_profile.json"][0] == "malformed"
    assert lost["text_profile.json"][1] == "not json"
    assert lost["empty_steps_profile.json"][0] == "no_steps" and lost["no_summary_profile.json"][0] == "no_summary"
    assert good_rows.columns == M.read_profiles(spark, str(tmp_path)).columns
    written = report.write_quarantine(spark, str(tmp_path), str(tmp_path / "q"))
    assert {r["path"].rsplit("/", 1)[1] for r in written.collect()} == set(lost)
