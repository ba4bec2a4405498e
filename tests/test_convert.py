"""Round trip of the conversion plan on generated .npy rasters (archive layout, 4x4 bands)."""

import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.functions import paths as P
from rasterprep.operators import raster as R
from rasterprep.plans import convert as C
from rasterprep.sinks import writers as W

H = W_ = 4


def _npy(arr):
    buf = io.BytesIO()
    np.save(buf, arr)
    return buf.getvalue()


def _prefix(name, n):
    parts = name.split("_")
    return "_".join(parts[:n]) if len(parts) > n else name


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    rng = np.random.default_rng(11)
    rows, truth = [], {}
    kinds = ["ok"] * 6 + ["corrupt", "missing", "shape", "code1000", "code5"]
    for i, kind in enumerate(kinds):
        pid = f"S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP_{i}_57"
        s1 = f"S1A_IW_GRDH_1SDV_20170613T165043_33UUP_{i}_57"
        split = schemas.SPLITS[i % 3]
        bands = {b: rng.random((H, W_)).astype(np.float32) for b in schemas.IMAGE_BANDS}
        ref = rng.choice(schemas.CLASS_CODES, size=(H, W_)).astype(np.int32)
        if kind == "shape":
            bands["VH"] = rng.random((3, 3)).astype(np.float32)
        if kind == "code1000":
            ref[0, 0] = 1000
        if kind == "code5":
            ref[1, 1] = 5
        files = {}
        for b in schemas.S1_BANDS:
            files[root / "BigEarthNet-S1" / _prefix(s1, 5) / s1 / f"{s1}_{b}.npy"] = _npy(bands[b])
        for b in schemas.S2_BANDS:
            files[root / "BigEarthNet-S2" / _prefix(pid, 6) / pid / f"{pid}_{b}.npy"] = _npy(bands[b])
        files[root / "Reference_Maps" / _prefix(pid, 6) / pid / f"{pid}_reference_map.npy"] = _npy(ref)
        for path, data in files.items():
            if kind == "missing" and path.name.endswith("_B08.npy"):
                continue
            if kind == "corrupt" and path.name.endswith("_B03.npy"):
                data = b"not a raster"
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(data)
        rows.append((pid, s1, split, ["a"]))
        truth[pid] = (kind, bands, ref, split)
    return str(root), rows, truth


def _meta(spark, archive):
    root, rows, _ = archive
    meta = spark.createDataFrame(rows, "patch_id string, s1_name string, split string, labels array<string>")
    return R.with_paths(meta, root)


EXPECTED_REJECTS = {"corrupt": "decode_error", "missing": "missing_band", "shape": "shape_mismatch",
                    "code1000": "code_out_of_range"}


def test_stage_samples_and_rejects(spark, archive):
    root, _, truth = archive
    samples, rejects = R.split_staged(C.stage(_meta(spark, archive), read="paths", suffix=".npy"))
    got = {r.patch_id: r for r in samples.collect()}
    want_ok = {p for p, (k, *_r) in truth.items() if k in ("ok", "code5")}
    assert set(got) == want_ok
    lut = np.array(schemas.class_lut())
    for pid in want_ok:
        _, bands, ref, split = truth[pid]
        img = np.stack([bands[b] for b in schemas.IMAGE_BANDS], -1).astype(np.float32)
        r = got[pid]
        assert (r.height, r.width, r.channels, r.split) == (H, W_, 6, split)
        assert np.array_equal(np.array(r.image, dtype=np.float32), img.reshape(-1))
        assert r.label == lut[ref].reshape(-1).tolist()
    rej = {r.patch_id: r for r in rejects.collect()}
    assert {p: r.reason for p, r in rej.items()} == {
        p: EXPECTED_REJECTS[k] for p, (k, *_r) in truth.items() if k in EXPECTED_REJECTS}
    missing = [r for r in rej.values() if r.reason == "missing_band"][0]
    assert "B08" in missing.detail


def test_pad_to(spark, archive):
    root, _, truth = archive
    samples, _ = R.split_staged(C.stage(_meta(spark, archive), read="paths", suffix=".npy", pad_to=(5, 6)))
    r = samples.first()
    assert (r.height, r.width) == (5, 6) and len(r.image) == 5 * 6 * 6
    _, bands, ref, _ = truth[r.patch_id]
    img = np.stack([np.pad(bands[b], [(0, 1), (0, 2)]) for b in schemas.IMAGE_BANDS], -1)
    assert np.array_equal(np.array(r.image, dtype=np.float32), img.reshape(-1))


def test_convert_writes_splits_profile_and_rejects(spark, archive, tmp_path):
    root, _, truth = archive
    out = str(tmp_path / "out")
    summary = C.convert(spark, _meta(spark, archive), out, fraction=1.0, suffix=".npy",
                        target_file_mb=0.0001)
    n_ok = sum(1 for k, *_r in truth.values() if k in ("ok", "code5"))
    assert summary["total_rows"] == n_ok and summary["rejected"] == len(truth) - n_ok
    data = W.read_split(spark, out)
    assert data.count() == n_ok
    assert data.schema["image"].dataType.typeName() == "binary"
    one = data.where(F.col("split") == "train").first()
    _, bands, ref, _ = truth[one.patch_id]
    img = np.frombuffer(one.image, dtype="<f4")
    assert np.array_equal(img, np.stack([bands[b] for b in schemas.IMAGE_BANDS], -1).reshape(-1))
    assert np.frombuffer(one.label, dtype="u1").tolist() == np.array(schemas.class_lut())[ref].reshape(-1).tolist()
    assert spark.read.parquet(f"{out}/rejects").count() == len(truth) - n_ok
    prof = json.loads(open(f"{out}/profile/conversion_profile.json").read())
    assert [s["name"] for s in prof["steps"]][:5] == ["read_metadata", "spark_init", "write_train",
                                                      "write_validation", "write_test"]
    text = open(f"{out}/profile/conversion_profile.txt").read()
    assert "write_train: " in text and "train_rdd_partitions: " in text and "samples written" in text
    assert prof["summary"]["train_samples"] + prof["summary"]["test_samples"] + \
        prof["summary"]["validation_samples"] == n_ok


def test_band_manifest_paths(spark, archive):
    m = R.expand_band_paths(_meta(spark, archive), suffix=".npy")
    assert m.count() == 7 * len(archive[2])
    assert m.where(~F.col("path").endswith(".npy")).count() == 0
    assert set(r.band for r in m.select("band").distinct().collect()) == set(schemas.IMAGE_BANDS + ["reference_map"])


def test_pack_patch_bytes(spark):
    df = spark.createDataFrame([("p", [1.5, 2.5], [0.25], [3, 200], [0, 1, 1])],
                               "patch_id string, s1 array<float>, s2 array<float>, reference array<int>, labels array<int>")
    r = W.pack_patch(df).first()
    assert np.frombuffer(r.s1, "<f4").tolist() == [1.5, 2.5]
    assert np.frombuffer(r.reference, "u1").tolist() == [3, 200]
    assert np.frombuffer(r.labels, "i1").tolist() == [0, 1, 1]


@pytest.mark.parametrize("pad,read", [(None, "paths"), ((5, 6), "paths"), (None, "patches"), ((5, 6), "patches")])
def test_packed_stage_equals_native(spark, archive, pad, read):
    root, _, truth = archive
    meta = _meta(spark, archive)
    native = C.stage(meta, read="paths", suffix=".npy", pad_to=pad)
    if read == "patches":
        packed = C.stage(meta, suffix=".npy", pad_to=pad, partitions=4)
    else:
        from rasterprep.operators import tensors as TZ
        from rasterprep.sources import objects as O
        bands = O.read_rasters(R.expand_band_paths(meta, suffix=".npy"))
        wide = R.assemble_patch(bands.withColumn("value", F.struct(*C.BAND_FIELDS)),
                                schemas.IMAGE_BANDS + [schemas.REFERENCE_BAND], value="value", keep=["split"])
        packed = TZ.stage_packed(wide, pad_to=pad)
    n = {r.patch_id: r for r in native.collect()}
    p = {r.patch_id: r for r in packed.collect()}
    assert set(n) == set(p)
    for pid, a in n.items():
        b = p[pid]
        assert (a.reason, a.detail) == (b.reason, b.detail), pid
        if a.reason is None:
            assert (a.height, a.width, a.channels) == (b.height, b.width, b.channels)
            assert np.array_equal(np.array(a.image, dtype="<f4"), np.frombuffer(b.image, "<f4"))
            assert np.frombuffer(b.label, "u1").tolist() == a.label


def test_read_patches_small_output_batches(spark, archive):
    from rasterprep.operators import tensors as TZ
    meta = _meta(spark, archive).coalesce(1)
    full = {r.patch_id: r.reason for r in TZ.read_patches(meta, suffix=".npy").collect()}
    tiny = {r.patch_id: r.reason for r in TZ.read_patches(meta, suffix=".npy", rows_per_batch=2).collect()}
    assert full == tiny and len(full) == len(archive[2])


# --- every requested row is written or rejected ---------------------------------------------

def _archive(root, kinds, copies=()):
    """An archive of 4x4 ``.npy`` bands, one patch per kind; ``copies`` repeats rows by index."""
    rng = np.random.default_rng(5)
    rows = []
    for i, (kind, split) in enumerate(kinds):
        pid, s1 = f"S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP_{i}_57", f"S1A_IW_GRDH_1SDV_20170613T165043_33UUP_{i}_57"
        files = {root / "BigEarthNet-S1" / _prefix(s1, 5) / s1 / f"{s1}_{b}.npy": rng.random((H, W_)).astype("f4")
                 for b in schemas.S1_BANDS}
        files.update({root / "BigEarthNet-S2" / _prefix(pid, 6) / pid / f"{pid}_{b}.npy": rng.random((H, W_)).astype("f4")
                      for b in schemas.S2_BANDS_ALL})
        files[root / "Reference_Maps" / _prefix(pid, 6) / pid / f"{pid}_reference_map.npy"] = np.full((H, W_), 112, np.int32)
        for path, arr in files.items():
            if kind == "zero" and path.name.endswith("_B02.npy"):
                arr = np.zeros((0, 4), np.float32)
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(b"missing header" if kind == "bad" and path.name.endswith("_B04.npy") else _npy(arr))
        rows.append((pid, s1, split, ["a", "b"][: 1 + i % 2]))
    return rows + [rows[i] for i in copies]


def _frame(spark, rows, root):
    return R.with_paths(spark.createDataFrame(
        rows, "patch_id string, s1_name string, split string, labels array<string>"), str(root))


def _accounted(spark, out, summary, requested):
    assert summary["total_rows"] + summary["rejected"] == requested
    assert spark.read.parquet(f"{out}/data").count() == summary["total_rows"]
    assert spark.read.parquet(f"{out}/rejects").count() == summary["rejected"]


def test_all_bad_input_is_all_rejects(spark, tmp_path):
    rows = _archive(tmp_path / "a", [("bad", "train"), ("bad", "test")])
    out = str(tmp_path / "out")
    s = C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy")
    rejects = spark.read.parquet(f"{out}/rejects").collect()
    assert s["total_rows"] == 0 and s["rejected"] == 2
    assert {r["reason"] for r in rejects} == {"decode_error"}      # not taken for a missing band


def test_duplicate_ids_and_zero_size_bands(spark, tmp_path):
    rows = _archive(tmp_path / "a", [("ok", "train"), ("zero", "train"), ("ok", "test")], copies=[0, 0, 1])
    out = str(tmp_path / "out")
    s = C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy")
    assert (s["total_rows"], s["rejected"]) == (4, 2)
    _accounted(spark, out, s, 6)
    assert {r["reason"] for r in spark.read.parquet(f"{out}/rejects").collect()} == {"shape_mismatch"}


def test_rerun_with_fewer_splits_leaves_nothing_stale(spark, tmp_path):
    rows = _archive(tmp_path / "a", [("ok", "train"), ("ok", "validation"), ("ok", "test")])
    out = str(tmp_path / "out")
    C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy")
    s = C.convert(spark, _frame(spark, rows[:1], tmp_path / "a"), out, suffix=".npy")
    _accounted(spark, out, s, 1)
    assert [r["split"] for r in W.read_split(spark, out).select("split").collect()] == ["train"]


def test_patch_that_recovers_is_written(spark, tmp_path):
    rows = _archive(tmp_path / "a", [("ok", "train")] * 3)
    seen = tmp_path / "seen"
    seen.mkdir()

    def flaky(data: bytes):
        import hashlib
        mark = seen / hashlib.md5(data).hexdigest()
        if not mark.exists():           # the first look at these bytes fails, the second does not
            mark.write_bytes(b"")
            raise ValueError("torn read")
        from rasterprep.sources.objects import npy_decoder
        return npy_decoder(data)

    out = str(tmp_path / "out")
    s = C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy", decoder=flaky)
    assert (s["total_rows"], s["rejected"]) == (3, 0)
    _accounted(spark, out, s, 3)


def test_store_errors_are_retried_then_raised(tmp_path, monkeypatch):
    from rasterprep.sources import objects as O
    path = tmp_path / "x.npy"
    path.write_bytes(_npy(np.ones((2, 2))))
    real, calls = O._resolve, []

    def failing(times):
        def resolve(p):
            calls.append(p)
            if len(calls) <= times:
                raise PermissionError("denied")
            return real(p)
        return resolve

    monkeypatch.setattr(O.time, "sleep", lambda _: None)
    monkeypatch.setattr(O, "_resolve", failing(2))
    assert O.load_band(str(path), O.npy_decoder)[1] is None and len(calls) == 3
    calls.clear()
    monkeypatch.setattr(O, "_resolve", failing(99))
    with pytest.raises(PermissionError):
        O.load_band(str(path), O.npy_decoder)
    monkeypatch.setattr(O, "_resolve", real)
    assert O.load_band(str(tmp_path / "none.npy"), O.npy_decoder)[1].startswith(O.MISSING)


def test_relative_paths_resolve_below_the_working_folder(tmp_path, monkeypatch):
    from rasterprep.sources import objects as O
    monkeypatch.chdir(tmp_path)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b.npy").write_bytes(_npy(np.ones((2, 2))))
    assert O.load_band("a/b.npy", O.npy_decoder)[0].shape == (2, 2)
    W.write_small_file("a/report.txt", "x")
    assert (tmp_path / "a" / "report.txt").read_text() == "x"


def test_array_output(spark, tmp_path):
    rows = _archive(tmp_path / "a", [("ok", "train")])
    out = str(tmp_path / "out")
    C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy", encode_bytes=False)
    r = spark.read.parquet(f"{out}/data").first()
    assert len(r["image"]) == H * W_ * 6 and set(r["label"]) == {1}


def test_profile_feeds_the_report(spark, tmp_path):
    from rasterprep.operators import feed as FD
    from rasterprep.plans import report
    from rasterprep.sources import metadata as M
    rows = _archive(tmp_path / "a", [("ok", "train"), ("ok", "validation"), ("ok", "test")])
    out = str(tmp_path / "runs" / "frac_1.0" / "exec_1")
    C.convert(spark, _frame(spark, rows, tmp_path / "a"), out, suffix=".npy")
    runs = report.load_runs(spark, str(tmp_path / "runs"), "conversion").collect()
    assert len(runs) == 1 and runs[0]["executor"] == 1 and runs[0]["write_train"] > 0
    sorted_runs, curves, ideal = report.experiment_report(spark, str(tmp_path / "runs"), "conversion")
    assert sorted_runs.first()["speedup"] == 1.0 and curves.count() == 1 and ideal.count() == 1
    assert len(report.experiment_report(spark, str(tmp_path / "runs"), "conversion_ext")) == 3
    profiles = M.read_profiles(spark, str(tmp_path / "runs"))
    assert all(r["agrees"] for r in FD.check_sizes(W.read_split(spark, out), profiles).collect())
    lines = [r["line"] for r in W.profile_text(profiles).orderBy("i").collect()]
    assert lines[0].startswith("run ") and any(x.startswith("train_rdd_partitions: ") for x in lines)


def test_five_column_packing(spark, tmp_path):
    from rasterprep.operators import labels as LB
    from rasterprep.plans import packed as PK
    rows = _archive(tmp_path / "a", [("ok", "train"), ("ok", "test"), ("bad", "train")])
    rows[1] = (*rows[1][:3], ["a", "zzz"])
    meta = _frame(spark, rows, tmp_path / "a").withColumn("sample_id", F.monotonically_increasing_id())
    vocab = LB.label_vocab(meta.where("NOT array_contains(labels, 'zzz')"))
    good, rejects = PK.packed_patches(meta, vocab, suffix=".npy", pad_to=(6, 6))
    r = good.first()
    assert good.count() == 1
    assert {x["reason"] for x in rejects.collect()} == {"unknown_label", "decode_error"}
    root = tmp_path / "a"
    pid, s1 = rows[0][0], rows[0][1]
    for name, folder, own, bands in (("s1", f"BigEarthNet-S1/{_prefix(s1, 5)}/{s1}", s1, schemas.S1_BANDS),
                                     ("s2", f"BigEarthNet-S2/{_prefix(pid, 6)}/{pid}", pid, schemas.S2_BANDS_ALL)):
        want = np.stack([np.pad(np.load(root / folder / f"{own}_{b}.npy"), [(0, 2), (0, 2)]) for b in bands], -1)
        assert np.array_equal(np.frombuffer(r[name], "<f4"), want.reshape(-1))
    assert np.frombuffer(r["labels"], "i1").tolist() == [1]
    assert np.frombuffer(r["reference"], "u1").reshape(6, 6)[:4, :4].tolist() == [[1] * 4] * 4


def test_narrowing_is_checked(spark):
    df = spark.createDataFrame([(1, [3, 300]), (2, [3, 200])], "id int, v array<int>")
    with pytest.raises(Exception, match="does not fit"):
        W.to_bytes(df, {"v": "u1"}).collect()
    got = {r["id"]: r["v"] for r in W.to_bytes(df, {"v": "u1"}, on_overflow="null").collect()}
    assert got[1] is None and np.frombuffer(got[2], "u1").tolist() == [3, 200]
