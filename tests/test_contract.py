"""Types and shapes of decoded bands: every wrong one is a reject with a reason, on all paths."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterprep import schemas
from rasterprep.functions import arrays as A
from rasterprep.operators import raster as R
from rasterprep.operators import tensors as TZ
from rasterprep.plans import convert as C
from rasterprep.sources import objects as O

IMG, REF = schemas.IMAGE_BANDS[0], schemas.REFERENCE_BAND
TABLE = TZ._class_table(None)


def pack(**bands):
    good = {b: (np.ones((2, 2), np.float32), None) for b in schemas.IMAGE_BANDS}
    good[REF] = (np.full((2, 2), 112, np.int32), None)
    return TZ.pack_patch_arrays(good | {k: (v, None) for k, v in bands.items()}, TZ.IMAGE_GROUP, REF, TABLE, None)


@pytest.mark.parametrize("band,arr,reason", [
    (REF, np.full((2, 2), 111.7), "bad_dtype"),
    (REF, np.full((2, 2), 111.0), "bad_dtype"),             # a float map is no class map, whole or not
    (REF, np.full((2, 2), True), "bad_dtype"),
    (REF, np.full((2, 2), 2**63, np.uint64), "code_out_of_range"),
    (REF, np.full((2, 2), -1, np.int8), "code_out_of_range"),
    (IMG, np.full((2, 2), "text"), "bad_dtype"),
    (IMG, np.full((2, 2), None, object), "bad_dtype"),
    (IMG, np.full((2, 2), 1j), "bad_dtype"),
    (IMG, np.full((2, 2), "2020-01-01", "M8[D]"), "bad_dtype"),
    (IMG, np.full((2, 2), 2**24 + 1, np.int64), "bad_dtype"),
    (IMG, np.full((2, 2), 1e300), "bad_dtype"),
    (IMG, np.ones((3, 2)), "shape_mismatch"),
    (IMG, np.full((2, 2), np.nan), None),
    (IMG, np.full((2, 2), 2**24, np.int64), None),
    (REF, np.full((2, 2), 112, np.uint16), None),
])
def test_kernel_rejects_by_type(band, arr, reason):
    got = pack(**{band: arr})
    assert got["reason"] == reason
    assert reason != "bad_dtype" or got["detail"]
    assert (got["label"] is None) == (reason is not None)


RESULTS = {"list": lambda: [[1.0]], "none": lambda: None, "text": lambda: "x", "scalar": lambda: 1.0,
           "rank3": lambda: np.ones((1, 2, 2)), "rank1": lambda: np.ones(4), "objects": lambda: np.array([[None]]),
           "words": lambda: np.full((2, 2), "x"), "raises": lambda: 1 / 0, "complex": lambda: np.full((2, 2), 1j)}


@pytest.mark.parametrize("kind", sorted(RESULTS))
def test_no_decoder_result_ends_the_job(spark, tmp_path, kind):
    (tmp_path / "f").write_bytes(b"x")
    meta = R.with_paths(spark.createDataFrame([("a_b_c_d_e_f_g", "a_b_c_d_e_f", "train")],
                                              "patch_id string, s1_name string, split string"), str(tmp_path))
    for r in R.expand_band_paths(meta, suffix=".npy").collect():
        from pathlib import Path
        Path(r["path"]).parent.mkdir(parents=True, exist_ok=True)
        Path(r["path"]).write_bytes(b"x")

    def decoder(data):
        return RESULTS[kind]()

    want = {"objects": "bad_dtype", "words": "bad_dtype", "complex": "bad_dtype"}.get(kind, "decode_error")
    assert [r["reason"] for r in C.stage(meta, suffix=".npy", decoder=decoder).collect()] == [want]
    arrays = C.stage(meta, suffix=".npy", decoder=decoder, read="paths").collect()
    assert [r["reason"] for r in arrays] == ["decode_error"] and arrays[0]["detail"]


def test_class_map_types_on_the_sql_path(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"")
    kinds = {"whole": np.full((2, 2), 112, np.int32), "small": np.full((2, 2), 112, np.uint8),
             "float": np.full((2, 2), 112.0), "fraction": np.full((2, 2), 111.7)}
    rows = []
    for name, ref in kinds.items():
        for b in schemas.IMAGE_BANDS + [REF]:
            f = tmp_path / f"{name}_{b}.npy"
            np.save(f, ref if b == REF else np.ones((2, 2), np.float32))
            rows.append((name, "train", b, str(f)))
    bands = O.read_rasters(spark.createDataFrame(rows, "patch_id string, split string, band string, path string"))
    wide = R.assemble_patch(bands.withColumn("value", F.struct(*C.BAND_FIELDS)),
                            schemas.IMAGE_BANDS + [REF], value="value", keep=["split"])
    want = {"whole": None, "small": None, "float": "bad_dtype", "fraction": "bad_dtype"}
    assert {r["patch_id"]: r["reason"] for r in R.stage_tensors(wide).collect()} == want
    assert {r["patch_id"]: r["reason"] for r in TZ.stage_packed(wide).collect()} == want
    # without the type, whole numbers pass
    plain = R.assemble_patch(bands.withColumn("value", F.struct("height", "width", "pixels")),
                             schemas.IMAGE_BANDS + [REF], value="value", keep=["split"])
    want["float"] = None
    assert {r["patch_id"]: r["reason"] for r in R.stage_tensors(plain).collect()} == want
    assert {r["patch_id"]: r["reason"] for r in TZ.stage_packed(plain).collect()} == want


def test_codes_must_be_whole(spark):
    df = spark.createDataFrame([(1, [111.0, 111.7, -1.0, float("nan"), 1e30, None, 112.0])], "id int, px array<double>")
    got = df.select(A.remap_classes("px").alias("i")).first()["i"]
    lut = schemas.class_lut()
    assert got == [lut[111], None, None, None, None, None, lut[112]]


def test_files_are_read_in_bounded_batches_and_keep_their_type(spark, tmp_path):
    rows = []
    for i, arr in enumerate([np.ones((2, 3), np.uint16), np.ones((2, 3)), np.full((1, 1), 1e300), np.full((1, 1), "x")]):
        np.save(tmp_path / f"{i}.npy", arr)
        rows.append((i, str(tmp_path / f"{i}.npy")))
    rows += [(8, str(tmp_path / "none.npy")), (9, None)]
    df = spark.createDataFrame(rows, "id int, path string")
    for read in (lambda n: O.decode_rasters(O.read_paths(df, rows_per_batch=n), rows_per_batch=n),
                 lambda n: O.read_rasters(df, rows_per_batch=n)):
        for n in (1, 64):
            got = {r["id"]: r for r in read(n).collect()}
            assert (got[0]["dtype"], got[0]["height"], got[0]["width"], got[0]["pixels"]) == ("uint16", 2, 3, [1.0] * 6)
            assert got[1]["dtype"] == "float64" and got[1]["error"] is None
            assert got[2]["pixels"] is None and "does not fit float32" in got[2]["error"]
            assert "not numeric" in got[3]["error"]
            assert got[8]["error"] == "missing object" and got[9]["error"] == "missing path"


def test_full_scan_reads_every_object(spark, tmp_path):
    for name in ("a/x.npy", "a/b/y.npy", "z.txt"):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        np.save(f, np.ones((2, 2))) if name.endswith("npy") else f.write_bytes(b"t")
    got = O.decode_rasters(O.scan_files(spark, str(tmp_path), ".npy")).collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in got) == ["x.npy", "y.npy"]
    assert all(r["pixels"] == [1.0] * 4 for r in got)


def test_bands_are_fetched_where_the_inventory_lists_them(spark, tmp_path):
    rows = []
    for i in range(4):
        np.save(tmp_path / f"{i}.npy", np.full((1, 2), i, np.int16))
        rows.append((f"p{i % 2}", f"B{i}", f"file://{tmp_path}/{i}.npy"))
    manifest = spark.createDataFrame(rows + [("p9", "B9", None)], "patch_id string, band string, path string")
    listed = spark.createDataFrame([(str(tmp_path / f"{i}.npy"),) for i in (0, 1, 1, 3)] + [("s3://else/x",)], "path string")
    got = {r["band"]: r for r in R.fetch_bands(manifest, listed).collect()}
    assert {b: r["error"] for b, r in got.items()} == {
        "B0": None, "B1": None, "B2": "missing_band", "B3": None, "B9": "missing_band"}
    assert got["B3"]["pixels"] == [3.0, 3.0] and got["B3"]["dtype"] == "int16" and got["B2"]["pixels"] is None
    plan = R.fetch_bands(manifest, listed)._jdf.queryExecution().executedPlan().toString()
    # the decoding step stands above every exchange
    assert plan.index("MapInArrow") < plan.index("Exchange")


def test_channel_axis_and_profile_tables(spark, tmp_path):
    from rasterprep.sinks import writers as W
    from rasterprep.sources import metadata as M
    df = spark.createDataFrame([([1.0, 2.0], 1, 2)], "px array<double>, height int, width int")
    one = df.withColumn("channels", A.with_channel_axis())
    assert one.where(A.shape_ok("px", "height", "width", F.col("channels"))).count() == 1
    (tmp_path / "a_profile.json").write_text('{"start_time": "t", "steps": [{"name": "x", "duration": 2.5}], '
                                             '"summary": {"train_samples": 3}}')
    profiles = M.read_profiles(spark, str(tmp_path)).drop("path")
    for fmt in ("json", "parquet"):
        W.write_profiles(profiles, str(tmp_path / fmt), fmt)
        back = spark.read.schema(profiles.schema).format(fmt).load(str(tmp_path / fmt)).first()
        assert (back["steps"][0]["duration"], back["summary"]["train_samples"]) == (2.5, 3)
