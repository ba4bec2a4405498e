from rasterprep.operators import inventory as INV
from pyspark.sql import functions as F

from rasterprep.plans import check as CK


def _meta(spark):
    rows = [
        ("p1", "train", "s3://b/S1/a/p1", "s3://b/S2/a/p1", "s3://b/REF/a/p1"),   # complete
        ("p2", "train", "s3://b/S1/a/p2", "s3://b/S2/a/p2", "s3://b/REF/a/p2"),   # missing reference folder
        ("p3", "test", "s3://b/S1/a/p3", "s3://b/S2/a/p3", "s3://b/REF/a/p3"),    # one band file missing: folder exists
        ("p4", "test", "s3a://b/S1/a/p4", "s3://b/S2/a/p4", "s3://b/REF/a/p4"),   # s3a path is not valid
        ("p5", "validation", None, "", "s3://b/REF/a/p5"),                         # null and empty
    ]
    return spark.createDataFrame(rows, "patch_id string, split string, s1_path string, s2_path string, reference_path string")


def _inventory(spark):
    paths = ["s3://b/S1/a/p1/p1_VV.tif", "s3://b/S2/a/p1/p1_B02.tif", "s3://b/REF/a/p1/p1_reference_map.tif",
             "s3://b/S1/a/p2/p2_VV.tif", "s3://b/S2/a/p2/p2_B02.tif",
             "s3://b/S1/a/p3/p3_VH.tif", "s3://b/S2/a/p3/p3_B03.tif", "s3://b/REF/a/p3/p3_reference_map.tif",
             "s3://b/S1/a/p4/p4_VV.tif", "s3://b/S2/a/p4/x.tif", "s3://b/REF/a/p4/p4_reference_map.tif",
             "s3://b/REF/a/p5/p5_reference_map.tif", "s3://b/unrelated/readme.txt",
             "s3://b/S1/a/p10/x.tif"]  # p10 must not make p1 exist
    return spark.createDataFrame([(p,) for p in paths], "path string")


def test_validate_components(spark):
    v = {r.patch_id: r for r in INV.validate_components(_meta(spark), _inventory(spark)).collect()}
    assert v["p1"].all_exist and v["p1"].s1_exists and v["p1"].ref_exists
    assert not v["p2"].all_exist and v["p2"].s1_exists and not v["p2"].ref_exists
    assert v["p3"].all_exist
    assert not v["p4"].s1_exists and v["p4"].s2_exists
    assert (v["p5"].s1_exists, v["p5"].s2_exists, v["p5"].ref_exists) == (False, False, True)


def test_summary_and_missing(spark):
    val, summary, missing = CK.check(_meta(spark), _inventory(spark), 1.0)
    s = summary.first()
    assert (s.all_files_found, s.not_found, s.total_checked, s.fraction_used) == (2, 3, 5, 1.0)
    assert sorted(r.patch_id for r in missing.collect()) == ["p2", "p4", "p5"]


def test_single_component_anti(spark):
    got = INV.missing_of(_meta(spark), _inventory(spark), "reference_path").collect()
    assert sorted(r.patch_id for r in got) == ["p2"]


def test_splits_missing(spark):
    df = spark.createDataFrame([("train",), ("test",)], "split string")
    assert [r.split for r in INV.splits_missing(df, ["train", "validation", "test"]).collect()] == ["validation"]


def test_list_objects_reads_paths_only(spark, tmp_path):
    for name in ["a/x.tif", "a/y.json", "b/z.tif"]:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"123")
    from rasterprep.sources.objects import list_objects
    df = list_objects(spark, str(tmp_path), suffix=".tif")
    assert sorted(r.path.rsplit("/", 1)[1] for r in df.collect()) == ["x.tif", "z.tif"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_distributed_listing_and_check_files(spark, tmp_path):
    from rasterprep.sources.objects import list_under
    root = tmp_path / "store"
    for rel in ["S1/t1/p1/a.tif", "S2/t1/p1/b.tif", "REF/t1/p1/c.tif", "S1/t1/p2/a.tif", "S2/t2/p3/x/y.tif"]:
        f = root / rel
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"1")
    prefixes = spark.createDataFrame([(str(root / "S1" / "t1"),), (str(root / "nope"),)], "prefix string")
    got = sorted(r.path.rsplit("/", 1)[1] for r in list_under(prefixes).collect())
    assert got == ["a.tif", "a.tif"]
    meta = spark.createDataFrame(
        [("p1", "train", f"{root}/S1/t1/p1", f"{root}/S2/t1/p1", f"{root}/REF/t1/p1"),
         ("p2", "train", f"{root}/S1/t1/p2", f"{root}/S2/t1/p2", f"{root}/REF/t1/p2"),
         ("p3", "test", f"{root}/S1/t2/p3", f"{root}/S2/t2/p3", f"{root}/REF/t2/p3")],
        "patch_id string, split string, s1_path string, s2_path string, reference_path string")
    # local paths: the metadata uses file:// URIs, accepted through ``schemas``
    inv = list_under(CK.listing_prefixes(meta)).select("path")
    uri = meta.withColumns({c: F.concat(F.lit("file://"), F.col(c))
                            for c in ["s1_path", "s2_path", "reference_path"]})
    val = INV.validate_components(uri, inv, schemes=("file",))
    flags = {r.patch_id: (r.s1_exists, r.s2_exists, r.ref_exists) for r in val.collect()}
    assert flags == {"p1": (True, True, True), "p2": (True, False, False), "p3": (False, True, False)}


def test_check_files_end_to_end(spark, tmp_path):
    import glob as _glob
    import json as _json
    root = tmp_path / "store"
    for rel in ["S1/t1/p1/a.tif", "S2/t1/p1/b.tif", "REF/t1/p1/c.tif", "S1/t1/p2/a.tif"]:
        f = root / rel
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"1")
    rows = [(p, "train", f"file://{root}/S1/t1/{p}", f"file://{root}/S2/t1/{p}", f"file://{root}/REF/t1/{p}")
            for p in ("p1", "p2")]
    meta = spark.createDataFrame(rows, "patch_id string, split string, s1_path string, s2_path string, "
                                       "reference_path string")
    CK.check_files(spark, meta, str(tmp_path / "rep"), schemes=("file",))
    s = _json.loads(open(_glob.glob(str(tmp_path / "rep" / "summary" / "part-*.json"))[0]).readline())
    assert (s["all_files_found"], s["not_found"], s["total_checked"], s["fraction_used"]) == (1, 1, 2, 1.0)


def test_listing_scanned_once(spark, tmp_path):
    _inventory(spark).write.parquet(str(tmp_path / "inv"))
    inv = spark.read.parquet(str(tmp_path / "inv"))
    val = INV.validate_components(_meta(spark), inv)
    val.collect()
    plan = val._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # three component joins, one scan of the listing: the folder table is reused
    assert plan.count("FileScan parquet") == 1


def test_listing_is_dealt_over_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    from rasterprep.sources.objects import list_under
    for i in range(40):
        (tmp_path / f"t{i}" / "p").mkdir(parents=True)
        (tmp_path / f"t{i}" / "p" / "a.tif").write_bytes(b"")
        (tmp_path / f"t{i}" / "b.tif").write_bytes(b"")
    prefixes = spark.createDataFrame([(str(tmp_path / f"t{i}"),) for i in range(40)] * 10
                                     + [(str(tmp_path / "none"),), (None,)], "prefix string")
    got = list_under(prefixes, partitions=6, rows_per_batch=7).withColumn("part", F.spark_partition_id())
    rows = got.collect()
    assert len(rows) == 80 and len({r["part"] for r in rows}) > 1
    flat = list_under(prefixes, recursive=False)
    assert flat.count() == 40


def test_invalid_paths_are_missing(spark):
    from rasterprep.operators import inventory as INV
    meta = spark.createDataFrame(
        [("a", "s3://b/x", "s3a://b/y", None), ("b", None, None, None)],
        "patch_id string, s1_path string, s2_path string, reference_path string")
    inv = spark.createDataFrame([("s3://b/x/f.tif",), ("s3a://b/y/f.tif",)], "path string")
    got = {r["patch_id"]: (r["s1_exists"], r["s2_exists"], r["ref_exists"])
           for r in INV.validate_components(meta, inv).collect()}
    assert got == {"a": (True, False, False), "b": (False, False, False)}
