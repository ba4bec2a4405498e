from pyspark.sql import functions as F

from rasterprep.functions import paths as P
from rasterprep.operators import raster as R

PREFIX_CASES = [
    ("a_b_c_d_e", "a_b_c_d_e"),
    ("a_b_c_d_e_", "a_b_c_d_e"),
    ("a_b", "a_b"),
    ("_a_b_c_d_e_f", "_a_b_c_d_e"),
    ("a__b_c_d_e_f_g", "a__b_c_d_e_f"),
    ("", ""),
    (None, None),
    ("S1A_IW_GRDH_1SDV_20170613T165043_33UUP_33_62", "S1A_IW_GRDH_1SDV_20170613T165043"),
]


def test_s1_prefix_edges(spark):
    df = spark.createDataFrame(PREFIX_CASES, "v string, want string")
    got = df.select(P.s1_prefix("v").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_s2_prefix_six_fields(spark):
    df = spark.createDataFrame([("S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP_26_57",),
                                ("S2A_MSIL2A_20170613T101031_33_62_patch123",)], "v string")
    got = [r[0] for r in df.select(P.s2_prefix("v")).collect()]
    assert got[0] == "S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP"
    # a 6-field value does not match the 7+-field rule and stays unchanged
    assert got[1] == "S2A_MSIL2A_20170613T101031_33_62_patch123"


def test_with_paths_and_nulls(spark):
    meta = spark.createDataFrame(
        [("S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP_26_57",
          "S1A_IW_GRDH_1SDV_20170613T165043_33UUP_26_57", "train", 7),
         ("S2A_MSIL2A_X_N_R_T_1_2", None, "test", 8)],
        "patch_id string, s1_name string, split string, extra int")
    out = R.with_paths(meta, "s3://bucket/archive/").collect()
    assert out[0].s1_path == ("s3://bucket/archive/BigEarthNet-S1/S1A_IW_GRDH_1SDV_20170613T165043/"
                              "S1A_IW_GRDH_1SDV_20170613T165043_33UUP_26_57")
    assert out[0].s2_path == ("s3://bucket/archive/BigEarthNet-S2/S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP/"
                              "S2A_MSIL2A_20170613T101031_N9999_R022_T33UUP_26_57")
    assert out[0].reference_path.startswith("s3://bucket/archive/Reference_Maps/")
    assert out[0].extra == 7  # other columns pass through
    assert out[1].s1_path is None and out[1].s2_path is not None


def test_scheme_functions(spark):
    df = spark.createDataFrame([("s3a://b/k/x",), ("s3://b/k/",), ("rel/p",), ("/abs/p",), (None,)], "u string")
    rows = df.select(P.strip_scheme("u").alias("s"), P.normalize_uri("u", cwd="/w").alias("n"),
                     P.valid_uri("u").alias("v")).collect()
    assert [r.s for r in rows] == ["b/k/x", "b/k/", "rel/p", "/abs/p", None]
    assert [r.n for r in rows] == ["s3://b/k/x", "s3://b/k/", "file:///w/rel/p", "file:///abs/p", None]
    assert [r.v for r in rows] == [False, True, False, False, False]
    kb = df.select(P.bucket_of(P.strip_scheme("u")).alias("b"), P.key_of(P.strip_scheme("u")).alias("k"),
                   P.ensure_trailing_slash(P.strip_scheme("u")).alias("t")).collect()
    assert kb[0].b == "b" and kb[0].k == "k/x" and kb[1].t == "b/k/"


def test_run_key_parsing(spark):
    keys = ["u/e/petastorm/frac_0.05/exec_8/profile/conversion_profile.json",
            "u/e/frac_0.1/x/frac_0.2/exec_1/exec_5/train_gpu3_profile.json",
            "u/e/frac_abc/exec_/train_4gpu_profile.json",
            "u/e/noparts.json"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    rows = df.select(P.run_fraction("k").alias("last"), P.run_fraction("k", last=False).alias("first"),
                     P.run_executors("k").alias("ex"), P.gpu_count("k").alias("g"),
                     P.gpu_count_any("k").alias("ga"), P.fraction_regex("k").alias("fr")).collect()
    assert rows[0].last == 0.05 and rows[0].ex == 8 and rows[0].g is None
    assert rows[1].last == 0.2 and rows[1].first == 0.1 and rows[1].ex == 5 and rows[1].g == 3
    assert rows[2].last is None and rows[2].ex is None and rows[2].g is None and rows[2].ga == 4
    assert rows[3].last is None and rows[3].fr is None


def test_fraction_label_half_even(spark):
    vals = [0.01, 0.05, 0.1, 0.2, 0.125, 0.135, 0.005]
    df = spark.createDataFrame([(v,) for v in vals], "f double")
    got = [r[0] for r in df.select(P.fraction_label("f")).collect()]
    assert got == [f"{v * 100:.0f}%" for v in vals]


def test_output_dir(spark):
    df = spark.createDataFrame([(0.05, 8)], "f double, n int")
    got = df.select(P.output_dir(F.lit("s3://b/u"), F.lit("exp"), "f", "n")).first()[0]
    assert got == "s3://b/u/exp/petastorm/frac_0.05/exec_8"
