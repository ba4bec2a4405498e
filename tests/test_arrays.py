import numpy as np

from rasterprep import schemas
from rasterprep.functions import arrays as A
from rasterprep.operators import labels as LB
from rasterprep.operators import raster as R


def test_remap_classes_golden(spark):
    df = spark.createDataFrame([([111, 112, 999, 5, 311],), ([111, 1000],), ([-1],)], "px array<int>")
    rows = df.select(A.remap_classes("px").alias("idx"), A.has_null(A.remap_classes("px")).alias("bad")).collect()
    assert rows[0].idx == [0, 1, 44, 0, 22] and rows[0].bad is False
    assert rows[1].idx == [0, None] and rows[1].bad is True
    assert rows[2].bad is True


def test_code_lookup_matches_array_form(spark):
    codes = list(range(0, 1005, 7)) + [111, 999, 1000]
    df = spark.createDataFrame([(c,) for c in codes], "code int")
    rel = {r.code: (r.idx, r.status) for r in R.code_lookup(df, "code").collect()}
    lut = schemas.class_lut()
    for c in codes:
        if c < 1000:
            assert rel[c] == (lut[c], "ok")
        else:
            assert rel[c] == (None, "code_out_of_range")


def test_stack_and_concat_match_numpy(spark):
    rng = np.random.default_rng(7)
    h, w = 3, 5
    bands = [rng.random((h, w)).astype(np.float32) for _ in range(6)]
    row = tuple(b.reshape(-1).tolist() for b in bands)
    df = spark.createDataFrame([row], ", ".join(f"b{i} array<float>" for i in range(6)))
    s1 = A.stack_bands("b0", "b1")
    s2 = A.stack_bands("b2", "b3", "b4", "b5")
    got = df.select(A.concat_channels(s1, 2, s2, 4).alias("img")).first().img
    want = np.concatenate([np.stack(bands[:2], -1), np.stack(bands[2:], -1)], -1).astype(np.float32)
    assert np.allclose(np.array(got, dtype=np.float32), want.reshape(-1))


def test_stack_rejects_unequal(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    assert df.select(A.stack_bands("a", "b")).first()[0] is None


def test_pad_to_size_matches_numpy(spark):
    rng = np.random.default_rng(3)
    shapes = [(2, 2), (3, 5), (4, 4), (6, 2), (7, 9)]
    target = (4, 4)
    rows = [(rng.integers(0, 100, s).reshape(-1).tolist(), s[0], s[1]) for s in shapes]
    df = spark.createDataFrame(rows, "px array<int>, h int, w int")
    got = df.select(A.pad_to_size("px", "h", "w", *target).alias("p")).collect()
    for (px, h, w), r in zip(rows, got):
        arr = np.array(px).reshape(h, w)
        want = np.pad(arr, [(0, max(0, t - c)) for t, c in zip(target, arr.shape)], constant_values=0)
        assert r.p == want.reshape(-1).tolist()


def test_display_rgb_clip(spark):
    df = spark.createDataFrame([([0.0, 3000.0, 6000.0], [1500.0, -1.0, 30.0], [3.0, 2999.0, 9e9])],
                               "r array<double>, g array<double>, b array<double>")
    got = df.select(A.display_rgb("r", "g", "b")).first()[0]
    want = np.clip(np.stack([[0.0, 3000.0, 6000.0], [1500.0, -1.0, 30.0], [3.0, 2999.0, 9e9]], -1) / 3000, 0, 1)
    assert np.allclose(got, want.reshape(-1))


def test_multi_hot_and_rejects(spark):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, []), (3, ["c"])], "id int, labels array<string>")
    vocab = LB.label_vocab(df.where("id < 3"))
    assert [(r.label, r.idx) for r in vocab.orderBy("idx").collect()] == [("a", 0), ("b", 1)]
    hot = {r.id: r.multi_hot for r in LB.with_multi_hot(df, vocab, "id").collect()}
    assert hot[1] == [1, 1] and hot[2] == [0, 0] and hot[3] is None
    rej = LB.multi_hot_rejects(df, vocab, "id").collect()
    assert [(r.id, r.reason, r.detail) for r in rej] == [(3, "unknown_label", "c")]


def test_shape_and_cast(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], 2, 2), ([1, 2, 3], 2, 2)], "px array<int>, h int, w int")
    assert [r[0] for r in df.select(A.shape_ok("px", "h", "w")).collect()] == [True, False]
    assert df.select(A.cast_items("px", "tinyint")).schema[0].dataType.elementType.typeName() == "byte"


def test_assemble_patch_partition_invariant(spark):
    rows = [(f"p{i % 50}", str(b), float(i)) for i in range(400) for b in (1, 2, 3)]
    df = spark.createDataFrame(rows, "patch_id string, band string, pixels double")
    want = sorted(tuple(r) for r in R.assemble_patch(df, ["1", "2", "3"]).collect())
    for parts in (1, 4, 17):
        got = sorted(tuple(r) for r in R.assemble_patch(df.repartition(parts), ["1", "2", "3"]).collect())
        assert got == want
    # repeated (patch, band) pairs resolve to the max, whatever the order
    assert dict((r[0], r[1]) for r in want)["p0"] == max(float(i) for i in range(400) if i % 50 == 0)
