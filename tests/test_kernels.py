"""Batch kernels give what the column functions and numpy give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterprep.functions import arrays as A
from rasterprep.operators import kernels as K
from rasterprep.operators import labels as LB


def _bands(spark, n=3000):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        k = int(rng.integers(0, 7))
        rows.append((i, *[[float(x) for x in rng.integers(0, 99, k)] for _ in range(3)]))
    rows[5] = (5, [1.0], [2.0, 3.0], [4.0])
    rows[6] = (6, None, [2.0], [4.0])
    rows[7] = (7, [1.0, None], [2.0, 3.0], [None, None])
    return spark.createDataFrame(rows, "id long, a array<float>, b array<float>, c array<float>").repartition(3)


def test_stacking_equals_the_column_function(spark):
    df = _bands(spark)
    for frame in (df, df.where("id NOT IN (5, 6, 7)")):
        got = {r["id"]: r["image"] for r in K.with_stacked(frame, ["a", "b", "c"]).collect()}
        want = {r["id"]: r["image"] for r in frame.select("id", A.stack_bands("a", "b", "c").alias("image")).collect()}
        assert got == want
    assert K.with_stacked(df.where("false"), ["a", "b"]).count() == 0


def test_channels_are_concatenated(spark):
    df = _bands(spark).where("id NOT IN (5, 6, 7)").withColumn("ab", A.stack_bands("a", "b"))
    got = {r["id"]: r["image"] for r in K.with_stacked(df, [("ab", 2), ("c", 1)]).collect()}
    want = {r["id"]: r["w"] for r in df.select("id", A.stack_bands("a", "b", "c").alias("w")).collect()}
    assert got == want
    uneven = spark.createDataFrame([([1, 2, 3], [4])], "ab array<int>, c array<int>")
    assert K.with_stacked(uneven, [("ab", 2), ("c", 1)]).first()["image"] is None
    with pytest.raises(ValueError, match="one item type"):
        K.with_stacked(df.withColumn("d", F.array(F.lit(1))), ["a", "d"])


@pytest.mark.parametrize("target", [(0, 0), (3, 3), (5, 2)])
def test_padding_equals_numpy(spark, target):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(2500):
        h, w = (int(x) for x in rng.integers(1, 5, 2))
        rows.append((i, h, w, [int(x) for x in rng.integers(0, 9, h * w)]))
    rows += [(9000, 2, 2, [1, 2, 3]), (9001, None, 1, [1]), (9002, 1, 1, None), (9003, 0, 0, []), (9004, 1, 2, [None, 7])]
    df = spark.createDataFrame(rows, "id long, h int, w int, px array<int>").repartition(2)
    got = {r["id"]: r["padded"] for r in K.with_padded(df, "px", "h", "w", *target, pad_value=-1).collect()}
    for i, h, w, px in rows:
        if px is None or h is None or h * w != len(px):
            assert got[i] is None
            continue
        full = np.full((max(h, target[0]), max(w, target[1])), -1, object)
        full[:h, :w] = np.array(px, object).reshape(h, w)
        assert got[i] == full.reshape(-1).tolist()


def test_multi_hot_by_lookup_equals_multi_hot_by_join(spark):
    rows = [(i, [f"l{(i * k) % 9}" for k in range(i % 4)]) for i in range(300)]
    rows += [(900, None), (901, []), (902, ["zzz"]), (903, ["l1", None, "l1"]), (904, [None])]
    df = spark.createDataFrame(rows, "id long, labels array<string>")
    vocab = LB.label_vocab(df.where("id < 900"))
    small = {r["id"]: r["multi_hot"] for r in LB.with_multi_hot(df, vocab, "id").collect()}
    large = {r["id"]: r["multi_hot"] for r in LB.with_multi_hot(df, vocab, "id", small_vocab=2).collect()}
    assert small == large
    names = [f"l{i}" for i in range(9)]
    assert small[903] == [int(n == "l1") for n in names] and small[904] == small[901] == [0] * 9
    assert small[900] is None and small[902] is None
    assert all(small[i] == [int(n in labels) for n in names] for i, labels in rows if i < 900)
    plan = LB.with_multi_hot(df, vocab, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    none = vocab.where("false")
    assert {r["id"]: r["multi_hot"] for r in LB.with_multi_hot(df, none, "id").collect()}[901] == []
