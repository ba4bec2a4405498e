"""Property-based numpy parity for the array functions (fixed seed, few examples:
each example is one Spark job over a batch of generated rasters)."""

import numpy as np
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from rasterprep.functions import arrays as A

shapes = st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6)), min_size=1, max_size=12)


@settings(max_examples=5, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(shapes=shapes, target=st.tuples(st.integers(1, 7), st.integers(1, 7)))
def test_pad_matches_numpy(spark, shapes, target):
    rng = np.random.default_rng(0)
    rows = [(rng.integers(0, 50, s).reshape(-1).tolist(), s[0], s[1]) for s in shapes]
    df = spark.createDataFrame(rows, "px array<int>, h int, w int")
    got = [r[0] for r in df.select(A.pad_to_size("px", "h", "w", *target)).collect()]
    for (px, h, w), g in zip(rows, got):
        arr = np.array(px).reshape(h, w)
        want = np.pad(arr, [(0, max(0, t - c)) for t, c in zip(target, arr.shape)])
        assert g == want.reshape(-1).tolist()


@settings(max_examples=5, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(1, 30), min_size=1, max_size=10), bands=st.integers(1, 5))
def test_stack_matches_numpy(spark, sizes, bands):
    rng = np.random.default_rng(1)
    rows = [tuple(rng.random(n).astype(np.float32).tolist() for _ in range(bands)) for n in sizes]
    schema = ", ".join(f"b{i} array<float>" for i in range(bands))
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(A.stack_bands(*[f"b{i}" for i in range(bands)])).collect()]
    for row, g in zip(rows, got):
        want = np.stack([np.array(b, dtype=np.float32) for b in row], axis=-1).reshape(-1)
        assert np.array_equal(np.array(g, dtype=np.float32), want)
