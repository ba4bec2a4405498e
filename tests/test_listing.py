"""Listing in rounds, prefix existence by merging, and the order-preserving index."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rasterprep.operators import inventory as INV
from rasterprep.operators import labels as LB
from rasterprep.operators import ranking as RK
from rasterprep.sources import listing as L


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _make(root, rels):
    for rel in rels:
        f = root / rel
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_bytes(b"")


def test_flat_root_is_dealt_over_pages_and_tasks(spark, tmp_path):
    root, n = tmp_path / "flat", 30_000
    root.mkdir()
    for i in range(n):
        open(root / f"img_{i:06d}.tif", "wb").close()
    roots = spark.createDataFrame([(str(root),)], "prefix string")
    got = L.list_frontier(roots, str(tmp_path / "work"))
    rows = got.select("path").collect()
    assert len(rows) == n and {os.path.basename(r[0]) for r in rows} == {f"img_{i:06d}.tif" for i in range(n)}
    rounds = sorted(p for p in os.listdir(tmp_path / "work") if p.startswith("round"))
    assert 2 < len(rounds) <= 6
    # the pages of the largest round were read by many tasks
    largest = max((spark.read.schema(L._ROUND).parquet(str(tmp_path / "work" / r)).where("kind = 'object'")
                   .withColumn("file", F.col("_metadata.file_name")).groupBy("file").count().collect()
                   for r in rounds), key=len)
    assert len(largest) >= 10 and max(r["count"] for r in largest) <= 3 * L.PAGE_SIZE


@pytest.mark.parametrize("page_size", [2, 7, 1000])
def test_listing_equals_a_walk(spark, tmp_path, page_size):
    rng = random.Random(page_size)
    rels = {"a/b/c/x.tif", "a/b/é ü.tif", "a/~", "a/ ", "z.json"}
    for _ in range(150):
        rels.add("/".join(rng.choice("abc0é~") * rng.randint(1, 3) for _ in range(rng.randint(1, 3))) + f"/f{rng.randint(0, 99)}")
    _make(tmp_path / "store", rels)
    roots = spark.createDataFrame([(str(tmp_path / "store") + "/",), (str(tmp_path / "store"),),
                                   (str(tmp_path / "none"),), (None,)], "prefix string")
    got = L.list_frontier(roots.limit(1).unionByName(roots.where("prefix LIKE '%none' OR prefix IS NULL")),
                          str(tmp_path / "work"), page_size=page_size)
    want = sorted(os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "store") for f in fs)
    assert sorted(r["path"] for r in got.collect()) == want
    flat = L.list_frontier(roots.limit(1), str(tmp_path / "work2"), recursive=False, page_size=page_size)
    assert sorted(r["path"] for r in flat.collect()) == [str(tmp_path / "store" / "z.json")]
    assert L.list_frontier(roots.where("prefix IS NULL"), str(tmp_path / "work3")).count() == 0


def test_a_store_that_answers_ranges_is_asked_for_them_only(spark, tmp_path):
    names = [f"k{i:05d}" for i in range(5000)]
    log = tmp_path / "asked"
    log.mkdir()

    def store(folder, after, upto, limit):
        got = [x for x in names if x > after and (upto is None or x <= upto)][:limit]
        with open(log / str(os.getpid()), "a") as f:
            f.write(f"{len(got)}\n")
        return got

    roots = spark.createDataFrame([("store://bucket/flat",)], "prefix string")
    got = L.list_frontier(roots, str(tmp_path / "work"), page_size=100, reader=store)
    assert sorted(r["path"] for r in got.collect()) == [f"store://bucket/flat/{x}" for x in names]
    sizes = [int(x) for p in log.iterdir() for x in p.read_text().split()]
    assert max(sizes) <= 100 and sum(sizes) == len(names)          # no name is read twice


def test_failing_store_fails_the_listing(spark, tmp_path, monkeypatch):
    def broken(folder, after, upto, limit):
        raise PermissionError("denied")

    with pytest.raises(Exception, match="denied"):
        L.list_frontier(spark.createDataFrame([("s3://b/x",)], "prefix string"), str(tmp_path / "w"), reader=broken)


def test_rest_of_range_covers_everything_after_the_page():
    rng = random.Random(1)
    for _ in range(200):
        names = sorted({"".join(rng.choice("ab01~") for _ in range(rng.randint(1, 5))) for _ in range(30)})
        cut = rng.randint(2, len(names) - 1)
        upto = rng.choice([None, names[-1]])
        ranges = L.rest_of_range(names[:cut], upto)
        assert ranges[0][0] == names[cut - 1] and ranges[-1][1] == upto
        found = [x for a, b in ranges for x in names if x > a and (b is None or x <= b)]
        assert sorted(found) == names[cut:] and len(ranges) <= L.MAX_CUTS + 1


# --- J1/J2 by merging ------------------------------------------------------------------------

def test_existing_prefixes_equal_a_search_over_all_paths(spark):
    rng = random.Random(7)
    parts = ["a", "b", "ab", "a b", "a-", "a0", "é", "~"]
    paths = ["/".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    asked = sorted({"/".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(300)})
    inv = spark.createDataFrame([(f"s3://{p}",) for p in paths] + [(None,)], "path string")
    pre = spark.createDataFrame([(a,) for a in asked * 3] + [(None,)], "folder string")
    want = [a for a in asked if any(p.startswith(a + "/") for p in paths)]
    for ranges in (1, 2, 9, 200):
        got = INV.existing_prefixes(pre, inv, ranges=ranges)
        assert sorted(r["folder"] for r in got.collect()) == sorted(want)
    assert INV.existing_prefixes(pre, inv.where("false")).count() == 0
    assert INV.existing_prefixes(pre.where("false"), inv).count() == 0


def test_no_ancestor_rows_are_made_or_shuffled(spark):
    inv = spark.createDataFrame([(f"s3://b/{i % 5}/x/y/z/{i}.tif",) for i in range(100)], "path string")
    pre = spark.createDataFrame([("b/1/x",), ("b/9",)], "folder string")
    got = INV.existing_prefixes(pre, inv, ranges=4)
    assert [r["folder"] for r in got.collect()] == ["b/1/x"]
    assert "Generate" not in _plan(got) and "SinglePartition" not in _plan(got)


# --- order-preserving index ---------------------------------------------------------------------

@pytest.mark.parametrize("cuts", [0, 1, 5, 255])
def test_ordered_index_equals_sorting(spark, cuts):
    values = sorted({f"v{i * 7919 % 1000}" for i in range(400)} | {"", "é", "~", "Z"})
    df = spark.createDataFrame([(v, len(v) + 1) for v in values], "v string, n int").repartition(7)
    got = {r["v"]: (r["idx"], r["n_before"]) for r in RK.ordered_index(df, "v", sums=["n"], cuts=cuts).collect()}
    before = 0
    for i, v in enumerate(sorted(values, key=lambda x: x.encode())):
        assert got[v] == (i, before)
        before += len(v) + 1


def test_vocabulary_has_no_single_task(spark):
    df = spark.createDataFrame([([f"l{i % 300}", f"l{i % 77}"],) for i in range(1000)], "labels array<string>")
    vocab = LB.label_vocab(df)
    rows = sorted((r["idx"], r["label"]) for r in vocab.collect())
    assert [r[1] for r in rows] == sorted({f"l{i}" for i in range(300)}) and [r[0] for r in rows] == list(range(300))
    assert "SinglePartition" not in _plan(vocab)
    assert LB.label_vocab(df.where("false")).count() == 0
