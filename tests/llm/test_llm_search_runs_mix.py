"""Hard negatives, periodic runs and mixing against brute force, on small and awkward tables."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import LONG, SCHEMA, odd_rows
from pyspark.sql import functions as F

from rasterprep.llm import mixing, queries, recompress, threshold

SF = "/root/testdata/sf0.001"


# --- op11: the threshold algorithm --------------------------------------------------------

def brute_negatives(rows, every):
    """All results by comparing every anchor with every row."""
    ok = [(i, l, [math.floor(256.0 * x) for x in v]) for i, l, v in rows
          if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda t: (-t[1], t[0] is None, t[0] or 0)
    out = []
    for at, (a, la, va) in enumerate(ok):
        if a is None or a % every:
            continue
        score = [(i, sum(p * q for p, q in zip(va, v)), l) for k, (i, l, v) in enumerate(ok) if k != at]
        same = sorted(((i, s) for i, s, l in score if l == la), key=order)[:5]
        for p, ps in same:
            fit = sorted(((i, s) for i, s, l in score if l != la and 50 * ps <= 100 * s <= 95 * ps), key=order)[:3]
            out += [(a, p, r + 1, n, ps, ns) for r, (n, ns) in enumerate(fit)]
    return Counter(out)


VECTORS = "vec_id long, label int, embedding array<float>, score long, block long, id string"


def spark_negatives(spark, rows, every, parts=3, **more):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], VECTORS).repartition(parts)
    return Counter(tuple(r) for r in threshold.hard_negatives(df, every, **more).collect())


def test_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        v = rng.normal(0, 0.2, 12).astype(np.float32)
        if i % 3 == 0:                                  # a third of the rows share a vector: ties
            v = np.full(12, 0.25, np.float32)
        rows.append((i, int(rng.integers(0, 4)), v.tolist()))
    assert spark_negatives(spark, rows, 20) == brute_negatives(rows, 20)
    # many blocks and passes, shallow first readings
    monkeypatch.setattr(threshold, "BLOCK_ROWS", 50)
    monkeypatch.setattr(threshold, "FIRST_DEPTH", 2)
    assert spark_negatives(spark, rows, 20, pass_anchors=7) == brute_negatives(rows, 20)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (10, 1, [0.9, 0.5]), (3, None, [1.0, 1.0]), (4, 2, None),
            (5, 2, [nan, 1.0]), (6, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (9, 2, []), (11, 2, [0.8]),
            (12, 2, [0.7, 0.4]), (None, 2, [0.7, 0.4]), (None, 1, [1.0, 0.5]), (20, 3, [0.0, 0.0]), (21, 3, [0.0]),
            (30, 7, [-1.0, -1.0]), (31, 7, [1.0, 1.0]), (12, 2, [0.7, 0.4])]
    # an empty vector ends with zeros like any shorter one
    assert spark_negatives(spark, rows, 10, 2) == brute_negatives(rows, 10)
    assert spark_negatives(spark, [], 10, 1) == Counter()
    assert spark_negatives(spark, [(1, 1, [1.0])], 10, 1) == Counter()


def test_scan_stops_before_the_end_and_loses_nothing():
    rng = np.random.default_rng(1)
    # a few dominating rows: the threshold falls below them early
    v = rng.integers(-5, 6, (2000, 4)).astype(np.int64)
    v[:10] = 900
    order = np.argsort(v, axis=0, kind="stable").T.astype("<u2")
    block = threshold.Block(1, 2000, np.arange(2000).tobytes(), np.zeros(2000, np.int64).tobytes(),
                            v.astype("<i4").tobytes(), order.tobytes())
    low, high = (np.full((1, 1), x, np.int64) for x in (threshold.LOW, threshold.HIGH))
    best = threshold.Best(low, high, 5)
    scored = threshold.scan(block, np.array([0]), np.array([[3, 2, 1, 1]]), np.array([0]), np.array([-1]), True, best)
    assert scored < 1000
    s = v @ np.array([3, 2, 1, 1])
    assert best.id[0, 0].tolist() == sorted(range(2000), key=lambda i: (-s[i], i))[:5]


def test_hard_negatives_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(queries.SQL["op11_hard_negatives"]).fetchall()
    got = [tuple(r) for r in queries.op11_hard_negatives(spark, SF).collect()]
    assert got and sorted(got) == sorted(want)


# --- op12: periodic runs --------------------------------------------------------------------

def brute_runs(words):
    found = {}
    n = len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def repeated_texts(rng, n):
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            base = [f"w{rng.randint(0, rng.choice([0, 1, 30]))}" for _ in range(rng.randint(1, 8))]
            words += base * rng.choice([1, 1, 3, 4, 5, 11, 40])
        out.append(rng.choice([" ", "\n", " \t"]).join(words))
    return out


def test_runs_equal_brute_force(spark):
    texts = [*repeated_texts(random.Random(5), 150), "", None, "a", " ".join(["x"] * 6), " ".join(["x"] * 5),
             "é " * 9, "a b " * 7]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["id"]: r for r in recompress.periodic_runs(df).withColumn("best", recompress.longest_run()).collect()}
    for i, text in enumerate(texts):
        words = split_words(text)
        want = brute_runs(words)
        assert got[i]["n_words"] == len(words)
        assert [tuple(r) for r in got[i]["runs"]] == want
        assert got[i]["collapsed"] == brute_collapsed(words, want)
        best = min(want, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert (tuple(got[i]["best"]) if got[i]["best"] else None) == best


def test_extensions_equal_plain_comparison():
    rng = random.Random(2)
    for _ in range(30):
        t = [rng.randint(0, 2) for _ in range(150)] + [1] * rng.randint(0, 60) + [0, 1] * 30
        seq = np.array([9, *t, 10])
        g = recompress.Grammar(seq, 9)
        x = np.array([rng.randint(1, len(t)) for _ in range(150)])
        y = np.array([rng.randint(1, len(t)) for _ in range(150)])
        x, y = x[x != y], y[x != y]
        for back, step in ((False, 1), (True, -1)):
            for i, j, got in zip(x.tolist(), y.tolist(), g.extend(x, y, back).tolist()):
                k = 0
                while seq[i + step * k] == seq[j + step * k]:
                    k += 1
                assert got == k


def test_grid_is_cut_into_portions(monkeypatch):
    words = np.array([0, 1, 2] * 200 + list(range(3, 300)) + [7] * 50)
    whole = recompress.find_runs(words, np.array([len(words)]))
    monkeypatch.setattr(recompress, "GRID_ROWS", 7)
    assert all((a == b).all() for a, b in zip(whole, recompress.find_runs(words, np.array([len(words)]))))
    assert whole[1].tolist() == [0, 897] and whole[3].tolist() == [3, 1]


def test_runs_of_odd_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    got = sorted((r["id"] is None, r["id"], r["n_words"], r["collapsed"]) for r in recompress.periodic_runs(df).collect())
    want = sorted((r[0] is None, r[0], len(split_words(r[1])),
                   brute_collapsed(split_words(r[1]), brute_runs(split_words(r[1])) if len(r[1] or "") < 5000 else []))
                  for r in odd_rows())
    assert got == want and any(n > 20_000 for _, _, n, _ in got)
    assert recompress.periodic_runs(df.where("false")).collect() == []


def test_runs_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op12_periodic_runs(spark, SF).collect()
    assert len(rows) == len(docs)
    planted = 0
    for r in rows:
        words = split_words(docs[r["doc_id"]])
        n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None) and r["n_runs"] == len(runs)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert planted and any(r["n_runs"] for r in rows)


# --- op13: mixing ---------------------------------------------------------------------------

def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by giving out the excess round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = {s: weight[s] for s in names if s not in full}
        if not left:
            return full
        share = (total - sum(full.values())) / sum(left.values())
        over = [s for s in left if left[s] * share >= cap * sizes[s]]
        if not over:
            return full | {s: w * share for s, w in left.items()}
        full |= {s: cap * sizes[s] for s in over}


def check_mix(rows, docs, near):
    sizes, source = Counter(), {}
    for d, s, text in docs:
        sizes[s] += len(split_words(text))
    targets = brute_targets(dict(sizes))
    assert len(rows) == len(docs)
    by_doc = {d: (s, len(split_words(t))) for d, s, t in docs}
    taken = Counter()
    for r in rows:
        s, n = by_doc[r["id"]]
        assert r["size"] == n and r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 3 * n
        taken[s] += r["taken"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= near(t), (s, t, taken[s])


def test_targets_are_met_with_a_hot_source_and_small_ones(spark):
    rng = random.Random(4)
    docs = []
    for i in range(1500):
        s = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None, "é", "Z"])
        docs.append((i, s, " ".join(["w"] * rng.randint(0, 400))))
    docs += [(9000, "tiny", "just four words here"), (9001, "empty", ""), (9002, "empty", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(5)
    first = mixing.mixed_counts(df).collect()
    check_mix(first, docs, lambda t: 0.03 * t + 64)
    # a rerun over other partitions takes the same words
    again = mixing.mixed_counts(df.repartition(2)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))
    other = mixing.mixed_counts(df, seed=1).collect()
    assert sorted(map(tuple, first)) != sorted(map(tuple, other))


def test_mixture_spans_add_up_to_the_counts(spark):
    docs = [(i, f"s{i % 4}", " ".join(f"w{j}" for j in range(20 + 7 * i))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    small = {"block_words": 16, "shard_slots": 64}
    spans = mixing.mixture(df, **small).collect()
    per_doc, per_slot = Counter(), Counter()
    for r in spans:
        assert 0 <= r["first"] and r["first"] + r["words"] <= 20 + 7 * r["id"]
        per_doc[r["id"]] += r["words"]
        per_slot[(r["source_nth"], r["slot"])] += r["words"]
    assert max(per_slot.values()) == 16 and len({r["shard"] for r in spans}) > 1
    assert {r["id"]: r["taken"] for r in mixing.mixed_counts(df, **small).collect()} == {d: per_doc[d] for d, _, _ in docs}
    # within one pass over a source no block is taken twice
    last, passes = {}, {}
    for r in spans:
        last[r["source_nth"]] = max(last.get(r["source_nth"], 0), r["block"])
    words = Counter()
    for i, s, t in docs:
        words[int(s[1:])] += len(split_words(t))
    for r in spans:
        blocks = -(-words[r["source_nth"]] // 16)
        passes.setdefault((r["source_nth"], r["slot"] // blocks, r["block"]), set()).add(r["slot"])
    assert all(b < -(-words[s] // 16) for s, b in last.items())
    assert all(len(slots) == 1 for slots in passes.values())


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation_is_one(spark, n):
    df = spark.range(n).withColumn("n", F.lit(n).cast("long")).withColumn("k", F.lit(5))
    got = [r["p"] for r in df.select(mixing.permuted("id", "n", "k", seed=3).alias("p")).collect()]
    assert sorted(got) == list(range(n)) and (n < 64 or got != list(range(n)))


def test_mix_of_odd_rows(spark):
    rows = [(r[0], "src" if r[0] else None, r[1], 1, 2, 3, "x") for r in odd_rows()]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size long, idx long, start long, skey string")
    got = mixing.mixed_counts(df).collect()
    assert Counter((r["id"], r["size"]) for r in got) == Counter((r[0], len(split_words(r[2]))) for r in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    words = len(split_words(LONG))
    assert any(r["size"] == words and r["taken"] > 0 for r in got)
    assert mixing.mixed_counts(df.where("false")).collect() == []
    blank = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert sorted((r["id"], r["taken"], r["target"]) for r in mixing.mixed_counts(blank).collect()) == [(1, 0, 0.0), (2, 0, 0.0)]
