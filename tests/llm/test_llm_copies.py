"""Fingerprints, exact copies and near copies against brute force."""

import hashlib
import itertools
import random
import re
import struct
import time

import numpy as np
import pytest
import xxhash
from llm_fixtures import SCHEMA, odd_rows
from pyspark.sql import functions as F

from rasterprep.llm import adaptjoin, components, fuse, iblt
from rasterprep.llm.common import SHUFFLE_CLEANUP, materialize
from rasterprep.llm.components import connected


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


# --- fingerprints -----------------------------------------------------------------------------

def test_next_and_edited_texts(spark):
    rng = random.Random(1)
    ids = rng.sample(range(0, 5000), 60) + [10**15, 10**15 + 7]
    rows = [(i, "".join(rng.choice("abé日 \n") for _ in range(rng.randint(0, 40)))) for i in ids]
    got = {r["id"]: r for r in iblt.with_edit(iblt.with_next(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5))).collect()}
    order = sorted(rows, reverse=True)
    for (i, text), (_, nxt) in zip(order, order[1:] + order[:1]):
        k = len(text) // 3
        assert got[i]["next"] == nxt and got[i]["edited"] == text[:len(text) - k] + nxt[:k]


def test_peeled_likeness_equals_the_sets(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(60):
        x = rng.sample(range(1, 10**15), rng.randint(1, 24))
        y = rng.sample(x, rng.randint(0, len(x))) + rng.sample(range(1, 10**15), rng.randint(1, 24))
        rows.append((x, y))
    df = spark.createDataFrame(rows, "x array<long>, y array<long>").select(
        F.transform("x", lambda v: F.xxhash64(v)).alias("x"), F.transform("y", lambda v: F.xxhash64(v)).alias("y"))
    for cells in (37, 149):
        got = df.select(F.expr(iblt.peel(iblt.subtract(iblt.sketch("x", cells), iblt.sketch("y", cells)), cells)).alias("d"),
                        F.size(F.array_except("x", "y")).alias("a"), F.size(F.array_except("y", "x")).alias("b")).collect()
        peeled = [r for r in got if r["d"] is not None]
        assert len(peeled) >= (30 if cells == 37 else 58)
        assert all((r["d"]["a"], r["d"]["b"]) == (r["a"], r["b"]) for r in peeled)


def test_fingerprints_of_odd_rows(odd):
    got = iblt.fingerprints(odd).collect()
    assert len(got) == len(odd_rows())
    by_hash = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_hash.setdefault(r["edited_sha256"], set()).add(r["edited_fingerprint"])
    assert all(len(v) == 1 for v in by_hash.values())
    long = next(r for r in got if r["id"] == 11)
    assert long["near_edited"] > 0.3
    assert {r["fingerprint"] for r in got if r["id"] == 1} == {r["fingerprint"] for r in got if r["id"] == 12}
    assert iblt.fingerprints(odd.where("false")).count() == 0
    assert iblt.fingerprints(odd.where("doc_id IS NULL")).count() == 1


def test_single_document_is_its_own_next(spark):
    one = spark.createDataFrame([(5, "alpha beta gamma delta epsilon zeta")], "doc_id long, text string")
    r = iblt.fingerprints(one).first()
    assert r["near_next"] == 1.0 and r["n_chars"] == 35


def test_likeness_of_edited_copies(spark):
    """An early insertion, scattered changes of a long text, and a text within a longer one."""
    words = [f"w{i}" for i in range(100_000)]
    changed = [w + "x" if i % 7_000 == 3_000 else w for i, w in enumerate(words)]
    pairs = [("early", words[:2_000], ["new"] + words[:2_000]), ("scattered", words, changed),
             ("inside", words[:3_000], words[:1_000]), ("same", ["a"] * 500, ["a"] * 501),
             ("other", words[:400], words[5_000:5_400])]
    rows = [(2 * i + 1 - j, " ".join(t)) for i, p in enumerate(pairs) for j, t in enumerate(p[1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    next_of = {r["id"]: r["near_next"] for r in iblt.fingerprints(docs).collect()}
    got = {n: next_of[2 * i + 1] for i, (n, _, _) in enumerate(pairs)}
    assert got["early"] > 0.95 and got["scattered"] > 0.99 and 0.25 < got["inside"] < 0.42
    assert got["same"] > 0.3 and got["other"] == 0
    sets = {r["doc_id"]: set(r["t_digests"]) for r in iblt.paragraphs(docs, "text", "t").collect()}
    assert all(got[n] == len(sets[2 * i + 1] & sets[2 * i]) / len(sets[2 * i + 1] | sets[2 * i])
               for i, (n, _, _) in enumerate(pairs))


def _plain_digests(text):
    """Paragraph digests in plain Python."""
    def h(raw, seed=42):
        return xxhash.xxh64_intdigest(raw, seed)

    words = [h(w.encode()) for w in re.split("[\\x20\\x09-\\x0D]+", text) if w]
    runs, run = [], []
    for i, w in enumerate(words):
        if run and (len(run) == iblt.MAX_WORDS or (words[i - 1] ^ (w >> 23)) % iblt.MEAN_WORDS == 0):
            runs.append(run)
            run = []
        run.append(w)
    out = set()
    for run in runs + [run] * bool(run):
        seed = 42
        for w in run:
            seed = h(struct.pack("<Q", w), seed)
        out.add(seed)
    return out


def _plain_fingerprint(keys):
    blocks = 1
    while blocks * iblt.BLOCK_DIGESTS < len(keys):
        blocks *= 2
    size, out = iblt.ROW_CELLS[0], []
    for j in range(blocks):
        cells = [[0, 0, 0] for _ in range(3 * size)]
        for k in keys:
            if (k >> 51) % blocks == j:
                check = xxhash.xxh64_intdigest(struct.pack("<i", 7), xxhash.xxh64_intdigest(struct.pack("<Q", k), 42))
                for r in range(3):
                    at = k >> 17 * r
                    at = (at - (1 << 64) if at >> 63 else at) % size
                    c = cells[r * size + at]
                    c[0], c[1], c[2] = c[0] + 1, c[1] ^ k, c[2] ^ check
        out += [f"{n:02x}{k:016x}{h & 0xFFFFFFFF:08x}" for n, k, h in cells]
    return f"iblt2:{blocks}:{len(keys)}:" + "".join(out)


def test_fingerprints_equal_plain_sketches(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(300)}é" for _ in range(n))) for i, n in enumerate([0, 1, 9, 200, 900, 2500])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    edits = {r["id"]: r["edited"] for r in iblt.with_edit(iblt.with_next(docs)).collect()}
    for r in iblt.fingerprints(docs).collect():
        text, edited = rows[r["id"]][1], edits[r["id"]]
        a, e = _plain_digests(text), _plain_digests(edited)
        assert r["fingerprint"] == _plain_fingerprint(a) and r["edited_fingerprint"] == _plain_fingerprint(e)
        assert r["near_edited"] == (len(a & e) / len(a | e) if a | e else 1.0)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_ranges_hold_like_numbers_of_rows_whatever_the_ids(spark):
    n = 40 * iblt.RANGE_IDS
    ids = spark.range(n).select("id", F.lit("t").alias("text"))
    for rows in (ids, ids.unionByName(spark.createDataFrame([(10**15, "t"), (-10**18, "t")], "id long, text string"))):
        ranged, lasts = iblt.with_ranges(rows)
        sizes = [r["count"] for r in ranged.groupBy("range").count().collect()]
        assert max(sizes) < 0.05 * n and lasts.count() == len(sizes)
    no_id = spark.range(3000).select(F.lit(None).cast("long").alias("id"), F.col("id").cast("string").alias("text"))
    assert iblt.with_ranges(no_id)[0].groupBy("range").count().agg(F.max("count")).first()[0] < 100


def test_fingerprint_plan_has_no_python(odd):
    plan = iblt.fingerprints(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- exact copies -------------------------------------------------------------------------------

def test_filter_never_misses_and_seldom_errs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 10, 1000, 20_000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        filt = fuse.build_filter(keys)
        assert fuse.might_hold(filt, keys).all()
        other = rng.integers(0, 1 << 63, 50_000).astype(np.uint64) | np.uint64(1 << 63)
        assert fuse.might_hold(filt, other).mean() < 0.001
    assert len(fuse.build_filter(np.arange(20_000, dtype=np.uint64))["cells"]) < 20_000 * 2 * 1.5


def _brute_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None, len(ids), hashlib.sha256(norm.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_exact_dedup_of_odd_rows(odd, batches):
    got = fuse.exact_dedup(odd, batches=batches).collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["sha"]) for r in got), key=str) == \
        _brute_groups([(r[0], r[1]) for r in odd_rows()])
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["sha"] for r in got}) and all(r["id"] == r["keep_id"] for r in kept)


def test_exact_dedup_with_a_third_of_equal_rows(spark):
    rng = random.Random(4)
    rows = [(i, "same  text" if i % 3 == 0 else f"text {rng.randint(0, 300)}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = fuse.exact_dedup(docs, batches=3).collect()
    assert sorted(((r["id"], r["keep_id"], r["group_size"], r["sha"]) for r in got), key=str) == _brute_groups(rows)


def test_dedup_keeps_whole_rows(odd):
    kept = fuse.keep_rows(odd, fuse.exact_dedup(odd))
    assert kept.columns == odd.columns
    rows = kept.collect()
    groups = {(str(k), sha) for _, k, _, sha in _brute_groups([(r[0], r[1]) for r in odd_rows()])}
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(k for k, _ in groups)
    assert len(rows) == len({fuse_norm(r["text"]) for r in rows})
    assert fuse.exact_dedup(odd.where("false")).count() == 0


def fuse_norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


# --- near copies ----------------------------------------------------------------------------------

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _sets(rows, width):
    out = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if x]
        out[i] = frozenset(tuple(w[j:j + width]) for j in range(len(w) - width + 1)) if len(w) >= width \
            else frozenset([tuple(w)] if w else [])
    return out


def _brute_components(rows, width, percent):
    sets = _sets(rows, width)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def _copies(seed):
    """Families of near copies of all degrees, a large one, shared passages, short texts."""
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(40)]
    rows, i = [], 0
    for family in range(14):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 5, 12, 40, 120]))]
        if family % 3 == 0:
            base += passage
        for _ in range(40 if family == 13 else rng.randint(1, 7)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = rng.choice(vocab).upper()
            rows.append((i, (rng.choice([" ", "\n", "  "])).join(words)))
            i += 1
    return rows


@pytest.mark.parametrize("seed,width,percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_components_equal_brute_force(spark, seed, width, percent):
    rows = _copies(seed)
    got = adaptjoin.near_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4),
                                    width, percent).collect()
    assert sorted(map(tuple, got)) == _brute_components(rows, width, percent)


def test_components_when_elements_are_dealt_and_prefixes_long(spark, monkeypatch):
    monkeypatch.setattr(adaptjoin, "GROUP_ROWS", 3)
    monkeypatch.setattr(adaptjoin, "CANDIDATES", 1)
    rows = _copies(5)
    got = adaptjoin.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(map(tuple, got)) == _brute_components(rows, 4, 85)


def test_copies_of_a_text_link_with_a_longer_one_at_the_limit(spark):
    """The copied text asks for more shared elements than the longer one has with it."""
    rows = []
    for family, copies in enumerate((8, 16, 32, 64, 128)):
        words = [f"f{family}w{j}" for j in range(88)]                # 85 shingles of 4 words
        rows += [(len(rows) + j, " ".join(words)) for j in range(copies)]
        for more in (15, 16):                                        # 85 of 100 link, 85 of 101 do not
            rows.append((len(rows), " ".join(words + [f"f{family}m{more}n{j}" for j in range(more)])))
    got = adaptjoin.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(map(tuple, got)) == _brute_components(rows, 4, 85)


def test_near_copies_of_odd_rows(odd):
    got = adaptjoin.near_components(odd, 4, 85)
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["id"], set()).add(r["component_id"])
    assert by_id[3] == {3} and by_id[9] == {9} and by_id[12] == {1} and by_id[10] == {1} and by_id[4] == {1}
    assert by_id[11] == {5} and by_id[7] == {1} and by_id[None] == {None}
    assert got.count() == len(odd_rows())
    kept = adaptjoin.keep_rows(odd, got)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 5, 6, 8, 9, None}
    assert adaptjoin.near_components(odd.where("false"), 4, 85).count() == 0


def test_a_third_of_the_rows_without_an_id_and_a_third_with_one(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghijklmnop") * 2 + str(rng.randint(0, 40)) for _ in range(60)) for _ in range(90)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 1000 + i, t) for i, t in enumerate(texts)]
    # near copies: without an id of one with an id, with the repeated id of one without
    rows += [(None, rows[2][1] + " tail"), (7, rows[0][1] + " tail"), (7, rows[0][1] + " tail"), (None, None), (7, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, id string, t int").repartition(3)
    got = adaptjoin.near_components(df, 4, 85).collect()
    assert len(got) == len(rows)
    kept = adaptjoin.near_dedup(df, 4, 85)
    assert kept.columns == df.columns
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    want = set(rows) - {(None, rows[2][1] + " tail"), rows[0]}       # the row with an id stays
    assert left == sorted(want, key=str)


def test_near_dedup_keeps_one_row_of_each_component(spark, odd):
    rows = _copies(9)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in adaptjoin.near_dedup(df, 5, 80).collect()}
    assert kept == {c for _, _, c in _brute_components(rows, 5, 80)}
    same = [(None, "one two three four five six")] * 3 + [(4, "one two three four five six"), (4, "one two three four five six")]
    df = spark.createDataFrame(same, "doc_id long, text string")
    assert [tuple(r) for r in adaptjoin.near_dedup(df).collect()] == [same[3]]
    df = spark.createDataFrame(same[:3], "doc_id long, text string")
    assert [tuple(r) for r in adaptjoin.near_dedup(df).collect()] == [same[0]]
    assert adaptjoin.near_dedup(odd.where("false")).count() == 0
    left = [r["doc_id"] for r in adaptjoin.near_dedup(odd, 4, 85).collect()]
    assert sorted(x for x in left if x is not None) == [1, 2, 2, 3, 5, 6, 8, 9] and left.count(None) == 1


def test_documents_that_share_one_passage_and_little_else(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([4, 300]))) + " " + passage)
            for i in range(700)]
    got = adaptjoin.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert sorted(map(tuple, got)) == _brute_components(rows, 4, 85)
    assert len({r["component_id"] for r in got}) > 200


def test_nodes_stay_exactly_where_a_pair_may_ask_for_them(spark):
    rng = random.Random(6)
    for _ in range(4):
        match = {n: rng.randint(1, 3) for n in range(40)}
        held = sorted({(rng.randint(0, 60), n) for n in range(40) for _ in range(5)})
        df = spark.createDataFrame([(t, n, match[n]) for t, n in held], "token long, node long, match int")
        tokens = {n: {t for t, m in held if m == n} for n in match}
        may = {x for x in match for y in match if x != y
               and len(tokens[x] & tokens[y]) >= min(match[x], match[y])}
        got = {r["node"] for r in adaptjoin._pairable(df).collect()}
        assert may <= got <= {x for x in match if any(tokens[x] & tokens[y] for y in match if y != x)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(1, 1)]
    got = dict(map(tuple, connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(5, 60)} == {5}


def _written(monkeypatch):
    """The names of the tables that the join and its components write."""
    names, write = [], components.materialize
    for module in (adaptjoin, components):
        monkeypatch.setattr(module, "materialize", lambda df, name: names.append(name) or write(df, name))
    return names


def test_stars_need_no_round(spark, monkeypatch):
    names = _written(monkeypatch)
    stars = spark.createDataFrame([(5, 1), (6, 1), (1, 7), (9, 8), (8, 9), (3, 3)], "a long, b long")
    got = {tuple(r) for r in components.connected(stars).collect()}
    assert got == {(1, 1), (5, 1), (6, 1), (7, 1), (8, 8), (9, 8)} and names == ["edges"]
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 49), (50, 48)], "a long, b long")
    got = {tuple(r) for r in components.connected(chain).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 48) for i in range(48, 51)}


def test_rounds_without_pairs_write_no_texts(spark, monkeypatch):
    names = _written(monkeypatch)
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(30))) for i in range(40)]
    got = adaptjoin.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["id"], r["component_id"]) for r in got} == {(i, i) for i in range(40)}
    assert not {"node-texts", "labels"} & set(names)


def test_shuffle_files_of_a_written_table_go(spark):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
        found = set()
        while files.hasNext():
            found.add(files.next().getName())
        return {f for f in found if f.startswith("shuffle_")}

    before = shuffles()
    table = materialize(spark.range(1000).repartition("id").groupBy((F.col("id") % 7).alias("k")).count(), "seven")
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and {r["k"]: r["count"] for r in table.collect()} == {k: 142 + (k < 6) for k in range(7)}
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
