"""Language, quality and toxicity on invented text with a known answer."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import SCHEMA, auc, odd_rows, sentences
from pyspark.sql import functions as F

from rasterprep.llm import langid, pulearn, zquality
from rasterprep.llm.common import slice_hashes, utf8

SYLLABLES = {"aa": ["ka", "lo", "mi", "ren", "tos"], "bb": ["zu", "wex", "pid", "gor", "lan"],
             "cc": ["été", "çou", "pre", "nif", "ol"]}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def test_language_of_held_out_text(spark, odd):
    rng = random.Random(1)
    rows = [(i, sentences(rng, SYLLABLES[lang], rng.randint(5, 60)), lang)
            for i in range(300) for lang in [rng.choice(sorted(SYLLABLES))]]
    docs = spark.createDataFrame(rows + [(900, "ka lo", None), (901, None, "aa")], "doc_id long, text string, lang string")
    model = langid.fit(docs.where(~langid.held_out()))
    assert model.languages == sorted(SYLLABLES)
    got = {r["id"]: r for r in langid.identify(docs, model).collect()}
    right = [got[i]["lang_pred"] == lang for i, _, lang in rows]
    assert np.mean(right) > 0.99 and all(0 <= r["score"] <= 1 for r in got.values())
    assert got[901]["lang_pred"] == "und"
    odd_got = langid.identify(odd, model).collect()
    assert len(odd_got) == len(odd_rows())
    assert {r["lang_pred"] for r in odd_got if r["id"] in (3, 9)} == {"und"}
    nothing = langid.fit(docs.where("false"))
    assert {r["lang_pred"] for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_masks_return_all_languages_of_a_gram():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, 500).astype(np.uint64) for _ in range(70)]   # two mask words
    model = langid.MaskFilter([f"l{i:02}" for i in range(70)], sets)
    a, b = model.slots(sets[69])
    found = model.masks[1][a] & model.masks[1][b]
    assert ((found >> np.uint64(5)) & np.uint64(1)).all()
    assert model.false_rate.max() < 0.05


def _labelled(spark, make, n=400):
    rng = random.Random(3)
    rows = [(i, *make(rng)) for i in range(n)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id long, y int")
    return rows, docs, labels


def test_quality_of_held_out_text(spark, odd):
    def make(rng):
        good = rng.random() < 0.7
        text = sentences(rng, SYLLABLES["aa"], rng.randint(30, 200))
        return (text if good else " ".join(w + rng.choice(["***", "$$$"]) for w in text.split()), int(good))

    rows, docs, labels = _labelled(spark, make)
    model = zquality.fit(docs, labels.where(~zquality.held_out()), label_col="y")
    got = {r["id"]: r["score"] for r in zquality.score(docs, model).collect()}
    held = {r["doc_id"] for r in docs.where(zquality.held_out()).collect()}
    assert auc([got[i] for i, _, _ in rows if i in held], [y for i, _, y in rows if i in held]) > 0.98
    kept = {r["doc_id"] for r in zquality.keep_rows(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s >= zquality.GOOD}
    assert all(0 <= r["score"] <= 1 for r in zquality.score(odd, model).collect())
    assert zquality.keep_rows(odd, model).columns == odd.columns
    one = zquality.fit(docs, labels.where("y = 1"), label_col="y")
    assert {r["score"] for r in zquality.score(odd, one).collect()} == {1.0}
    none = zquality.fit(docs.where("false"), labels.where("false"), label_col="y")
    assert zquality.score(odd.where("false"), none).count() == 0


def test_toxicity_of_held_out_text(spark, odd):
    def make(rng):
        words = sentences(rng, SYLLABLES["aa"], rng.randint(30, 120)).split()
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "vrax" + rng.choice(["", "ul", "imo", "to"]) + "!")
        return " ".join(words), int(toxic)

    rows, docs, labels = _labelled(spark, make, 900)
    model = pulearn.fit(docs.where(~pulearn.held_out()), labels.where(~pulearn.held_out()), label_col="y")
    got = {r["id"]: r["score"] for r in pulearn.score(docs, model).collect()}
    held = {r["doc_id"] for r in docs.where(pulearn.held_out()).collect()}
    mine = [(got[i], y) for i, _, y in rows if i in held]
    assert auc(*zip(*mine)) > 0.98
    assert np.mean([(s >= pulearn.TOXIC) == y for s, y in mine]) > 0.95
    kept = {r["doc_id"] for r in pulearn.keep_rows(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s < pulearn.TOXIC}
    assert len(pulearn.score(odd, model).collect()) == len(odd_rows())
    nothing = pulearn.fit(docs, labels.where("false"), label_col="y")
    assert all(r["score"] < pulearn.TOXIC for r in pulearn.score(odd, nothing).collect())


def test_a_rare_language_is_learned_from_all_its_rows(spark):
    rng = random.Random(4)
    rows = [(i, sentences(rng, SYLLABLES["aa" if i % 100 else "cc"], 12), "aa" if i % 100 else "cc") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs, rows=200)
    assert model.languages == ["aa", "cc"]
    fresh = [sentences(rng, SYLLABLES[x], 12) for x in ("aa", "cc") for _ in range(50)]
    assert model.predict(fresh)[0] == ["aa"] * 50 + ["cc"] * 50


def test_language_shares_equal_plain_sets():
    rng = random.Random(5)
    texts = [sentences(rng, SYLLABLES[x], 40) for x in ("aa", "bb", "cc", "aa")] + ["", "1 2 3", "Zu"]
    sets = [set(langid.grams([t])[0].tolist()) for t in texts[:3]]
    model = langid.MaskFilter(["aa", "bb", "cc"], [np.array(sorted(s), np.uint64) for s in sets])
    shares, letters = model.shares(texts)
    for text, share, n in zip(texts, shares, letters):
        own = langid.grams([text])[0].tolist()
        plain = [np.mean([g in s for g in own]) if own else 0 for s in sets]
        assert np.allclose(share, plain, atol=0.05) and n == sum(map(str.isalpha, text))


def test_quality_that_shows_late_in_long_texts(spark):
    def make(rng):
        good = rng.random() < 0.5
        late = sentences(rng, SYLLABLES["bb"], 1500)
        return (sentences(rng, SYLLABLES["aa"], 1500) + " "
                + (late if good else " ".join(w + rng.choice(["***", "$$$"]) for w in late.split())), int(good))

    rows, docs, labels = _labelled(spark, make, 120)
    assert min(len(t) for _, t, _ in rows) > 2 * zquality.SAMPLE_CHARS
    model = zquality.fit(docs, labels.where(~zquality.held_out()), label_col="y")
    got = {r["id"]: r["score"] for r in zquality.score(docs, model).collect()}
    held = {r["doc_id"] for r in docs.where(zquality.held_out()).collect()}
    assert np.mean([(got[i] >= zquality.GOOD) == y for i, _, y in rows if i in held]) > 0.95
    assert model.good.count(b"zu") + model.good.count(b"wex") > 50        # words of the later half


def test_spans_cover_all_parts_of_a_text(spark):
    text = "".join(chr(0x4E00 + i) for i in range(20_000))
    rows = spark.range(400).select("id", F.lit(text).alias("text")).select(
        zquality.spread("text", "id", 400, 4).alias("s")).collect()
    assert {len(r["s"]) for r in rows} == {400}
    seen = {c for r in rows for c in r["s"]}
    assert len(seen) > 0.99 * len(text)
    assert all(text[k * 5000:][:5000].find(r["s"][k * 100:][:100]) >= 0 for r in rows[:20] for k in range(4))
    for short in ("", "é" * 400):
        assert spark.createDataFrame([(1, short)], "id long, text string").select(
            zquality.spread("text", "id", 400, 4)).first()[0] == short


def test_sizes_are_sums_over_portions():
    import zstandard
    rng = random.Random(6)
    texts = [sentences(rng, SYLLABLES["aa"], n).encode() for n in (1, 40, 900)] + [b"", b"x" * zquality.PORTION]
    pair = [zquality._compressor(b"kalomi" * 50), zquality._compressor(b"zuwexpid" * 50)]
    for text, row in zip(texts, zquality.sizes(*pair, texts)):
        parts = [text[i:i + zquality.PORTION] for i in range(0, len(text), zquality.PORTION)] or [b""]
        assert row.tolist() == [sum(len(c.compress(p)) for p in parts) for c in pair] + [len(text)]
    assert zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(b"kalomi" * 50)).decompress(
        pair[0].compress(texts[1]), max_output_size=1 << 20) == texts[1]


def test_a_toxic_term_of_twenty_documents(spark):
    rng = random.Random(7)

    def text(*extra):
        words = sentences(rng, SYLLABLES["aa"], 15).split() + list(extra)
        rng.shuffle(words)
        return " ".join(words)

    rows = [(i, text("vraxul"), 1) for i in range(2500)] + [(i, text("gromphet"), 1) for i in range(2500, 2520)]
    rows += [(i, text(), 0) for i in range(2520, 6000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, y int")
    model = pulearn.fit(docs, labels, label_col="y", unlabelled=1500)
    fresh = spark.createDataFrame([(0, text("gromphet")), (1, text("vraxul")), (2, text()), (3, text())],
                                  "doc_id long, text string")
    got = {r["id"]: r["score"] for r in pulearn.score(fresh, model).collect()}
    assert got[0] >= pulearn.TOXIC and got[1] >= pulearn.TOXIC
    assert got[2] < pulearn.TOXIC and got[3] < pulearn.TOXIC


def test_feature_frequencies_are_plain_document_counts(spark):
    from collections import Counter
    texts = ["Vrax lo lo", "vrax!", None, "", "été vrax-lomi"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    plain = Counter()
    for t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        plain.update(set(pulearn.word_features(data, np.array([0, len(data)]))[0].tolist()))
    got = {r["feature"]: r["n"] for r in pulearn._frequencies(docs, None).collect()}
    assert got == dict(plain) and max(got.values()) == 3
    one = np.zeros(1 << pulearn.BITS, bool)
    one[max(got, key=got.get)] = True
    assert [r["n"] for r in pulearn._frequencies(docs, one).collect()] == [3]


def test_folds_follow_the_id_text(spark):
    import zlib
    rows = spark.range(200).select(F.col("id").alias("doc_id"), langid.held_out().alias("a"),
                                   pulearn.held_out().alias("b")).collect()
    assert [(r["a"], r["b"]) for r in rows] == \
        [(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1, zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows]


def test_a_word_is_hashed_once_a_chunk(monkeypatch):
    hashed = []

    def counted(data, starts, ends):
        hashed.append(len(starts))
        return slice_hashes(data, starts, ends)

    monkeypatch.setattr(pulearn, "slice_hashes", counted)
    texts = ["Abcdef xyz " * 500, "", "abcdef-XYZ", "été", "xyz"]
    data, offs = utf8(pa.array(texts))
    feature, text = pulearn.word_features(data, offs)
    assert sum(hashed) == 3                                   # abcdef, xyz, été
    alone = [pulearn.word_features(*utf8(pa.array([t])))[0].tolist() for t in texts]
    assert [feature[text == i].tolist() for i in range(len(texts))] == alone
    assert len(alone[0]) == 7 and alone[0] == alone[2]        # 2 words, 3 + 2 pieces of abcdef


def test_features_of_a_chunk_take_little_memory():
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(pulearn.CHUNK // 7))
    data, offs = utf8(pa.array([text[i:i + 2000] for i in range(0, len(text), 2000)]))
    pulearn.word_features(data[:100], np.array([0, 100]))     # tables of the hashes
    tracemalloc.start()
    pulearn.word_features(data, offs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
