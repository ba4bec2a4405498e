"""Token counts, byte-level BPE, token files and packing against the public libraries."""

import base64
import hashlib
import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_fixtures import SCHEMA, odd_rows
from tokenizers import Tokenizer

from rasterprep.llm import dac, merges, packing, scan_bpe, tokens
from rasterprep.llm.common import utf8

BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = [" ", " ", "\n", "\t", "a", "b", "the", "'s", "'RE", "'", "1", "23", "!", "<|endoftext|>", " ", "é",
         "é", "日本", "\x1c", "\x85", "'ve", "<|startoftext|>", "'ll", "'r", "Σ", "İ", "  ", "\r\n", "ab" * 150,
         "=", "🙂", "xyx" * 30, "　"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def test_counts_equal_the_library():
    t = texts(3000)
    counter = merges.TokenCounter(BYTE_JSON, public_tokenizers.PATTERN)
    library = Tokenizer.from_file(BYTE_JSON)
    assert counter.counts(t) == [len(e.ids) for e in library.encode_batch(t, add_special_tokens=False)]


def test_counts_when_the_cache_starts_afresh():
    t = texts(500)
    counter = merges.TokenCounter(BYTE_JSON, public_tokenizers.PATTERN, limit=20)
    first = [counter.counts(t[i:i + 50]) for i in range(0, 500, 50)]
    assert sum(first, []) == merges.TokenCounter(BYTE_JSON, public_tokenizers.PATTERN).counts(t)


def test_token_counts_of_odd_rows(odd):
    library = Tokenizer.from_file(BYTE_JSON)
    got = merges.token_counts(odd, BYTE_JSON, public_tokenizers.PATTERN).collect()
    want = [(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids))
            for r in odd_rows()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def _encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return scan_bpe.Codec(RANKS)


def test_scanned_boundaries_and_merges_equal_tiktoken(codec):
    t, e = texts(5000, 2), _encoding()
    data, offs = utf8(pa.array(t))
    ids, n = codec.encode(data, offs)
    raw, n_bytes = codec.decode(ids, n)
    ends = np.cumsum(n)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [e.encode_ordinary(x) for x in t]
    assert raw.tobytes() == data.tobytes() and (n_bytes == np.diff(offs)).all()


def test_every_code_point_is_cut_like_tiktoken(codec):
    e = _encoding()
    t = [chr(c) + "a" + chr(c) + " " + chr(c) for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    data, offs = utf8(pa.array(t))
    ids, n = codec.encode(data, offs)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [e.encode_ordinary(x) for x in t]


def test_blocks_of_the_scan_do_not_matter():
    rng = np.random.default_rng(0)
    classes = rng.integers(0, 11, 3000).astype(np.uint8)
    classes[-1] = scan_bpe.END
    whole = scan_bpe.token_starts(classes, block=4096)
    for block in (1, 7, 64):
        assert (scan_bpe.token_starts(classes, block) == whole).all()


def test_round_trip_of_odd_rows(odd):
    e = _encoding()
    got = {(r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in scan_bpe.round_trip_digests(odd, RANKS).collect()}
    want = set()
    for r in odd_rows():
        ids = e.encode_ordinary(r[1] or "")
        want.add((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got == want
    encoded = scan_bpe.encode(odd, RANKS)
    assert sorted((r["id"] or 0, bytes(r["data"]).decode()) for r in scan_bpe.decode(encoded, RANKS).collect()) == \
        sorted((r[0] or 0, r[1] or "") for r in odd_rows())


@pytest.mark.parametrize("path,blank_free", [(BYTE_JSON, False), (WORD_JSON, True)])
def test_words_remembered_give_the_librarys_ids(path, blank_free):
    t = texts(3000, 3)
    enc = tokens.LibraryEncoder(path, blank_free, limit=500)
    library = Tokenizer.from_file(path)
    for lo in range(0, 3000, 300):
        ids, n = enc.encode(t[lo:lo + 300])
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == \
            [e.ids for e in library.encode_batch(t[lo:lo + 300], add_special_tokens=False)]


def test_a_cache_is_limited_by_characters_and_never_numbers_what_failed(monkeypatch):
    monkeypatch.setattr(merges, "KEY_CHARS", 50)
    asked = []

    def lengths(keys):
        if "bad" in keys:
            raise ValueError("bad")
        asked.append(list(keys))
        return np.array([len(k) for k in keys], np.int32), np.ones(len(keys), np.int64)

    cache = merges.RaggedCache(lengths)
    assert cache.gather(cache.numbers(["a", "bb", "a"]))[0].tolist() == [1, 2, 1]
    assert cache.gather(cache.numbers(["ccc", "bb", "d" * 60]))[0].tolist() == [3, 2, 60]
    assert asked == [["a", "bb"], ["ccc", "d" * 60]]
    assert cache.gather(cache.numbers(["bb", "e"]))[0].tolist() == [2, 1]       # afresh: 66 characters held
    assert asked[-1] == ["bb", "e"]
    with pytest.raises(ValueError):
        cache.numbers(["f", "bad"])
    assert cache.gather(cache.numbers(["f", "bb"]))[0].tolist() == [1, 2]
    assert cache.numbers([]).tolist() == []


def test_new_words_are_asked_for_some_at_a_time():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgéß日'.,1" * 16 + "\n\t") for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    t = [" ".join(words[i:i + 40]) for i in range(0, 4000, 40)] + texts(300, 6)
    enc, library = tokens.LibraryEncoder(BYTE_JSON, False), Tokenizer.from_file(BYTE_JSON)
    asked = []

    class Counting:
        def encode_batch_fast(self, some, **more):
            asked.extend(some)
            return library.encode_batch_fast(some, **more)

        def encode(self, text, **more):
            return library.encode(text, **more)

    enc.tokenizer = Counting()
    ids, n = enc.encode(t)
    want = [e.ids for e in library.encode_batch(t, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    assert len(asked) < len(enc.cache.known) / 4


def test_words_are_asked_for_one_by_one_where_ids_do_not_show_their_bytes():
    t = texts(300, 7) + ["some plain words, twice: some plain words"]
    enc = tokens.LibraryEncoder(BYTE_JSON, False)
    enc.sizes = np.zeros_like(enc.sizes)             # as if bytes of ids did not end where words do
    ids, n = enc.encode(t)
    want = [e.ids for e in Tokenizer.from_file(BYTE_JSON).encode_batch(t, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want


def test_lowering_first_gives_the_librarys_ids():
    library = Tokenizer.from_file(WORD_JSON)
    t = texts(1500, 8) + [c + m for c in "JHTWYKA" for m in ("\u030c", "\u0331", "\u0308", "\u030a", "")] + \
        ["<|StartOfText|>", "ÀÉ Straße İI ΑΣ K Ω"] + [chr(c) + "B" for c in range(0xC0, 0x3000, 5)]
    for x in t:
        data, _ = utf8(pa.array([x]))
        low = tokens.lower_where_safe(data).tobytes().decode()
        assert library.encode(low, add_special_tokens=False).ids == library.encode(x, add_special_tokens=False).ids


def test_any_code_of_a_block_is_addressable():
    rng = np.random.default_rng(5)
    ids = np.concatenate([rng.integers(0, 300, 3000), rng.integers(0, 1 << 31, 500), [0, 255, 256, 65535, 65536]])
    rng.shuffle(ids)
    cut = np.sort(rng.integers(0, len(ids), 9))
    n = np.diff(np.concatenate([[0], cut, [len(ids)]]))
    block = dac.Block(dac.encode_block(ids.astype(np.uint32), np.arange(10), np.ones(10, bool), n))
    assert [block.get(i) for i in range(len(ids))] == ids.tolist()
    assert (block.range(511, 2050) == ids[511:2050]).all()
    assert (np.concatenate([block.document(k) for k in range(10)]) == ids).all()
    empty = dac.Block(dac.encode_block(np.empty(0, np.uint32), np.arange(1), np.ones(1, bool), np.zeros(1, np.int64)))
    assert len(empty.document(0)) == 0


def test_token_files_of_odd_rows(spark, odd):
    library = Tokenizer.from_file(WORD_JSON)
    got = dac.write_and_read(odd, WORD_JSON, end_id=1).collect()
    want = sorted(((r[0], np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
                   for r in odd_rows()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert sorted(((r["id"], bytes(r["ids"])) for r in got),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1])) == want
    by_start = sorted(got, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == np.cumsum([0] + [len(r["ids"]) // 4 for r in by_start])[:-1].tolist()
    ids = [r["id"] for r in by_start if r["id"] is not None]
    assert ids == sorted(ids)
    assert dac.write_and_read(odd.where("false"), WORD_JSON, end_id=1).count() == 0


def _best_sum(available, capacity):
    reach = {0}
    for length, count in available:
        for _ in range(count):
            reach |= {s + length for s in reach if s + length <= capacity}
    return max(reach)


def test_fullest_combination_is_the_fullest():
    rng = random.Random(4)
    for _ in range(200):
        available = sorted(((n, rng.randint(1, 3)) for n in rng.sample(range(1, 60), rng.randint(1, 6))), reverse=True)
        capacity = rng.randint(0, 120)
        chosen = packing.fullest(available, capacity)
        assert all(k <= dict(available)[n] for n, k in chosen)
        assert sum(n * k for n, k in chosen) == _best_sum(available, capacity)


def test_plan_places_every_piece_once():
    rng = random.Random(6)
    histogram = {n: rng.randint(1, 40) for n in rng.sample(range(1, 101), 60)}
    bins = packing.plan_bins(histogram, 100)
    used = {}
    for combination, times in bins:
        assert sum(n * k for n, k in combination.items()) <= 100
        for n, k in combination.items():
            used[n] = used.get(n, 0) + k * times
    assert used == histogram
    # no packing has fewer bins than the tokens fill, nor than there are pieces over half a bin
    least = max(-(-sum(n * c for n, c in histogram.items()) // 100), sum(c for n, c in histogram.items() if n > 50))
    assert sum(t for _, t in bins) <= 1.02 * least + 1


def test_packing_encodes_half_a_megabyte_at_a_time(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tasks, sizes = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: tasks.append(f))
    packing.token_pieces(docs, BYTE_JSON, 0, 2048, keep_words=False)

    class Recording:
        def encode(self, some):
            sizes.append(sum(map(len, some)))
            return np.zeros(len(some), np.int32), np.ones(len(some), np.int64)

    monkeypatch.setattr(packing, "encoder", lambda *_: Recording())
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"id": list(range(300)), "text": ["word " * 2000] * 300})
    out = list(tasks[0](iter([batch])))
    assert sum(b.num_rows for b in out) == 300 and sum(sizes) == 3_000_000
    assert max(sizes) <= 1 << 19


def test_packing_of_odd_rows(odd):
    library = Tokenizer.from_file(BYTE_JSON)
    got = packing.pack(odd, BYTE_JSON, capacity=512).toPandas()
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g["offset"].to_numpy() == np.cumsum(g["length"]) - g["length"]).all() and g["length"].sum() <= 512
    got["crc"] = [zlib.crc32(bytes(x)) for x in got["ids"]]
    want = []
    for r in odd_rows():
        ids = np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        head = len(ids) - (-(-len(ids) // 512) - 1) * 512
        cuts = [0, *range(head, len(ids) + 1, 512)]
        want += [(str(r[0]), i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    own = [("None" if x != x else str(int(x)), *rest) for x, *rest in
           got[["id", "piece", "start", "length", "crc"]].itertuples(index=False)]
    assert sorted(own) == sorted(want)
    assert got["sequence_id"].nunique() <= -(-int(got["length"].sum()) // 512) + 1
    assert packing.pack(odd.where("false"), BYTE_JSON).count() == 0


def test_visible_words_are_asked_together_of_a_tokenizer_that_drops_space():
    enc, asked = tokens.LibraryEncoder(WORD_JSON, blank_free=True), []
    library = enc.tokenizer

    def counted(many, add_special_tokens):
        asked.extend(many)
        return library.encode_batch_fast(many, add_special_tokens=add_special_tokens)

    enc.tokenizer = SimpleNamespace(encode_batch_fast=counted)
    t = [" ".join(f"it's{i} <b>{i}</w>don't" for i in range(1000)), "", "été it's1", "a\x1cb <|endoftext|>x a\tb\x85c"]
    ids, n = enc.encode(t)
    want = [e.ids for e in library.encode_batch(t, add_special_tokens=False)]
    assert ids.tolist() == sum(want, []) and n.tolist() == list(map(len, want))
    assert len(asked) < 2000 // tokens.JOINED + 10


def test_normal_words_of_any_letters_are_asked_together():
    enc, asked = tokens.LibraryEncoder(WORD_JSON, blank_free=True), []
    library = enc.tokenizer

    class Counted:
        def encode_batch_fast(self, words, **more):
            asked.extend(words)
            return library.encode_batch_fast(words, **more)

    enc.tokenizer = Counted()
    t = ["".join(chr(0xE0 + int(c)) for c in str(i)) + " straße日本́" for i in range(2000)]
    t += ["é Éa İ ΣΣ a　b   ́x <|x é", "ﬁ Ω ẞ ǅ ça"]   # composed or lower-cased
    ids, n = enc.encode(t)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == \
        [e.ids for e in library.encode_batch(t, add_special_tokens=False)]
    assert len(asked) < 2000 // tokens.JOINED + 20


def test_a_text_is_cut_without_a_string_for_every_word():
    enc = tokens.LibraryEncoder(BYTE_JSON, False)
    text = " ".join(["ab", "c\nd", "é"] * 100_000)
    tracemalloc.start()
    try:
        keys, at, counts, whole = enc._cut([text, "", " x", "a   b", "y z"])
        assert tracemalloc.get_traced_memory()[1] < 12_000_000
    finally:
        tracemalloc.stop()
    assert counts.tolist() == [300_000, 0, 1, 0, 2] and whole == [3]
    assert [keys[i] for i in at[:4].tolist()] == [" ab", "c\nd", "é", "ab"]
    assert [keys[i] for i in at[-3:].tolist()] == ["x", " y", "z"]
