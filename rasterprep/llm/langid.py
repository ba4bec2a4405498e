"""Language identification with a bit-sliced Bloom filter over character n-grams.

One filter holds all languages: a slot is a bit mask with one bit per language, and
an n-gram's languages are the AND of the masks at its two slots.  A text's languages
are counted bit by bit over all its n-grams (per-language popcounts); each count is
corrected for the filter's own false positives, which follow from how many slots
carry that language's bit.  The largest corrected share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.llm.common import chunk_texts, id_crc, mix64, text_chunks

#: n-gram lengths in code points; what is not a letter counts as one gap.
LENGTHS = (3, 4)
#: A language's filter holds n-grams that make up at least this share of its n-grams,
#: hence at most 1 / MIN_SHARE of them whatever the corpus.
MIN_SHARE = 2e-5
#: Documents of each language that the filters are fitted on, at most about.
TRAIN_ROWS = 6_000
SLOTS_PER_GRAM = 8
UNKNOWN = "und"

_ALPHA: np.ndarray | None = None


def _alpha() -> np.ndarray:
    """Whether each code point is a letter."""
    global _ALPHA
    if _ALPHA is None:
        every = [*range(0xD800), *range(0xE000, 0x110000)]
        table = np.zeros(0x110000, bool)
        table[every] = np.fromiter((chr(c).isalpha() for c in every), bool, len(every))
        _ALPHA = table
    return _ALPHA


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, text)`` of every n-gram, and the number of letters of each text.

    Texts are lower-cased and padded with a gap; runs of non-letters are one gap; an
    n-gram has a gap at its ends only.
    """
    joined = "\n".join(texts).lower() if texts else ""
    # lower-casing may change lengths, so texts are measured after it
    lens = np.fromiter((len(t.lower()) for t in texts), np.int64, len(texts))
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if int(lens.sum()) + max(0, len(texts) - 1) != len(points):   # context-dependent lower case
        parts = [t.lower() for t in texts]
        points = np.frombuffer("\n".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([[0], points, [0]]).astype(np.int64)  # a gap before, between and after
    ends = np.cumsum(lens + 1)                                    # gap that closes each text
    letter = _alpha()[points]
    letters = np.diff(np.concatenate([[0], np.cumsum(letter)])[np.concatenate([[0], ends])])
    keep = letter.copy()
    keep[1:] |= letter[:-1]                                       # the first gap after a letter
    keep[0] = True
    at = np.flatnonzero(keep)
    seq = np.where(letter[at], points[at], 0).astype(np.uint64)
    owner = np.searchsorted(ends, at, side="left")
    out_hash, out_text = [], []
    for n in LENGTHS:
        m = len(seq) - n + 1
        if m <= 0:
            continue
        ok = np.ones(m, bool)
        for j in range(1, n - 1):
            ok &= seq[j:j + m] != 0
        h = np.full(m, n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(n):
                h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + seq[j:j + m])
        out_hash.append(h[ok])
        out_text.append(owner[1:1 + m][ok])
    if not out_hash:
        return np.empty(0, np.uint64), np.empty(0, np.int64), letters
    h, t = np.concatenate(out_hash), np.concatenate(out_text)
    order = np.argsort(t, kind="stable")
    return h[order], t[order], letters


class MaskFilter:
    """The bit-sliced Bloom filter: ``masks[slot]`` has bit ``l`` of languages that use it."""

    def __init__(self, languages: list[str], grams_of: list[np.ndarray]):
        self.languages = languages
        most = max([1, *map(len, grams_of)])
        self.size = 1 << int(np.ceil(np.log2(most * 2 * SLOTS_PER_GRAM)))
        words = -(-len(languages) // 64)
        self.masks = np.zeros((words, self.size), np.uint64)
        for i, g in enumerate(grams_of):
            for s in self.slots(g):
                self.masks[i // 64, s] |= np.uint64(1) << np.uint64(i % 64)
        fill = np.array([((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()
                         for i in range(len(languages))])
        self.false_rate = fill ** 2

    def slots(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(self.size - 1)
        return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)

    def shares(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected share of each text's n-grams in each language, and its letters."""
        h, owner, letters = grams(texts)
        a, b = self.slots(h)
        n = np.bincount(owner, minlength=len(texts))
        got = np.zeros((len(texts), len(self.languages)))
        for w, masks in enumerate(self.masks):
            found = masks[a] & masks[b]
            for i in range(w * 64, min(len(self.languages), w * 64 + 64)):
                bit = ((found >> np.uint64(i % 64)) & np.uint64(1)).astype(np.uint8)
                hits = np.bincount(owner[bit.view(bool)], minlength=len(texts))
                rate = self.false_rate[i]
                got[:, i] = (hits / np.maximum(n, 1) - rate) / max(1e-9, 1 - rate)
        return np.clip(got, 0, 1), letters

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        shares, letters = self.shares(texts)
        best = shares.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), int)
        total = shares.sum(axis=1)
        top = shares.max(axis=1) if len(self.languages) else np.zeros(len(texts))
        score = np.where(total > 0, top / np.maximum(total, 1e-12), 0.0)
        known = (letters > 0) & (len(self.languages) > 0)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
        return names, np.where(known, score, 0.0).tolist()


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
        rows: int = TRAIN_ROWS) -> MaskFilter:
    """The filter of the languages in ``docs`` (rows with a language and a text), fitted on
    about ``rows`` of each at most, dealt by a hash of the id; a language of fewer rows is
    learned from all of them.

    n-grams are counted by Spark; at most ``1 / MIN_SHARE`` per language come back.
    """
    named = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # one row per language
    share = named.groupBy("lang").agg((F.lit(1e6 * rows) / F.count(F.lit(1))).alias("cut"))
    picked = (named.join(F.broadcast(share), "lang")
              .where(F.coalesce(F.pmod(F.xxhash64("id"), F.lit(1_000_000)), F.lit(0)) < F.col("cut"))
              .select("lang", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_chunks(batches, "text"):
            langs = np.array(part.column(0).to_pylist(), object)
            texts = chunk_texts(data, offs)
            for lang in sorted(set(langs)):
                h, _, _ = grams([texts[i] for i in np.flatnonzero(langs == lang)])
                g, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"])

    counts = picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = (counts.join(F.broadcast(totals), "lang")
                .where(F.col("n") >= F.greatest(F.lit(2), F.col("total") * MIN_SHARE)))
    got = frequent.select("lang", "gram").toPandas()
    languages = sorted(got["lang"].unique().tolist())
    return MaskFilter(languages, [got.loc[got["lang"] == x, "gram"].to_numpy(np.int64).view(np.uint64)
                                  for x in languages])


def identify(docs: DataFrame, model: MaskFilter, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row's whole text.

    A null text, an empty one and one without a letter are ``und`` with score 0; a text
    of which no n-gram is known gets the first language with score 0.  Ties go to the
    language first in order.  Null and repeated ids are kept; an empty table gives an
    empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, "text", 2 << 20):
            names, score = model.predict(chunk_texts(data, offs))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["id", "lang_pred", "score"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Rows the model never learns from: ``crc32(id as text) mod 3 = 1``."""
    return F.coalesce(id_crc(id_col) % 3 == 1, F.lit(False))
