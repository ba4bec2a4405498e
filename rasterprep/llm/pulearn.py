"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents carry a label; all other text is unlabelled.  A linear
model over hashed words and word pieces is trained with numpy on the
class-prior-corrected risk

    pi * R+(positive) + max(0, R-(unlabelled) - pi * R-(positive))

whose second part, the risk on negatives estimated without any negative, is not let
fall below zero: a mini-batch where it does takes a step that raises it again.  The
model looks at features that are far more frequent in confirmed than in unlabelled text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.llm.common import ascii_lower, id_crc, mix64, released, slice_hashes, text_chunks

#: Confirmed toxic documents that are learned from, and unlabelled documents that the weights
#: are fitted on, at most about.  The features' frequencies come from all unlabelled documents.
POSITIVE_ROWS = 8_000
UNLABELLED_ROWS = 16_000
#: Hashed features.
BITS = 20
#: Bytes of the word pieces that are features beside whole words.
PIECES = (4, 5)
#: A feature is used if MIN_COUNT of the confirmed documents have it and if, by the class
#: prior, at least MIN_PURE of all unlabelled documents that have it are toxic; one standard
#: deviation fewer confirmed documents must still make that MIN_BOUND of them.
MIN_COUNT, MIN_PURE, MIN_BOUND = 4, 0.7, 0.5
#: Bytes of text whose features are found together: numpy takes many times as much meanwhile.
CHUNK = 1 << 19

#: A document is toxic from this score on.
TOXIC = 0.3
#: Margins beyond this count no further, so that no document dominates the risk.
MARGIN = 8.0

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class ToxicModel:
    weights: np.ndarray
    bias: float
    prior: float


def _ascending(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in ascending order; ``keys`` is sorted in place."""
    keys.sort()
    return keys[np.diff(keys, prepend=keys[0] - 1) != 0] if len(keys) else keys


def _distinct_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, edges, number, text)``: the distinct words of a chunk in lower case, one after the
    other, and the number and the text of every word."""
    n = len(data)
    inside = _WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(end) + 1 - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(ascii_lower(data[inside]))]).dictionary_encode()
    _, edges, spelled = words.dictionary.buffers()
    edges = np.frombuffer(edges, np.int64, count=len(words.dictionary) + 1)
    return (np.frombuffer(spelled, np.uint8, count=int(edges[-1])), edges,
            words.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            np.searchsorted(offs, starts, side="right") - 1)


def _spelled_features(spelled: np.ndarray, edges: np.ndarray, wanted: np.ndarray | None,
                      bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(feature, word)``: the distinct (``wanted``) features of every word, by word."""
    shift = np.uint64(64 - bits)
    starts, lens = edges[:-1], np.diff(edges)
    found = [((slice_hashes(spelled, starts, edges[1:]) >> shift).astype(np.int64), np.arange(len(lens)))]
    for k in PIECES:
        # of a word as many pieces as it has places with k bytes from there on
        many = np.maximum(lens - k + 1, 0)
        word = np.repeat(np.arange(len(lens)), many)
        spots = np.arange(len(word)) + np.repeat(starts - (np.cumsum(many) - many), many)
        code = np.full(len(spots), k, np.uint64)
        for j in range(k):
            code = (code << np.uint64(8)) | spelled[spots + j].astype(np.uint64)
        with np.errstate(over="ignore"):
            h = mix64(code * np.uint64(0x9E3779B97F4A7C15))
        found.append(((h >> shift).astype(np.int64), word))
    if wanted is not None:
        found = [(f[w], s[w]) for f, s in found for w in (wanted[f],)]
    key = _ascending(np.concatenate([(word << bits) | feature for feature, word in found]))
    return key & ((1 << bits) - 1), key >> bits


def word_features(data: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None,
                  bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """``(feature, text)``: the distinct features of every text of a chunk, by text.

    Features are hashed words (runs of letters and digits, lower case) and their pieces
    of ``PIECES`` bytes; ``wanted`` (one flag per feature) leaves the others out early.  A word
    is hashed and cut once a chunk, however often it occurs.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    spelled, edges, number, text = _distinct_words(data, offs)
    n_words = len(edges) - 1
    feature, word = _spelled_features(spelled, edges, wanted, bits)
    many = np.bincount(word, minlength=n_words)
    first = np.cumsum(many) - many
    speaks = many[number] > 0
    pair = _ascending(text[speaks] * n_words + number[speaks])
    text, number = np.divmod(pair, max(1, n_words))
    size = many[number]
    at = np.arange(int(size.sum())) + np.repeat(first[number] - (np.cumsum(size) - size), size)
    key = _ascending((np.repeat(text, size) << bits) | feature[at])
    return key & ((1 << bits) - 1), key >> bits


# --- training -----------------------------------------------------------------------------

def _ragged(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.concatenate(rows) if rows else np.empty(0, np.int64), np.concatenate([[0], np.cumsum(lens)])


def fit_weights(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, size: int,
                epochs: int = 40, batch: int = 512, rate: float = 0.05, ridge: float = 1e-3,
                seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features and the bias: mini-batch Adam on the non-negative risk
    with the logistic loss.  A row is an array of features."""
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    if not positive or not unlabelled or not size:
        return w[:-1], float(w[-1])
    rng = np.random.default_rng(seed)
    pf, po = _ragged(positive)
    uf, uo = _ragged(unlabelled)

    def take(flat, offs, rows):
        lens = offs[rows + 1] - offs[rows]
        before = np.cumsum(lens) - lens
        at = np.arange(int(lens.sum())) + np.repeat(offs[rows] - before, lens)
        row = np.repeat(np.arange(len(rows)), lens)
        z = np.bincount(row, w[flat[at]], len(rows)) + w[-1]
        return flat[at], row, np.clip(z, -MARGIN, MARGIN), np.abs(z) < MARGIN

    step, steps = 0, max(epochs, -(-2000 * batch // max(1, len(unlabelled))))
    for _ in range(steps):
        order = rng.permutation(len(unlabelled))
        for lo in range(0, len(order), batch):
            u_rows = order[lo:lo + batch]
            p_rows = rng.integers(0, len(positive), min(batch, max(32, len(positive))))
            f_p, r_p, z_p, live_p = take(pf, po, p_rows)
            f_u, r_u, z_u, live_u = take(uf, uo, u_rows)
            s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
            # risk of calling everything negative, the positives' share taken out
            negative = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
            d_u, d_p = live_u * s_u / len(u_rows), prior * live_p * s_p / len(p_rows)
            if negative >= 0:
                g_p, g_u = prior * live_p * (s_p - 1) / len(p_rows) - d_p, d_u
            else:
                g_p, g_u = d_p, -d_u
            grad = np.bincount(f_p, g_p[r_p], size + 1) + np.bincount(f_u, g_u[r_u], size + 1)
            grad[-1] = g_p.sum() + g_u.sum()
            grad[:-1] += ridge * w[:-1]
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-7)
            # every feature was chosen as evidence of toxicity: none may speak against it
            np.maximum(w[:-1], 0, out=w[:-1])
    every = [take(f, o, np.arange(len(o) - 1))[2] for f, o in ((pf, po), (uf, uo))]
    scale, shift = _calibrate(*every, prior)
    return w[:-1] * scale, float(w[-1] * scale + shift)


def _calibrate(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[float, float]:
    """``(a, b)`` for which ``a * margin + b`` minimises the prior-corrected risk of all rows
    (convex in two numbers): the mean probability of unlabelled rows meets the prior."""
    a, b = 1.0, 0.0
    for _ in range(60):
        s = 1 / (1 + np.exp(-np.clip(a * z_u + b, -30, 30)))
        grad = np.array([(s * z_u).mean() - prior * z_p.mean() + 1e-4 * (a - 1), s.mean() - prior])
        h = s * (1 - s)
        hess = np.array([[(h * z_u * z_u).mean() + 1e-4, (h * z_u).mean()],
                         [(h * z_u).mean(), h.mean() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        step /= max(1.0, np.abs(step).max())
        a, b = max(0.1, a - step[0]), b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def _frequencies(docs: DataFrame, wanted: np.ndarray | None) -> DataFrame:
    """``(feature, n)``: how many documents of ``docs`` have each (``wanted``) feature; a task
    gives its sums, 2**BITS at most."""
    flags = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for _, data, offs in text_chunks(batches, "text", CHUNK):
            total += np.bincount(word_features(data, offs, flags.value)[0], minlength=1 << BITS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])],
                                         names=["feature", "n"])

    return docs.select("text").mapInArrow(released(count), "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", positives: int = POSITIVE_ROWS,
        unlabelled: int = UNLABELLED_ROWS) -> ToxicModel:
    """Learn from rows of ``labels`` with ``label_col`` 1 as confirmed toxic, and from
    ``docs`` as unlabelled text; the class prior is the labelled rows' toxic share.

    Spark counts the features of about ``positives`` confirmed documents and of all of
    ``docs``; the optimiser gets those of the confirmed and of about ``unlabelled`` other
    documents at most, dealt by a hash of the id.
    """
    marked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    seen = marked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p")).first()
    total = docs.count()
    prior = min(0.9, max(1e-3, seen["p"] / seen["n"] if seen["n"] else 0.0))
    dealt = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = marked.where((F.col("y") == 1) & (dealt < int(1e6 * min(1.0, positives / max(1, seen["p"])))))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = texts.join(F.broadcast(chosen.select("id")), "id").select(F.lit(1).alias("y"), "id", "text")
    rest = texts.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000))
                       < int(1e6 * min(1.0, unlabelled / max(1, total)))).select(F.lit(0).alias("y"), "id", "text")

    n_p = known.count()
    p = _frequencies(known, None).where(F.col("n") >= MIN_COUNT).toPandas()
    candidate = np.zeros(1 << BITS, bool)
    candidate[p["feature"].to_numpy(np.int64)] = True
    u = _frequencies(texts, candidate).toPandas()
    p_of, u_of = np.zeros(1 << BITS), np.zeros(1 << BITS)
    p_of[p["feature"].to_numpy(np.int64)] = p["n"]
    u_of[u["feature"].to_numpy(np.int64)] = u["n"]
    # toxic among the unlabelled documents with a feature, as the confirmed ones let expect
    pure = p_of * (prior * total / max(1, n_p))
    names = np.flatnonzero(candidate & (pure >= MIN_PURE * u_of)
                           & (pure * (1 - 1 / np.sqrt(np.maximum(p_of, 1))) >= MIN_BOUND * u_of))
    wanted = np.zeros(1 << BITS, bool)
    wanted[names] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            feature, text = word_features(data, offs, wanted)
            ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=rows.num_rows))])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(feature.astype(np.int32)))],
                names=["y", "id", "features"])

    kind = texts.schema["id"].dataType.simpleString()
    both = known.unionByName(rest)
    got = both.mapInArrow(released(run), f"y int, id {kind}, features array<int>").toPandas()
    got = got.sort_values(["y", "id"], kind="stable")
    rows = {y: [np.searchsorted(names, np.asarray(f, np.int64)) for f in got.loc[got["y"] == y, "features"]]
            for y in (0, 1)}
    own, bias = fit_weights(rows[1], rows[0], prior, len(names))
    weights = np.zeros(1 << BITS, np.float32)
    weights[names] = own
    return ToxicModel(weights, bias, prior)


def _probabilities(weights: np.ndarray, wanted: np.ndarray, bias: float, data: np.ndarray,
                   offs: np.ndarray) -> np.ndarray:
    feature, text = word_features(data, offs, wanted)
    z = np.bincount(text, weights[feature], len(offs) - 1) + bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id, score)``: the probability that every row's whole text is toxic.

    Null counts as empty, and a text without words gets the model's bias alone.  Null
    and repeated ids are kept; an empty table gives an empty result.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # 2**BITS floats
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        wanted = w != 0
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            p = _probabilities(w, wanted, bias, data, offs)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(p, pa.float64())],
                                             names=["id", "score"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(released(run), f"id {kind}, score double")


def keep_rows(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``TOXIC``, with all their columns; no row
    is moved."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        wanted = w != 0
        for rows, data, offs in text_chunks(batches, text_col, CHUNK):
            yield rows.filter(pa.array(_probabilities(w, wanted, bias, data, offs) < TOXIC))

    return docs.mapInArrow(released(run), docs.schema)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned: ``crc32(id as text) mod 4 = 2``."""
    return F.coalesce(id_crc(id_col) % 4 == 2, F.lit(False))
