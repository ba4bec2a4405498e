"""Quality scores from compression: which dictionary makes a text smaller?

Two zstandard dictionaries are trained, one on good and one on bad labelled texts.
A whole text is compressed with each, in portions, as a compressor that has seen much of a
long text needs no dictionary any more; the difference of the two sizes over the text's
bytes says which kind of text it resembles.  A logistic fit on labelled texts that no
dictionary saw turns the difference into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.llm.common import id_crc, released, text_chunks

#: Labelled documents of each class used for fitting, at most about.
TRAIN_ROWS = 6_000
#: Code points of a labelled document that a dictionary is trained on, at most: spans spread
#: over the whole text.
SAMPLE_CHARS, SPANS = 4_096, 4
#: Bytes compressed at once.
PORTION = 512
DICT_BYTES = 112_640
LEVEL = 3
#: A document is good from this score on.
GOOD = 0.5


@dataclass
class QualityModel:
    """Dictionaries of the two classes and the logistic coefficients."""

    good: bytes
    bad: bytes
    weights: list[float]
    #: Probability given when one class has no labelled text.
    constant: float | None = None


def _compressor(raw: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(raw)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


def sizes(good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor,
          texts: list[bytes]) -> np.ndarray:
    """``(compressed with good, with bad, bytes)`` of every text, summed over its portions."""
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        parts = [text[a:a + PORTION] for a in range(0, max(1, len(text)), PORTION)]
        out[i] = (sum(len(good.compress(p)) for p in parts), sum(len(bad.compress(p)) for p in parts), len(text))
    return out


def features(size: np.ndarray) -> np.ndarray:
    """The size difference normalised by the text's bytes and by the compressed bytes, the first
    also damped by length, as a short text's difference says less."""
    n = np.maximum(size[:, 2], 1)
    diff = np.clip((size[:, 1] - size[:, 0]) / n, -1, 1)
    share = (size[:, 1] - size[:, 0]) / np.maximum(size[:, 1] + size[:, 0], 1)
    root = 1 / np.sqrt(1 + n / 100)
    return np.stack([np.ones(len(n)), diff, share, diff * root], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps of a weighted, lightly penalised logistic regression."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x = x / scale
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * 0.01 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * 0.01 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; too few samples for training give a raw one of their bytes."""
    samples = [t for t in texts if t]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, total // 4)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def spread(text_col: str, id_col: str, chars: int = SAMPLE_CHARS, spans: int = SPANS):
    """At most ``chars`` code points of a text: all of a shorter one; of a longer one ``spans``
    spans, one at a place in each equal part of it that a hash of the id chooses."""
    wide = chars // spans
    size, part = f"char_length({text_col})", f"(char_length({text_col}) div {spans})"
    span = (f"substring({text_col}, cast(1 + i * {part} + pmod(xxhash64({id_col}, i), {part} - {wide} + 1) as int), "
            f"{wide})")
    return F.expr(f"if({size} <= {chars}, {text_col}, array_join(transform(sequence(0, {spans - 1}), "
                  f"i -> {span}), ''))")


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", rows: int = TRAIN_ROWS, chars: int = SAMPLE_CHARS) -> QualityModel:
    """Learn from the labelled rows given (``label_col`` 1 or 0; others are ignored).

    About ``rows`` documents of each class at most, dealt by a hash of the id, come to
    the driver; the rest of the corpus is never collected.  A dictionary is trained on ``chars``
    code points of a document at most, taken from all parts of its text; scores and their
    calibration read whole texts.
    """
    marked = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")))
    share = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(share) < 2:
        return QualityModel(b"", b"", [0.0] * 4, constant=float(next(iter(share), 1)))
    cut = F.lit(0)
    for y, n in share.items():
        cut = F.when(F.col("y") == y, int(1e6 * min(1.0, rows / n))).otherwise(cut)
    dealt = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = marked.where(dealt < cut)                                        # about 2 * rows rows
    texts = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(chosen), "id")
             .withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(3)) == 0))
    # a sample of each dictionary text comes to the driver, of the others only their sizes
    got = (texts.where("NOT own").select("id", "y", spread("text", "id", chars).alias("text"))
           .toPandas().sort_values("id", kind="stable"))
    raw = {c: _dictionary([t.encode() for t in got.loc[got["y"] == c, "text"]]) for c in (0, 1)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = (_compressor(raw[1]), _compressor(raw[0]))
        for rows, data, offs in text_chunks(batches, "text"):
            text, edges = data.tobytes(), offs.tolist()
            got = sizes(*pair, [text[a:b] for a, b in zip(edges, edges[1:])])
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c) for c in got.T)],
                                             names=["y", "g", "b", "n"])

    seen = texts.where("own").select("y", "text").mapInArrow(
        released(measure), "y int, g double, b double, n double").toPandas().sort_values(["y", "g", "b", "n"])
    y, x = seen["y"].to_numpy(), features(seen[["g", "b", "n"]].to_numpy())
    if len(set(y)) < 2:
        return QualityModel(b"", b"", [0.0] * 4, constant=share[1] / (share[0] + share[1]))
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum())
    return QualityModel(raw[1], raw[0], _logistic(x, y, weight).tolist())


_COMPRESSORS: dict[int, tuple] = {}


def _probabilities(model: QualityModel, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The score of every text of a chunk; a worker prepares a model's dictionaries once."""
    if model.constant is not None:
        return np.full(len(offs) - 1, model.constant)
    key = hash((model.good, model.bad))
    if key not in _COMPRESSORS:
        _COMPRESSORS.clear()
        _COMPRESSORS[key] = (_compressor(model.good), _compressor(model.bad))
    raw, edges = data.tobytes(), offs.tolist()
    x = features(sizes(*_COMPRESSORS[key], [raw[a:b] for a, b in zip(edges, edges[1:])]))
    return 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id, score)``: the probability that every row's whole text is good.

    Null counts as empty; an empty text has no size difference and gets what the fit
    gives a text of no length.  Null and repeated ids are kept; an empty table gives an
    empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(_probabilities(model, data, offs), pa.float64())],
                names=["id", "score"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(released(run), f"id {kind}, score double")


def keep_rows(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores ``GOOD`` or more, with all their columns; no
    row is moved."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, text_col):
            yield rows.filter(pa.array(_probabilities(model, data, offs) >= GOOD))

    return docs.mapInArrow(released(run), docs.schema)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned: ``crc32(id as text) mod 3 = 1``."""
    return F.coalesce(id_crc(id_col) % 3 == 1, F.lit(False))
