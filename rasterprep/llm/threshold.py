"""Hard negatives by Fagin's threshold algorithm.

Rows become blocks of a few thousand vectors with integer components; a block keeps, for
every dimension, its rows sorted by that component.  An anchor reads the lists of a block
from the end that its component's sign favours, all lists to the same depth.  Every row
met is scored by its exact integer inner product.  The threshold is the score that a row
not yet met could have at most: the components at the current depth times the anchor's.
Reading stops once the threshold is strictly below the k-th score of every window asked for
(or below the window, where it holds fewer), so nothing that could enter a result is left
out, ties included.

Anchors are a share of the rows, so they are taken in passes of a bounded number.  A pass
sends its anchors to all tasks, which go through the blocks and keep the best rows of each
window across their blocks; Spark joins what the tasks found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterprep.llm.common import scratch_dir

#: Vectors of a block; a position has to fit into 16 bits.
BLOCK_ROWS = 2048
#: Anchors of a pass, about: the number that a task holds and a broadcast carries.
PASS_ANCHORS = 16_384
#: Blocks of a file, at most.
FILE_BLOCKS = 16
#: Components beyond this could take scores beyond 64 bits.
MAX_COMPONENT = 1 << 27
#: Depth of the first reading; it doubles from there.
FIRST_DEPTH = 32

LOW, HIGH = -(1 << 63), (1 << 63) - 1
_BLOCK = "block long, rows int, ids binary, labels binary, vectors binary, sorted binary"
_FOUND = "anchor int, win int, id long, score long"


# --- blocks of vectors --------------------------------------------------------------------

def scaled(values: np.ndarray) -> np.ndarray:
    """Components as integers: ``floor(256 * x)``."""
    return np.floor(256.0 * values.astype(np.float64)).astype(np.int64)


def _usable(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, labels, vectors)`` of the rows of a batch that take part; shorter vectors end
    with zeros."""
    vectors = batch.column(2)
    sizes = np.diff(vectors.offsets.to_numpy()).astype(np.int64)
    sizes[vectors.is_null().to_numpy(zero_copy_only=False)] = 0
    flat = vectors.flatten()
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(invalid="ignore"):
        bad = missing | ~(np.abs(values) <= MAX_COMPONENT / 256 - 1)
    row = np.repeat(np.arange(len(sizes)), sizes)
    use = np.bincount(row[bad], minlength=len(sizes)) == 0
    use &= ~vectors.is_null().to_numpy(zero_copy_only=False)
    use &= ~batch.column(1).is_null().to_numpy(zero_copy_only=False)
    wide = int(sizes.max()) if len(sizes) else 0
    full = np.zeros((len(sizes), wide), np.int64)
    within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    full[row, within] = scaled(np.where(bad, 0, values))
    ids = batch.column(0).fill_null(HIGH).to_numpy(zero_copy_only=False)
    labels = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
    return ids[use].astype(np.int64), labels[use].astype(np.int64), full[use]


def _widened(parts: list[np.ndarray]) -> np.ndarray:
    wide = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])


def vector_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of the rows ``(id, label, vector)`` that take part, written as a table.

    Rows stay in the task that reads them; no key deals them, so no label and no repeated
    vector makes a block large.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, ...]] = []

        def cut(all_rows: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            if not held:
                return
            ids, labels = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            vectors = _widened([h[2] for h in held])
            at = 0
            while len(ids) - at >= (1 if all_rows else BLOCK_ROWS):
                piece = slice(at, at + BLOCK_ROWS)
                v = vectors[piece]
                order = np.argsort(v, axis=0, kind="stable").T.astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) | n]), pa.array([len(v)], pa.int32()),
                     *[pa.array([x.tobytes()], pa.binary())
                       for x in (ids[piece], labels[piece], v.astype("<i4"), order)]],
                    names=["block", "rows", "ids", "labels", "vectors", "sorted"])
                n, at = n + 1, at + len(v)
            held = [(ids[at:], labels[at:], vectors[at:])] if at < len(ids) else []

        waiting = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                got = _usable(batch.slice(lo, BLOCK_ROWS))
                held.append(got)
                waiting += len(got[0])
                if waiting >= BLOCK_ROWS:
                    yield from cut(False)
                    waiting = len(held[0][0]) if held else 0
        yield from cut(True)

    spark = rows.sparkSession
    blocks = -(-rows.count() // BLOCK_ROWS)
    files = max(1, min(blocks, max(4 * spark.sparkContext.defaultParallelism, -(-blocks // FILE_BLOCKS))))
    path = scratch_dir(spark, "vector-blocks")
    made = rows.mapInArrow(build, _BLOCK)
    made.repartition(files).write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


class Block:
    """One block, unpacked: ``columns`` holds for each dimension its rows by that component."""

    def __init__(self, key: int, rows: int, ids: bytes, labels: bytes, vectors: bytes, order: bytes):
        self.key, self.rows = key, rows
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.vectors = np.frombuffer(vectors, "<i4").reshape(rows, -1).astype(np.int64)
        self.columns = np.frombuffer(order, "<u2").reshape(-1, rows).astype(np.int64)
        self.most = int(np.abs(self.vectors).max()) if self.vectors.size else 0


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(*[batch.column(k)[i].as_py() for k in range(6)])


# --- the threshold algorithm ---------------------------------------------------------------

class Best:
    """The best ``k`` rows so far of every window of every anchor."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        n, windows = low.shape
        self.low, self.high, self.k = low, high, k
        self.score = np.full((n, windows, k), LOW, np.int64)
        self.id = np.full((n, windows, k), HIGH, np.int64)
        self.filled = np.zeros((n, windows), np.int64)

    def floor(self, a: int) -> np.ndarray:
        """For each window of an anchor, the least score that still matters."""
        full = self.filled[a] == self.k
        return np.where(full, np.maximum(self.score[a, :, -1], self.low[a]), self.low[a])

    def add(self, a: int, ids: np.ndarray, scores: np.ndarray) -> None:
        hits = (scores >= self.floor(a)[:, None]) & (scores <= self.high[a][:, None])
        for w in np.flatnonzero(hits.any(axis=1)).tolist():
            m = self.filled[a, w]
            s = np.concatenate([self.score[a, w, :m], scores[hits[w]]])
            i = np.concatenate([self.id[a, w, :m], ids[hits[w]]])
            if len(s) > 4 * self.k:
                near = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
                s, i = s[near], i[near]
            top = np.lexsort((i, ~s))[:self.k]         # ~s falls as s grows, without overflow
            self.score[a, w, :len(top)], self.id[a, w, :len(top)] = s[top], i[top]
            self.filled[a, w] = len(top)


def scan(block: Block, anchors: np.ndarray, vectors: np.ndarray, labels: np.ndarray, own: np.ndarray,
         same_label: bool, best: Best) -> int:
    """Bring a block's rows into ``best`` for all anchors; returns how many rows were scored.

    ``own`` is each anchor's place in this block, or -1.
    """
    wide = min(block.vectors.shape[1], vectors.shape[1])
    table, lists = block.vectors[:, :wide], block.columns[:wide]
    most = int(np.abs(vectors).max()) if vectors.size else 0
    # products of whole numbers below 2**53 are exact in doubles, which numpy multiplies faster
    exact = np.float64 if most * block.most * max(wide, 1) < 1 << 53 else np.int64
    table = table.astype(exact)
    at_end = np.take_along_axis(block.vectors[:, :wide].T, lists, axis=1) if wide else np.empty((0, block.rows))
    n, scored = block.rows, 0
    for a in anchors.tolist():
        q = vectors[a, :wide]
        up, down = np.flatnonzero(q > 0), np.flatnonzero(q < 0)
        query = q.astype(exact)
        like = block.labels == labels[a]
        allowed = like if same_label else ~like
        if own[a] >= 0:
            allowed = allowed.copy()
            allowed[own[a]] = False
        open_windows = best.low[a] <= best.high[a]
        if not open_windows.any() or not allowed.any():
            continue
        unmet = np.ones(n, bool)
        depth, take = 0, FIRST_DEPTH
        while depth < n:
            to = min(n, depth + take) if len(up) + len(down) else n
            met = np.zeros(n, bool)
            if len(up) + len(down):
                met[lists[up, n - to:n - depth]] = True
                met[lists[down, depth:to]] = True
            else:
                met[:] = True                          # a zero vector: every score is 0
            met &= unmet
            unmet &= ~met
            rows = np.flatnonzero(met & allowed)
            if len(rows):
                scored += len(rows)
                best.add(a, block.ids[rows], (table[rows] @ query).astype(np.int64))
            depth, take = to, 2 * take
            if depth < n:
                bound = int(q[up] @ at_end[up, n - depth]) + int(q[down] @ at_end[down, depth - 1])
                if (bound < best.floor(a)[open_windows]).all():
                    break
    return scored


def _search(blocks: DataFrame, anchors: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray, k: int,
            same_label: bool) -> DataFrame:
    """``(anchor, win, id, score)``: the best ``k`` rows of every anchor's windows."""
    sent = blocks.sparkSession.sparkContext.broadcast((anchors, low, high))    # one pass's anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, lows, highs = sent.value
        best = Best(lows, highs, k)
        every = np.arange(len(who["labels"]))
        for block in _blocks(batches):
            own = np.where(who["block"] == block.key, who["place"], -1)
            scan(block, every, who["vectors"], who["labels"], own, same_label, best)
        a, w, r = np.nonzero(np.arange(k)[None, None, :] < best.filled[:, :, None])
        for lo in range(0, len(a), 65_536):
            x = slice(lo, lo + 65_536)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[x].astype(np.int32)), pa.array(w[x].astype(np.int32)),
                 pa.array(best.id[a[x], w[x], r[x]]), pa.array(best.score[a[x], w[x], r[x]])],
                names=["anchor", "win", "id", "score"])

    order = Window.partitionBy("anchor", "win").orderBy(F.col("score").desc(), "id")
    return (blocks.mapInArrow(run, _FOUND).withColumn("nth", F.row_number().over(order))
            .where(F.col("nth") <= k))


# --- hard negatives --------------------------------------------------------------------------

def _anchor_rows(blocks: DataFrame, every: int, passes: int) -> DataFrame:
    """``(pass, block, place, id, label, vector)`` of the anchors, dealt over passes by a hash."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            place = np.flatnonzero((b.ids % every == 0) & (b.ids != HIGH))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), b.key)), pa.array(place.astype(np.int32)), pa.array(b.ids[place]),
                 pa.array(b.labels[place]), pa.array([b.vectors[p].astype("<i4").tobytes() for p in place.tolist()],
                                                     pa.binary())],
                names=["block", "place", "id", "label", "vector"])

    found = blocks.mapInArrow(pick, "block long, place int, id long, label long, vector binary")
    return found.withColumn("pass", F.pmod(F.xxhash64("block", "place"), F.lit(passes)).cast("int"))


def _unpacked(rows: list) -> dict[str, np.ndarray]:
    vectors = [np.frombuffer(r["vector"], "<i4").astype(np.int64)[None, :] for r in rows]
    return {"block": np.array([r["block"] for r in rows], np.int64),
            "place": np.array([r["place"] for r in rows], np.int64),
            "ids": np.array([r["id"] for r in rows], np.int64),
            "labels": np.array([r["label"] for r in rows], np.int64),
            "vectors": _widened(vectors)}


def hard_negatives(table: DataFrame, every: int, positives: int = 5, negatives: int = 3,
                   window: tuple[int, int] = (50, 95), id_col: str = "vec_id", vector_col: str = "embedding",
                   label: Column | str = "label", pass_anchors: int = PASS_ANCHORS) -> DataFrame:
    """For each anchor and each of its positives, the best different-label rows whose score lies
    in a window below the positive's.

    Anchors are the rows whose id is divisible by ``every``; every row of a repeated id is a
    row of its own, as anchor and as partner.  A component x counts as ``floor(256 * x)``
    and a score is the inner product of two rows; higher scores come first, ties by smaller
    id.  Positives are the anchor's first ``positives`` other rows of its label; negatives
    the first ``negatives`` rows of another label with ``window[0] * p <= 100 * score <=
    window[1] * p`` for the positive's score p.

    Returns ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.
    Rows with a null label, a null vector, a null or non-finite component, or a component
    beyond ``MAX_COMPONENT / 256`` (about 500,000) take no part.  A shorter vector counts as
    ended by zeros.  Rows without an id are partners but no anchors, come last among equal
    scores and are returned as null.  A positive without negatives, and a table without
    anchors, give no rows.
    """
    spark = table.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    rows = table.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.col(vector_col).alias("vector")).where("label IS NOT NULL AND vector IS NOT NULL")
    blocks = vector_blocks(rows)
    count = table.where(F.col(id_col) % every == 0).count()
    passes = max(1, -(-count // pass_anchors))
    anchors = _anchor_rows(blocks, every, passes)
    out = scratch_dir(spark, "hard-negatives")
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    for number in range(passes):
        picked = anchors.where(F.col("pass") == number).drop("pass").collect()   # about pass_anchors rows
        found = _one_pass(blocks, sorted(picked), positives, negatives, window) if picked else None
        if found is None:
            found = spark.createDataFrame([], schema)
        found.write.parquet(f"{out}/pass={number}")
    return spark.read.schema(schema).parquet(*[f"{out}/pass={number}" for number in range(passes)])


def _one_pass(blocks: DataFrame, picked: list, positives: int, negatives: int,
              window: tuple[int, int]) -> DataFrame:
    spark = blocks.sparkSession
    anchors = _unpacked(picked)
    n = len(picked)
    whole = np.full((n, 1), LOW, np.int64), np.full((n, 1), HIGH, np.int64)
    near = _search(blocks, anchors, *whole, positives, True).select("anchor", "nth", "id", "score")
    path = scratch_dir(spark, "positives")
    near.write.parquet(path)
    near = spark.read.schema("anchor int, nth int, id long, score long").parquet(path)
    # a window nobody fits stays where an anchor has fewer positives
    low, high = np.full((n, positives), HIGH, np.int64), np.full((n, positives), LOW, np.int64)
    for r in near.collect():                                       # ``positives`` rows an anchor
        p = r["score"]
        low[r["anchor"], r["nth"] - 1] = -(-window[0] * p // 100)
        high[r["anchor"], r["nth"] - 1] = window[1] * p // 100
    far = _search(blocks, anchors, low, high, negatives, False)
    far = far.select("anchor", (F.col("win") + 1).alias("nth"), F.col("nth").alias("rank"),
                     F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("anchor", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = spark.createDataFrame([(k, int(i)) for k, i in enumerate(anchors["ids"])], "anchor int, anchor_id long")

    def given(c: str) -> Column:
        return F.when(F.col(c) != HIGH, F.col(c)).alias(c)

    return far.join(near, ["anchor", "nth"]).join(names, "anchor").select(
        "anchor_id", given("positive_id"), "rank", given("negative_id"), "positive_score", "negative_score")
