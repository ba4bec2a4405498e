"""Best-fit packing by minimum bin slack.

Bins are filled one after the other: the longest piece left opens the bin, and a
subset-sum dynamic programme over the lengths still available (one bit per fill level)
finds the fullest combination for the rest, which is then removed.  Only the number of
pieces of each length matters for that, so the programme runs over a histogram of at
most ``capacity`` rows however large the corpus, and a combination is used as many
times at once as the histogram allows.

The plan says, for each length, which ranks go to which combination.  Pieces get
their rank within their length from per-task counters and a prefix sum over tasks, and
find their sequence and offset by an equi-join with the plan: no piece list is ever
collected, and every length's pieces spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterprep.llm.common import chunk_texts, materialize, release_freed, text_chunks
from rasterprep.llm.tokens import REMEMBERED, encoder, forget_encoders

PIECE_COLUMNS = "piece int, start long, length long, ids binary, part int, nth long"
#: Bytes of text encoded together: their ids and words take some thirty times as much meanwhile.
CHUNK = 1 << 19
PLAN_SCHEMA = ("length long, rank_lo long, rank_hi long, per_bin long, first_sequence long, "
               "first_offset long")


# --- the dynamic programme ---------------------------------------------------------------

def fullest(available: list[tuple[int, int]], capacity: int) -> list[tuple[int, int]]:
    """The multiset of ``(length, how many)`` with the largest sum up to ``capacity``.

    ``available`` holds ``(length, count)`` in descending length.  Bit ``s`` of a
    reachable set says that some choice so far sums to ``s``.
    """
    if capacity <= 0:
        return []
    mask, goal = (1 << (capacity + 1)) - 1, 1 << capacity
    reach, steps = 1, []
    for length, count in available:
        if length > capacity or reach & goal:
            continue
        left, k = min(count, capacity // length), 1
        while left > 0 and not reach & goal:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left -= k
            k *= 2
    total, chosen = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not (before >> total) & 1:
            chosen[length] = chosen.get(length, 0) + k
            total -= length * k
    return sorted(chosen.items(), reverse=True)


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """``(combination, times)`` until every piece of the histogram has a place."""
    left = {n: c for n, c in sorted(histogram.items(), reverse=True) if c > 0}
    out = []
    while left:
        longest = next(iter(left))
        available = [(n, c - (n == longest)) for n, c in left.items() if c - (n == longest) > 0]
        combination = {longest: 1}
        for n, k in fullest(available, capacity - longest):
            combination[n] = combination.get(n, 0) + k
        times = min(left[n] // k for n, k in combination.items())
        out.append((combination, times))
        for n, k in combination.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def plan_rows(bins: list[tuple[dict[int, int], int]]) -> list[tuple]:
    """The plan as rows: for a length's ranks from ``rank_lo`` below ``rank_hi``, a sequence
    takes ``per_bin`` of them from offset ``first_offset`` on."""
    rows, used, sequence = [], {}, 0
    for combination, times in bins:
        offset = 0
        for n, k in sorted(combination.items(), reverse=True):
            lo = used.get(n, 0)
            rows.append((n, lo, lo + k * times, k, sequence, offset))
            used[n] = lo + k * times
            offset += n * k
        sequence += times
    return rows


# --- pieces ------------------------------------------------------------------------------------

def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
                 id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED,
                 keep_words: bool = True) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``capacity`` from its end, so
    that only the first piece may be shorter.

    Returns ``(id, piece, start, length, ids, part, nth)``: ``ids`` are little-endian
    unsigned 32-bit integers; ``part`` is the task and ``nth`` counts its earlier pieces
    of the same length.  Without ``keep_words`` a worker forgets its words (and the
    tokenizer) when a task ends.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_freed()                  # what earlier stages left in the worker
        try:
            yield from encoded(batches)
        finally:
            if not keep_words:
                forget_encoders()
            release_freed()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, False, remembered)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            ids, n = enc.encode(chunk_texts(data, offs))
            ends = np.cumsum(n)
            whole = np.insert(ids, ends, end_id).astype("<u4")   # the end id after each document
            total = n + 1
            first = np.cumsum(total) - total
            count = -(-total // capacity)
            head = total - (count - 1) * capacity                # length of the first piece
            doc = np.repeat(np.arange(len(n)), count)
            piece = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            length = np.where(piece == 0, head[doc], capacity)
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            # running count within equal lengths
            order = np.argsort(length, kind="stable")
            run_of = length[order]
            fresh = np.flatnonzero(np.diff(run_of, prepend=-1))
            nth = np.empty(len(length), np.int64)
            nth[order] = (np.arange(len(length)) - np.repeat(fresh, np.diff(np.append(fresh, len(length))))
                          + seen[run_of])
            seen += np.bincount(length, minlength=capacity + 1)
            raw, at = whole.tobytes(), ((first[doc] + start) * 4)
            blobs = [raw[a:b] for a, b in zip(at.tolist(), (at + length * 4).tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(blobs, pa.binary()),
                 pa.array(np.full(len(doc), part, np.int32)), pa.array(nth)],
                names=["id", "piece", "start", "length", "ids", "part", "nth"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, {PIECE_COLUMNS}")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``(length, part, nth)``.

    ``pieces`` is read several times, so it should be a written table.
    """
    spark = pieces.sparkSession
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in               # at most ``capacity`` rows
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame(plan_rows(plan_bins(histogram, capacity)), PLAN_SCHEMA)
    # computed columns are evaluated below the shuffle, so that only they move
    moved = pieces.repartition("part", "length")
    ranked = moved.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    # the plan's rows are bounded by the capacity, not by the corpus
    found = ranked.join(F.broadcast(plan), "length").where("rank >= rank_lo AND rank < rank_hi")
    nth_in_plan = F.col("rank") - F.col("rank_lo")
    return found.select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(nth_in_plan / F.col("per_bin")).cast("long")).alias("sequence_id"),
        (F.col("first_offset") + nth_in_plan % F.col("per_bin") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048,
         id_col: str = "doc_id", text_col: str = "text",
         instead_of_ids: dict[str, Column] | None = None, remembered: int = REMEMBERED,
         keep_words: bool = True) -> DataFrame:
    """Pack all documents' tokens into sequences of at most ``capacity``.

    Returns ``(id, piece, start, length, ids, sequence_id, offset)`` per piece; offsets of
    a sequence are gapless from 0.  ``instead_of_ids`` names columns over ``ids`` that are
    returned in its place, computed before pieces are shuffled.  ``remembered`` words are
    kept by a worker: fewer take less memory and more time; without ``keep_words`` only until
    its task ends, which leaves the memory to later stages of other kinds.  A null or empty text is its end id alone; null and
    repeated ids are kept as rows of their own; an empty table gives an empty result.
    """
    pieces = materialize(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, remembered, keep_words),
                         "pieces")
    if instead_of_ids is not None:
        pieces = pieces.withColumns(instead_of_ids).drop("ids")
    return place(pieces, capacity).drop("part", "nth")


def sequence_order(packed: DataFrame, name: str = "position") -> DataFrame:
    """Pieces numbered within their sequence, in offset order."""
    order = Window.partitionBy("sequence_id").orderBy("offset")
    return packed.withColumn(name, F.row_number().over(order) - 1)
