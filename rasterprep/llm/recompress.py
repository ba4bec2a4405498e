"""Periodic runs of words by recompression.

A sequence of words becomes a run-length grammar: rounds of block compression (a maximal
block of one symbol gets a name for symbol and length) alternate with pair compression
(symbols are dealt into left and right ones by a hash of the round; every adjacent left and
right pair gets a name).  Equal stretches get equal names but for a few symbols at their
ends, so the longest common extension of two places is found by climbing to names that are
equal and descending where they differ, in steps that grow with the grammar's height.
Many extensions are answered together, each step being one numpy operation over all of
them.

A run of period ``q`` makes a stretch of places equal to those ``q`` further on.  Places on
a grid as wide as the shortest such stretch meet every one; over all periods the grids
have a harmonic number of places.  Where words agree there, extensions to both sides give
the exact run.  No suffix arrays are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterprep.llm.common import ascii_words, mix64, text_chunks

#: A run has at least this many words, and at least this many times its period.
MIN_WORDS, MIN_TIMES = 6, 4
#: Grid places looked at in one round of numpy work.
GRID_ROWS = 1 << 20
#: Bytes of text whose words share a grammar (a longer text is alone in its own).
CHUNK = 2 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


# --- the grammar ------------------------------------------------------------------------

def _blocks(sym: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(start of every block, its name, next free name)``; a block of one keeps its symbol."""
    starts = np.flatnonzero(np.diff(sym, prepend=sym[0] - 1))
    size = np.diff(starts, append=len(sym))
    named = sym[starts].copy()
    many = np.flatnonzero(size > 1)
    if len(many):
        rules, which = np.unique((named[many] << 32) | size[many], return_inverse=True)
        named[many] = fresh + which
        fresh += len(rules)
    return starts, named, fresh


def _pairs(sym: np.ndarray, ends: tuple[int, int], fresh: int, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(start of every pair or single, its name, next free name)``."""
    inner = (sym < ends[0]) | (sym >= ends[1])
    salt = np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    right = (mix64(sym.astype(np.uint64) ^ salt) & np.uint64(1)).astype(bool)
    both = inner[:-1] & inner[1:]
    one, other = both & ~right[:-1] & right[1:], both & right[:-1] & ~right[1:]
    head = np.flatnonzero(one if one.sum() >= other.sum() else other)
    if not len(head):
        return np.arange(len(sym)), sym, fresh
    rules, which = np.unique((sym[head] << 32) | sym[head + 1], return_inverse=True)
    named = sym.copy()
    named[head] = fresh + which
    stay = np.ones(len(sym), bool)
    stay[head + 1] = False
    return np.flatnonzero(stay), named[stay], fresh + len(rules)


class Grammar:
    """The levels of the grammar of a sequence, as arrays over all their nodes.

    Node ``g`` has the symbol ``sym[g]``, its parent ``up[g]`` and the children from
    ``lo[g]`` below ``hi[g]``.  The nodes of a level stand next to each other, the
    sequence itself first.  Symbols from ``fixed`` on are ends of texts: each occurs once,
    and they are never joined.  The sequence has to start and end with one.
    """

    def __init__(self, sequence: np.ndarray, fixed: int):
        self.n = len(sequence)
        level = sequence.astype(np.int64)
        n_ends = int((level >= fixed).sum())
        ends = (fixed, fixed + n_ends)
        fresh, seed, block, base = ends[1], 0, True, 0
        nothing = np.zeros(len(level), np.int32)
        sym, up, lo, hi, blocks = [level.astype(np.int32)], [], [nothing], [nothing], []
        while len(level) > 2 * n_ends:              # until every text is one symbol
            if block:
                starts, named, fresh = _blocks(level, fresh)
            else:
                starts, named, fresh = _pairs(level, ends, fresh, seed)
                seed += 1
            if len(starts) < len(level):
                opens = np.zeros(len(level), np.int32)
                opens[starts] = 1
                up.append((np.cumsum(opens) - 1 + base + len(level)).astype(np.int32))
                blocks.append(np.full(len(level), block))
                lo.append((starts + base).astype(np.int32))
                hi.append((np.append(starts[1:], len(level)) + base).astype(np.int32))
                sym.append(named.astype(np.int32))
                base += len(level)
                level = named
            block = not block
        up.append(np.zeros(len(level), np.int32))
        blocks.append(np.zeros(len(level), bool))
        self.sym, self.up, self.lo, self.hi, self.block = map(np.concatenate, (sym, up, lo, hi, blocks))
        inner = np.arange(len(self.sym)) < base     # the last level has no parents
        node = np.arange(len(self.sym), dtype=np.int32)
        self.first = inner & (self.lo[self.up] == node)
        self.last = inner & (self.hi[self.up] == node + 1)

    def extend(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from the places ``x`` and ``y`` on (``back``: up to them, leftwards)
        are equal.  No ``x`` equals its ``y``."""
        at, other = x.astype(np.int64), y.astype(np.int64)
        out = np.zeros(len(at), np.int64)
        live = np.arange(len(at))
        sym, up, sign = self.sym, self.up, -1 if back else 1
        edge = self.last if back else self.first
        while len(live):
            px, py = up[at], up[other]
            climb = edge[at] & edge[other] & (sym[px] == sym[py])
            same = sym[at] == sym[other]
            done = ~climb & ~same & (at < self.n)
            if done.any():
                out[live[done]] = sign * (at[done] - x[live[done]])
                go = ~done
                live, at, other, px, py, climb, same = (v[go] for v in (live, at, other, px, py, climb, same))
            # a block's symbols are all alike: what is left of both blocks is skipped together
            step = np.ones(len(at), np.int64)
            inside = np.flatnonzero(self.block[at])
            if len(inside):
                a, b, p, q = at[inside], other[inside], px[inside], py[inside]
                left = (np.minimum(a - self.lo[p], b - self.lo[q]) + 1 if back
                        else np.minimum(self.hi[p] - a, self.hi[q] - b))
                step[inside] = left
            if back:
                below, below_other = self.hi[at] - 1, self.hi[other] - 1
            else:
                below, below_other = self.lo[at], self.lo[other]
            at, other = (np.where(climb, px, np.where(same, at + sign * step, below)).astype(np.int64),
                         np.where(climb, py, np.where(same, other + sign * step, below_other)).astype(np.int64))
        return out


# --- runs of many texts -------------------------------------------------------------------

def _grid(starts: np.ndarray, sizes: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(places, periods)``, in portions: for every period each text is long enough for, the
    places of its grid.  Texts stand in ascending size."""
    longest = int(sizes[-1]) if len(sizes) else 0
    period = np.arange(1, longest // MIN_TIMES + 1, dtype=np.int64)
    if longest < MIN_WORDS or not len(period):
        return
    width = np.maximum(MIN_WORDS, MIN_TIMES * period)
    begin = starts[np.minimum(np.searchsorted(sizes, width), len(starts) - 1)]
    step = width - period
    rows = -(-(total - begin) // step)
    upto = np.cumsum(rows)
    lo = 0
    while lo < len(period):
        # one period's places may be more than a portion, they are cut in turn
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - rows[lo] + GRID_ROWS, side="right")))
        n = rows[lo:hi]
        for cut in range(0, int(n.sum()), 4 * GRID_ROWS):
            k = np.arange(cut, min(int(n.sum()), cut + 4 * GRID_ROWS))
            before = np.cumsum(n) - n
            which = np.searchsorted(before, k, side="right") - 1
            yield begin[lo:hi][which] + (k - before[which]) * step[lo:hi][which], period[lo:hi][which]
        lo = hi


def find_runs(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of all runs of all texts, ordered by text, start and
    period.

    ``words`` are the texts' words as numbers from 0, one text after the other.  A run is a
    maximal stretch of smallest period ``q`` and at least ``max(MIN_WORDS, MIN_TIMES * q)``
    words.
    """
    order = np.argsort(sizes, kind="stable")
    ascending = sizes[order]
    n_words = int(words.max()) + 1 if len(words) else 0
    total = len(words) + len(sizes) + 1
    # every text is followed by an end of its own; one more stands before the first
    starts = np.cumsum(ascending + 1) - ascending
    sequence = np.arange(n_words, n_words + total, dtype=np.int64)
    old = np.cumsum(sizes) - sizes
    if len(words):
        inner = np.repeat(starts - (np.cumsum(ascending) - ascending), ascending) + np.arange(len(words))
        sequence[inner] = words[np.repeat(old[order] - (np.cumsum(ascending) - ascending), ascending)
                                + np.arange(len(words))]
    is_end = np.ones(total, bool)
    if len(words):
        is_end[inner] = False
    sequence[is_end] = n_words + np.arange(len(sizes) + 1)
    found = []
    grammar = None
    for place, period in _grid(starts, ascending, total):
        fits = place + period < total
        place, period = place[fits], period[fits]
        alike = sequence[place] == sequence[place + period]
        place, period = place[alike], period[alike]
        within = (np.searchsorted(starts, place, side="right")
                  == np.searchsorted(starts, place + period, side="right"))
        place, period = place[within], period[within]
        if not len(place):
            continue
        if grammar is None:
            grammar = Grammar(sequence, n_words)
        ahead = grammar.extend(place, place + period)
        # the place itself agrees, so this counts it once more
        behind = grammar.extend(place, place + period, back=True) - 1
        enough = ahead + behind + period >= np.maximum(MIN_WORDS, MIN_TIMES * period)
        first = (place - behind)[enough]
        found.append(np.unique(np.stack([first, (place + ahead + period)[enough], period[enough]]), axis=1))
    if not found:
        return (np.empty(0, np.int64),) * 4
    first, last, period = np.concatenate(found, axis=1)
    # a stretch of period q also has the multiples of q: the smallest stays
    by = np.lexsort((period, last, first))
    first, last, period = first[by], last[by], period[by]
    fresh = np.ones(len(first), bool)
    fresh[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    first, last, period = first[fresh], last[fresh], period[fresh]
    slot = np.searchsorted(starts, first, side="right") - 1
    text, start = order[slot], first - starts[slot]
    by = np.lexsort((period, start, text))
    return text[by], start[by], (last - first)[by], period[by]


def collapsed_mask(size: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``size`` words stay: those that no run holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) == 0


def word_numbers(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(a number for every word, words per text)`` of a chunk; equal words have equal numbers."""
    starts, ends, row = ascii_words(data, offs)
    sizes = np.bincount(row, minlength=len(offs) - 1).astype(np.int64)
    if not len(starts):
        return np.empty(0, np.int64), sizes
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts] = 1
    edges[ends] -= 1
    letters = data[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), sizes


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, runs, collapsed)`` of every row's whole text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  ``runs`` holds every run, by start,
    then period; ``collapsed`` is the text of the words that no run holds after its first
    period, joined by one space.  A null or empty text has no words, no runs and an empty
    ``collapsed``.  Null and repeated ids are kept as rows of their own; an empty table gives
    an empty result.  A text is never cut, so its task needs memory in proportion to the
    longest text (about 200 bytes a word).
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offs in text_chunks(batches, "text", CHUNK):
            numbers, sizes = word_numbers(data, offs)
            text, start, length, period = find_runs(numbers, sizes)
            per_text = np.searchsorted(text, np.arange(len(sizes) + 1))
            raw, at = data.tobytes(), offs.tolist()
            kept = []
            for i, (lo, hi) in enumerate(zip(per_text[:-1].tolist(), per_text[1:].tolist())):
                words = raw[at[i]:at[i + 1]].split()       # of bytes: at the six white spaces of ASCII
                if hi > lo:
                    stay = collapsed_mask(len(words), start[lo:hi], length[lo:hi], period[lo:hi])
                    words = compress(words, stay.tolist())
                kept.append(b" ".join(words))
            runs = pa.ListArray.from_arrays(
                pa.array(per_text.astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)],
                                           fields=list(kind.value_type)))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes), runs, pa.array(kept, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "runs", "collapsed"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {id_kind}, n_words long, runs {RUNS}, collapsed string")


def longest_run(runs: str = "runs"):
    """The run of greatest length (ties: smallest start, then period) as a struct column; null
    where there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(F.size(runs) > 0, F.struct(
        (-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
