"""Byte-level BPE encoding and decoding with a vectorised pre-tokeniser.

The pre-tokeniser uses no regular expression.  Every code point is looked up in a
class array; classes become kinds by looking at their neighbours (is this space
followed by a visible character? does a contraction follow this apostrophe?).  Each
kind is a transition function on the open-token states below.  Functions compose
associatively, so all prefixes are composed by a blocked scan: numpy steps through
the columns of a matrix of blocks, then doubles over the blocks' composites.  State
and kind together say where a pre-token starts.

The slices between boundaries feed a cache of merged pieces; unseen pieces are merged
together (:func:`rasterprep.llm.merges.merge_pieces`).  Offsets of pieces and ids are
kept, so decoding gathers the tokens' bytes back per text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rasterprep.llm.common import text_chunks
from rasterprep.llm.merges import RaggedCache, merge_pieces, rank_table

# --- classes of code points ------------------------------------------------------------

OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE, END, C_ONE, C_RV, C_E, C_L = range(11)
_LETTERS = (LETTER, C_ONE, C_RV, C_E, C_L)


def class_array() -> np.ndarray:
    """The class of every code point; contraction letters have classes of their own."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.zeros(0x110000, np.uint8)
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, every):
            lo, hi = m.span()
            # positions above the surrogates are shifted by their count
            classes[lo + (0x800 if lo >= 0xD800 else 0):hi + (0x800 if hi > 0xD800 else 0)] = value
    # fixed values: the Unicode White_Space property
    blanks = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
              0x202F, 0x205F, 0x3000]
    classes[blanks] = BLANK
    classes[0x20], classes[0x27] = SPACE, QUOTE
    for chars, value in (("stmd", C_ONE), ("rv", C_RV), ("e", C_E), ("l", C_L)):
        classes[[ord(c) for c in chars]] = value
    return classes


# --- the automaton ------------------------------------------------------------------------

# states: what is open before a character is read
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_BLANKS, C_LAST, C_FIRST, C_SECOND = range(9)
N_STATES = 9
# kinds: a class with what its neighbours say
K_LETTER, K_NUMBER, K_OTHER, K_SHORT, K_LONG, K_PREFIX, K_LAST_BLANK, K_BLANK, K_END = range(9)


def _rule(state: int, kind: int) -> tuple[int, bool]:
    """``(next state, whether a pre-token starts here)``."""
    if kind == K_LETTER:
        if state == C_LAST or state == C_SECOND:
            return FRESH, False
        if state == C_FIRST:
            return C_SECOND, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_SPACE)
    if kind == K_NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_SPACE)
    if kind == K_OTHER or (kind in (K_SHORT, K_LONG) and state in (IN_OTHERS, AFTER_SPACE)):
        return IN_OTHERS, state not in (IN_OTHERS, AFTER_SPACE)
    if kind == K_SHORT:
        return C_LAST, True
    if kind == K_LONG:
        return C_FIRST, True
    if kind == K_PREFIX:
        return AFTER_SPACE, True
    if kind == K_LAST_BLANK:
        return FRESH, True
    if kind == K_BLANK:
        return IN_BLANKS, state != IN_BLANKS
    return FRESH, True


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The kinds' functions closed under composition: ``(function of a kind, composition
    table, functions as arrays, number of the identity)``."""
    base = [tuple(_rule(s, k)[0] for s in range(N_STATES)) for k in range(9)]
    functions = [tuple(range(N_STATES))]
    number = {functions[0]: 0}
    at = 0
    while at < len(functions):
        for f in base:
            g = tuple(f[s] for s in functions[at])
            if g not in number:
                number[g] = len(functions)
                functions.append(g)
        at += 1
    table = np.array(functions, np.uint8)
    compose = np.array([[number[tuple(table[g][table[f]].tolist())] for g in range(len(functions))]
                        for f in range(len(functions))], np.uint8)
    return np.array([number[f] for f in base], np.uint8), compose, table, 0


_OF_KIND, _COMPOSE, _FUNCTIONS, _IDENTITY = _monoid()
_STARTS = np.array([[_rule(s, k)[1] for k in range(9)] for s in range(N_STATES)])
_N = len(_FUNCTIONS)
_COMPOSE_FLAT = _COMPOSE.ravel()


def _kinds(c: np.ndarray) -> np.ndarray:
    """Kinds of a class sequence that ends with END."""
    n = len(c)
    nxt = np.full(n, END, np.uint8)
    nxt[:-1] = c[1:]
    kind = np.full(n, K_OTHER, np.uint8)
    kind[(c == LETTER) | (c >= C_ONE)] = K_LETTER
    kind[c == NUMBER] = K_NUMBER
    blank = (c == SPACE) | (c == BLANK)
    visible_next = ~((nxt == SPACE) | (nxt == BLANK) | (nxt == END))
    kind[blank] = K_BLANK
    kind[(c == SPACE) & visible_next] = K_PREFIX
    kind[(c == BLANK) & visible_next] = K_LAST_BLANK
    quote = np.flatnonzero(c == QUOTE)
    if len(quote):
        one, two = nxt[quote], np.full(len(quote), END, np.uint8)
        inside = quote + 2 < n
        two[inside] = c[quote[inside] + 2]
        kind[quote[one == C_ONE]] = K_SHORT
        kind[quote[((one == C_RV) & (two == C_E)) | ((one == C_L) & (two == C_L))]] = K_LONG
    kind[c == END] = K_END
    return kind


def token_starts(classes: np.ndarray, block: int = 256) -> np.ndarray:
    """Where pre-tokens start in a class sequence whose texts each end with END (an END
    counts as a start)."""
    n = len(classes)
    if not n:
        return np.empty(0, np.int64)
    kind = _kinds(classes)
    rows = -(-n // block)
    fn = np.full(rows * block, _IDENTITY, np.uint8)
    fn[:n] = _OF_KIND[kind]
    fn = np.ascontiguousarray(fn.reshape(rows, block).T)     # one contiguous row per step
    before = np.empty_like(fn)                               # composite of the block up to a step
    acc = np.full(rows, _IDENTITY, np.int64)
    for j in range(block):
        before[j] = acc
        acc = _COMPOSE_FLAT[acc * _N + fn[j]].astype(np.int64)
    # inclusive scan of the blocks' composites by doubling
    step = 1
    while step < rows:
        acc[step:] = _COMPOSE_FLAT[acc[:-step] * _N + acc[step:]]
        step *= 2
    enter = np.full(rows, FRESH, np.uint8)
    enter[1:] = _FUNCTIONS[acc[:-1], FRESH]
    state = _FUNCTIONS[before, enter[None, :]].T.ravel()[:n]
    return np.flatnonzero(_STARTS[state, kind])


# --- encoding and decoding -------------------------------------------------------------------

class Codec:
    """Encodes and decodes chunks of texts with the ranks of one file."""

    def __init__(self, path: str, limit: int = 500_000):
        self.table, self.tokens = rank_table(path)
        self.classes = class_array()
        self.cache = RaggedCache(lambda pieces: merge_pieces(self.table, pieces), limit)
        self.token_len = np.array([len(t) for t in self.tokens], np.int64)
        self.token_first = np.cumsum(self.token_len) - self.token_len
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def pieces(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(byte start of every pre-token, number of them per text)`` of a chunk."""
        lead = (data & 0xC0) != 0x80                       # bytes that begin a code point
        first = np.flatnonzero(lead)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        # an END after each text: text i's code points move i places on
        ends = np.searchsorted(first, offs[1:])
        marks = ends + np.arange(len(ends))
        seq = np.empty(len(points) + len(ends), np.uint8)
        spot = np.ones(len(seq), bool)
        spot[marks] = False
        seq[marks] = END
        seq[spot] = self.classes[points]
        starts = token_starts(seq)
        starts = starts[spot[starts]]
        text = np.searchsorted(marks, starts)
        return first[starts - text], np.bincount(text, minlength=len(ends))

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(flat ids, ids per text)`` of a chunk."""
        starts, per_text = self.pieces(data, offs)
        raw = data.tobytes()
        edges = [*starts.tolist(), len(raw)]
        numbers = self.cache.numbers([raw[a:b] for a, b in zip(edges, edges[1:])])
        ids, lens = self.cache.gather(numbers)
        piece_end = np.concatenate([[0], np.cumsum(per_text)])
        id_end = np.concatenate([[0], np.cumsum(lens)])[piece_end]
        return ids, np.diff(id_end)

    def decode(self, ids: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(bytes, bytes per text)`` of flat ids."""
        lens = self.token_len[ids]
        before = np.cumsum(lens) - lens
        at = np.arange(int(lens.sum()), dtype=np.int64) + np.repeat(self.token_first[ids] - before, lens)
        ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(per_text)])]
        return self.token_bytes[at], np.diff(ends)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a rank file, built once."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids, starts)``: the token ids of every whole text, and the byte at which
    each pre-token starts.  A null text counts as empty and has no ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for rows, data, offs in text_chunks(batches, "text"):
            starts, per_text = c.pieces(data, offs)
            ids, n = c.encode(data, offs)
            inner = starts - np.repeat(offs[:-1], per_text)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), _lists(ids, n, pa.int32()), _lists(inner.astype(np.int32), per_text, pa.int32())],
                names=["id", "ids", "starts"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, ids array<int>, starts array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``(id, data)``: the bytes that the ``ids`` of :func:`encode` stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for batch in batches:
            ids = batch.column(1)
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            raw, n = c.decode(flat, np.array([len(x) if x.is_valid else 0 for x in ids], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), _blobs(raw, n)], names=["id", "data"])

    kind = encoded.schema["id"].dataType.simpleString()
    return encoded.select("id", "ids").mapInArrow(run, f"id {kind}, data binary")


def _lists(flat: np.ndarray, per_row: np.ndarray, kind: pa.DataType) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, kind))


def _blobs(raw: np.ndarray, per_row: np.ndarray) -> pa.Array:
    ends = np.cumsum(per_row).tolist()
    data = raw.tobytes()
    return pa.array([data[a:b] for a, b in zip([0, *ends], ends)], pa.binary())


def round_trip_digests(docs: DataFrame, ranks: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, and return the digests of both:
    ``(id, n_tokens, ids_sha256, decoded_sha256)``.

    Ids are hashed as little-endian unsigned 32-bit integers.  A null or empty text has
    no ids; null and repeated ids of rows are kept; an empty table gives an empty
    result.  Encoding and decoding share a task, so ids never leave it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks)
        for rows, data, offs in text_chunks(batches, "text"):
            ids, n = c.encode(data, offs)
            raw, n_bytes = c.decode(ids, n)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n), pa.array(_sha(ids.astype("<u4").tobytes(), n * 4)),
                 pa.array(_sha(raw.tobytes(), n_bytes))],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _sha(raw: bytes, lens: np.ndarray) -> list[str]:
    ends = np.cumsum(lens).tolist()
    view = memoryview(raw)
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip([0, *ends], ends)]
