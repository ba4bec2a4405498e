"""Byte-pair merging of many pre-tokens at once, and token counts.

A batch of pre-tokens is one flat array of symbols with the start of every
sequence (a ragged array).  Each round looks at the rank of every adjacent pair,
finds each sequence's lowest-rank pair (the leftmost of equals) with one segmented
minimum, and applies all of them simultaneously; sequences without a mergeable
pair leave the batch.  Surviving symbols are the tokens.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rasterprep.llm.common import chunk_texts, text_chunks

NONE = np.int32(2**31 - 1)
#: Pieces longer than this merge one by one with a heap: rounds would be quadratic in their length.
LONG_PIECE = 256


class PairTable:
    """Ranks of mergeable pairs: ``(left id, right id) -> rank`` and ``rank -> merged id``."""

    def __init__(self, byte_ids: np.ndarray, pairs: list[tuple[int, int, int, int]]):
        left, right, rank, merged = (np.array(x, np.int64) for x in zip(*pairs))
        key = (left << 20) | right
        order = np.argsort(key)
        self.byte_ids = byte_ids.astype(np.int32)
        # one key above all others, so that a search never falls off the end
        self.keys = np.append(key[order], np.int64(1) << 60)
        self.ranks = np.append(rank[order], NONE).astype(np.int32)
        self.merged = np.zeros(int(rank.max()) + 1, np.int32)
        self.merged[rank] = merged
        self._dict: dict[int, int] | None = None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 20) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def lookup(self, left: int, right: int) -> int | None:
        if self._dict is None:
            self._dict = dict(zip(self.keys[:-1].tolist(), self.ranks[:-1].tolist()))
        return self._dict.get((left << 20) | right)


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in for every byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others are counted up from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def json_table(path: str) -> tuple[PairTable, list[str]]:
    """The pair table and the added special strings of a byte-level ``tokenizer.json``."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    byte_ids = np.zeros(256, np.int64)
    for char, byte in byte_alphabet().items():
        byte_ids[byte] = vocab[char]
    pairs = []
    for rank, merge in enumerate(merges):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append((vocab[a], vocab[b], rank, vocab[a + b]))
    return PairTable(byte_ids, pairs), [t["content"] for t in spec.get("added_tokens", [])]


def rank_table(path: str) -> tuple[PairTable, list[bytes]]:
    """The pair table and the tokens' bytes of a rank file: any two tokens whose bytes
    together are a token can merge, at that token's rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
    pairs = [(ranks[token[:i]], ranks[token[i:]], rank, rank)
             for token, rank in ranks.items() for i in range(1, len(token))
             if token[:i] in ranks and token[i:] in ranks]
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return PairTable(byte_ids, pairs), tokens


def _merge_long(table: PairTable, piece: bytes) -> list[int]:
    """One long piece: a heap of (rank, position) over a linked list of symbols."""
    sym = table.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
    n = len(sym)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def push(i: int) -> None:
        j = nxt[i]
        if j < n and (r := table.lookup(sym[i], sym[j])) is not None:
            heapq.heappush(heap, (r, i, sym[i], sym[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        r, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if sym[i] != a or j >= n or sym[j] != b:
            continue
        sym[i], sym[j] = int(table.merged[r]), -1
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        push(i)
        if prv[i] >= 0:
            push(prv[i])
    return [s for s in sym if s >= 0]


def merge_pieces(table: PairTable, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, lengths)``: the tokens of every piece, one piece after the other."""
    n = len(pieces)
    lens = np.fromiter(map(len, pieces), np.int64, n)
    out: list[np.ndarray | None] = [None] * n
    for i in np.flatnonzero(lens > LONG_PIECE).tolist():
        out[i] = np.array(_merge_long(table, pieces[i]), np.int32)
    seq = np.flatnonzero((lens > 0) & (lens <= LONG_PIECE))
    done_ids, done_seq, done_len = [], [], []
    if len(seq):
        flat = b"".join(pieces) if len(seq) == n else b"".join([pieces[i] for i in seq.tolist()])
        size = lens[seq]
        sym = table.byte_ids[np.frombuffer(flat, np.uint8)]
        rank = np.full(len(sym), NONE, np.int32)
        rank[:-1] = table.rank(sym[:-1], sym[1:])
        rank[np.cumsum(size) - 1] = NONE
        while len(seq):
            starts = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, starts)
            over = low == NONE
            if over.any():
                leave = np.repeat(over, size)
                done_ids.append(sym[leave])
                done_seq.append(seq[over])
                done_len.append(size[over])
                stay = ~leave
                sym, rank, seq, size, low = sym[stay], rank[stay], seq[~over], size[~over], low[~over]
                if not len(seq):
                    break
                starts = np.cumsum(size) - size
            at = np.flatnonzero(rank == np.repeat(low, size))
            at = at[np.unique(np.searchsorted(starts, at, side="right"), return_index=True)[1]]
            sym[at] = table.merged[low]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            ends = starts + size - 1
            last = at + 1 == ends              # the merged pair closes its sequence
            rank[at] = NONE
            inner = at[~last]
            rank[inner] = table.rank(sym[inner], sym[inner + 2])
            back = at[at > starts]
            rank[back - 1] = table.rank(sym[back - 1], sym[back])
            sym, rank, size = sym[stay], rank[stay], size - 1
    order_len = np.zeros(n, np.int64)
    for s, k in zip(done_seq, done_len):
        order_len[s] = k
    for i, ids in enumerate(out):
        if ids is not None:
            order_len[i] = len(ids)
    first = np.cumsum(order_len) - order_len
    ids = np.empty(int(order_len.sum()), np.int32)
    for s, k, x in zip(done_seq, done_len, done_ids):
        ids[np.repeat(first[s] - (np.cumsum(k) - k), k) + np.arange(len(x))] = x
    for i, x in enumerate(out):
        if x is not None:
            ids[first[i]:first[i] + len(x)] = x
    return ids, order_len


# --- ids of many keys, remembered -------------------------------------------------------

#: Characters (or bytes) of keys that a cache holds before it starts afresh, whatever their number.
KEY_CHARS = 48 << 20


class _Numbering(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class RaggedCache:
    """Remembers the ids of keys (words, pieces) across the batches of a Python worker.

    ``encode(keys) -> (flat ids, lengths)`` is asked only for keys not yet seen.  The
    cache starts afresh beyond ``limit`` keys or ``KEY_CHARS`` characters in them, so it holds
    at most these and what one batch adds.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 500_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.known = _Numbering()
        self.ids = np.empty(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int32)
        self.used = self.chars = 0

    def numbers(self, keys: list) -> np.ndarray:
        """The cache's number of every key, learning those not seen before."""
        if len(self.known) > self.limit or self.chars > KEY_CHARS:
            self._clear()
        base = len(self.known)
        found = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        if len(self.known) > base:
            try:
                self._learn(base, list(islice(reversed(self.known), len(self.known) - base))[::-1])
            except BaseException:
                self._clear()              # no numbers without ids
                raise
        return found

    def _learn(self, base: int, new: list) -> None:
        """Store the ids of the newest keys, numbered from ``base``."""
        flat, lens = self.encode(new)
        lens = np.asarray(lens, np.int64)
        n = len(new)
        while base + n > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        self.first[base:base + n] = self.used + np.cumsum(lens) - lens
        self.size[base:base + n] = lens
        self.used += len(flat)
        self.chars += sum(map(len, new))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(flat ids, lengths)`` of the numbered keys, in order."""
        lens = self.size[numbers].astype(np.int64)
        before = np.cumsum(lens) - lens
        at = np.arange(int(lens.sum()), dtype=np.int64) + np.repeat(self.first[numbers] - before, lens)
        return self.ids[at], lens


# --- words that a byte-level pattern never joins ------------------------------------------

#: A space that stands between white space, or ends the text after white space.
_ENTANGLED = regex.compile(r"\s (?:\s|\Z)")


def space_words(text: str) -> list[str] | None:
    """The text cut before every space, or None if white space around some space makes
    the pattern look further than a word.  A cut is safe where the pattern always starts
    a new match: before a space that follows a visible character, or that stands alone
    before one."""
    if " " not in text:
        return [text] if text else []
    if _ENTANGLED.search(text):
        return None
    head, *rest = text.split(" ")
    words = [" " + w for w in rest]
    return [head, *words] if head else words


def safe_at_spaces(text: str) -> bool:
    """Whether the text may be cut before every space (see :func:`space_words`)."""
    return _ENTANGLED.search(text) is None


# --- op5: token counts -----------------------------------------------------------------

class TokenCounter:
    """Token counts of texts for a byte-level ``tokenizer.json``."""

    def __init__(self, path: str, pattern: str, limit: int = 600_000):
        self.table, self.special = json_table(path)
        self.pattern = regex.compile(pattern)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, int] = {}
        self.limit, self.chars = limit, 0

    def _learn(self, words: list[str]) -> None:
        """Count the tokens of words: pre-tokenise, merge the distinct pre-tokens as one
        ragged batch, add up the symbols that survive."""
        # letters after at most one space are one pre-token; only other words need the pattern
        plain = {w for w in words if (w[0] == " " and w[1:].isalpha()) or w.isalpha()}
        pieces = {w: self.pattern.findall(w) for w in words if w not in plain}
        distinct = list(plain.union(*pieces.values()))
        lens = merge_pieces(self.table, [p.encode() for p in distinct])[1].tolist()
        size = dict(zip(distinct, lens))
        get = size.__getitem__
        self.known.update((w, size[w]) for w in plain)
        self.known.update((w, sum(map(get, ps))) for w, ps in pieces.items())
        self.chars += sum(map(len, words))

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.limit or self.chars > KEY_CHARS:
            self.known, self.chars = {}, 0
        parts, extra = [], []
        for text in texts:
            pieces, special = [text], 0
            if self.cut is not None and any(s in text for s in self.special):
                special = len(self.cut.findall(text))
                pieces = self.cut.split(text)
            words: list[str] = []
            for p in pieces:
                got = space_words(p)
                words += got if got is not None else self.pattern.findall(p)
            parts.append(words)
            extra.append(special)
        known = self.known
        new = {w for words in parts for w in words if w not in known}
        if new:
            self._learn(list(new))
        get = known.__getitem__
        return [sum(map(get, words)) + e for words, e in zip(parts, extra)]


_COUNTERS: dict[tuple, TokenCounter] = {}


def token_counts(docs: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of every row's whole text.

    ``tokenizer`` is the path of a byte-level ``tokenizer.json`` on every machine and
    ``pattern`` its pre-tokenising pattern.  No begin, end or padding tokens are added;
    an added special string inside a text is one token, as the library counts it.  A
    null or empty text has no bytes and no tokens; repeated and null ids are kept as
    they are; an empty table gives an empty result.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get((tokenizer, pattern))
        if counter is None:
            counter = _COUNTERS[(tokenizer, pattern)] = TokenCounter(tokenizer, pattern)
        for rows, data, offs in text_chunks(batches, "text"):
            n = counter.counts(chunk_texts(data, offs))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(offs)), pa.array(n, pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    picked = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
