"""Token ids by the tokenizers library, remembered word by word.

A tokenizer never joins across certain spaces, so a text's ids are its words' ids one
after the other.  A worker keeps the ids of words it has met and asks the library only
for new ones; texts for which a cut would not be safe go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from rasterprep.llm.common import ascii_lower
from rasterprep.llm.merges import RaggedCache, byte_alphabet, safe_at_spaces

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


#: Words that a worker remembers, about 300 bytes each.
REMEMBERED = 1_200_000
#: New words that the library is asked for as one text.
JOINED = 64
#: A space beside other white space: some word between spaces is empty or begins or ends with it.
_SPACED = regex.compile(r" \s|\s ")


def byte_sizes(tokenizer) -> np.ndarray | None:
    """Bytes of every id of a byte-level tokenizer, without the mark of a word's end; None for one of
    another kind."""
    alphabet, vocab = byte_alphabet(), tokenizer.get_vocab()
    mark = getattr(tokenizer.model, "end_of_word_suffix", None) or ""
    if not vocab or not all(c in vocab for c in alphabet):
        return None
    sizes = np.zeros(max(vocab.values()) + 1, np.int64)
    for token, i in vocab.items():
        sizes[i] = len(token.removesuffix(mark)) or len(token)
    return sizes


def is_normal(word: str) -> bool:
    """Whether composing (NFC) and lower-casing leave the word as it is."""
    return unicodedata.is_normalized("NFC", word) and word.lower() == word


class LibraryEncoder:
    """Ids of whole texts by a ``tokenizer.json``, without added special tokens.

    ``blank_free`` says that the tokenizer drops white space (its words are cut at every
    space and line feed); otherwise words keep the space before them, and the cache knows them
    by their letters after it (a first word without one after a space).
    """

    def __init__(self, path: str, blank_free: bool, limit: int = REMEMBERED):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blank_free = blank_free
        self.sizes = byte_sizes(self.tokenizer)
        self.cache = RaggedCache(self._ask, limit)

    def _ask(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, lens = [], []
        for lo in range(0, len(keys), 8192):
            joined = self._ask_spaced if self.blank_free else self._ask_joined
            got = joined(keys[lo:lo + 8192]) or self._ask_each(keys[lo:lo + 8192])
            ids.append(got[0]), lens.append(got[1])
        return np.concatenate(ids), np.concatenate(lens)

    def _ask_each(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = keys if self.blank_free else [k[1:] if k[:1] == " " else " " + k for k in keys]
        ids: list[int] = []
        ends = []
        for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False):
            ids += e.ids
            ends.append(len(ids))
        return np.array(ids, np.int32), np.diff(np.array(ends, np.int64), prepend=0)

    def _ask_spaced(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for a tokenizer that drops white space: visible words that keep their bytes whatever
        it normalises are asked for ``JOINED`` at a time with spaces between; the others one by one.
        None if the bytes of the ids do not end where the words do."""
        if self.sizes is None:
            return None
        plain = np.array([k.isprintable() and "<|" not in k and (k.isascii() or is_normal(k)) for k in keys], bool)
        words = [k for k, p in zip(keys, plain.tolist()) if p]
        if not words or any(s in " ".join(words) for s in self.special):
            return None
        ids: list[int] = []
        for e in self.tokenizer.encode_batch_fast(
                [" ".join(words[lo:lo + JOINED]) for lo in range(0, len(words), JOINED)], add_special_tokens=False):
            ids += e.ids
        flat = np.array(ids, np.int32)
        ends = np.cumsum(self.sizes[flat])
        last = np.cumsum(pc.binary_length(pa.array(words, pa.large_string())).to_numpy(zero_copy_only=False).astype(np.int64))
        at = np.searchsorted(ends, last)
        if not len(ends) or ends[-1] != last[-1] or (ends[at] != last).any():
            return None
        if len(words) == len(keys):
            return flat, np.diff(at + 1, prepend=0)
        other, other_lens = self._ask_each([k for k, p in zip(keys, plain.tolist()) if not p])
        lens = np.empty(len(keys), np.int64)
        lens[plain], lens[~plain] = np.diff(at + 1, prepend=0), other_lens
        mixed, of_plain = np.empty(int(lens.sum()), np.int32), np.repeat(plain, lens)
        mixed[of_plain], mixed[~of_plain] = flat, other
        return mixed, lens

    def _ask_joined(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for words that are asked for some ``JOINED`` at a time: one text costs less than
        its words one by one.  Words that begin with a space and are visible at both ends are cut
        there again by the tokenizer, and the bytes of the ids tell where; None if they do not."""
        if self.sizes is None:
            return None
        texts = []
        for lo in range(0, len(keys), JOINED):
            run = keys[lo:lo + JOINED]
            joined = " " + " ".join(run)
            if not _SPACED.search(joined + " "):
                texts.append(joined)
                continue
            visible: list[str] = []
            for k in run:
                if k and not (k[0].isspace() or k[-1].isspace()):
                    visible.append(k)
                    continue
                if visible:
                    texts.append(" " + " ".join(visible))
                    visible = []
                texts.append(k[1:] if k[:1] == " " else " " + k)
            if visible:
                texts.append(" " + " ".join(visible))
        if any(s in t for s in self.special if " " in s for t in texts):
            return None                    # a special string might arise from several words
        ids: list[int] = []
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids += e.ids
        flat = np.array(ids, np.int32)
        ends = np.cumsum(self.sizes[flat])
        # a word has a space more than its key, the first of a text one less
        held = pa.array(keys, pa.large_string())
        first = pc.starts_with(held, " ").to_numpy(zero_copy_only=False)
        last = np.cumsum(pc.binary_length(held).to_numpy(zero_copy_only=False) + np.where(first, -1, 1))
        at = np.searchsorted(ends, last)
        if not len(ends) or ends[-1] != last[-1] or (ends[at] != last).any():
            return None
        return flat, np.diff(at + 1, prepend=0)

    def _cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, list[int]]:
        """``(distinct keys, the key of every word, words per text, texts to be asked for whole)``, without
        a Python string for every word: Arrow cuts the texts at their spaces."""
        if self.blank_free:
            words, ends = split_at_spaces([t.replace("\n", " ") for t in texts])
            filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
            before = np.concatenate([[0], np.cumsum(filled)])[ends]
            return (*distinct_words(words.filter(pa.array(filled))), np.diff(before), [])
        heads, rests, headed, whole = [], [], np.zeros(len(texts), bool), []
        counts = np.zeros(len(texts), np.int64)
        spaced = []
        for i, text in enumerate(texts):
            if not safe_at_spaces(text) or any(s in text for s in self.special):
                whole.append(i)
                continue
            head, space, rest = text.partition(" ")
            if head:                       # the only word without a space before it
                heads.append(" " + head)
                headed[i] = True
            if space:
                rests.append(rest)
                spaced.append(i)
        words, ends = split_at_spaces(rests)
        counts[spaced] = np.diff(ends)
        keys, at = distinct_words(words)
        before = (np.cumsum(counts) - counts)[headed]
        return keys + heads, np.insert(at, before, np.arange(len(keys), len(keys) + len(heads))), counts + headed, whole

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(flat ids, ids per text)``."""
        keys, at, counts, whole = self._cut(texts)
        # the cache is asked once for each distinct word
        ids, lens = self.cache.gather(self.cache.numbers(keys)[at])
        ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(counts)])]
        per_text = np.diff(ends)
        if not whole:
            return ids, per_text
        parts = np.split(ids, ends[1:-1])
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.int32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def split_at_spaces(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """``(the parts of all texts, where each text's parts begin and end)``, as ``str.split(" ")``."""
    parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    return parts.values, parts.offsets.to_numpy(zero_copy_only=False).astype(np.int64)


def distinct_words(words: pa.Array) -> tuple[list[str], np.ndarray]:
    """``(the distinct words, the place of every word in them)``."""
    distinct = words.dictionary_encode()
    return distinct.dictionary.to_numpy(zero_copy_only=False).tolist(), distinct.indices.to_numpy(zero_copy_only=False)


def lower_where_safe(data: np.ndarray) -> np.ndarray:
    """The UTF-8 bytes with A-Z in lower case, for a tokenizer that composes (NFC) and then
    lower-cases: fewer distinct words.  Bytes with a combining mark (some compose with a
    small letter only) or a ``<|`` (a special string might arise) are returned as they are."""
    marks = (data == 0xCC) | (data == 0xCD)
    if marks.any() or ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any():
        return data
    return ascii_lower(data)


_ENCODERS: dict[tuple, LibraryEncoder] = {}


def encoder(path: str, blank_free: bool, limit: int = REMEMBERED) -> LibraryEncoder:
    """The worker's encoder of a file, loaded once."""
    key = (path, blank_free, limit)
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryEncoder(path, blank_free, limit)
    return _ENCODERS[key]


def forget_encoders() -> None:
    """Free the worker's encoders with all words that they remember."""
    _ENCODERS.clear()
