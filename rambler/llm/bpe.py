"""Byte-level BPE with the ``tokenizers`` library, word by word and in numpy inside a Python task.

The tokenizer first cuts a text by a fixed pattern, and no merge crosses a cut, so the ids of a text
are those of its cut words in order.  Prose repeats its words: a worker encodes a word with the
library when it first meets it and keeps its ids under a 64-bit hash of its bytes (a digest, if it is
long: ``rehash_long``).  Cutting, hashing,
looking up and putting ids together run over all words of a batch at once.

Only texts made of characters that every version of Unicode classes alike are cut here; a text with
any other character, or with the string of an added token, goes to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from rambler.llm.common import rehash_long, worker_cache

_LETTER, _DIGIT, _SPACE, _BREAK, _OTHER = 1, 2, 3, 4, 5  # 0: goes to the library


def _byte_classes() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = _OTHER
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
    kinds[0x30:0x3A] = _DIGIT
    kinds[0x20] = _SPACE
    kinds[[0x09, 0x0A, 0x0D]] = _BREAK
    kinds[0x80:0xC0] = _LETTER      # continuation bytes
    kinds[0xC3:0xC9] = _LETTER      # U+00C0 to U+021F, but for the three checks below
    return kinds


_CLASSES = _byte_classes()
_rng = np.random.default_rng(20_24)
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class _Table:
    """A hash table from 64-bit hashes to entry numbers, with whole arrays looked up at once."""

    def __init__(self, bits: int):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.entries = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ hashes >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 where there is none."""
        slots = self._slots(hashes)
        found = self.entries[slots]
        left = np.flatnonzero((self.keys[slots] != hashes) & (found >= 0))
        while len(left):
            slots[left] = slots[left] + 1 & self.mask
            at = slots[left]
            found[left] = self.entries[at]
            left = left[(self.keys[at] != hashes[left]) & (found[left] >= 0)]
        return found

    def add(self, hashes: np.ndarray, entries: np.ndarray) -> None:
        """Distinct hashes that aren't in the table."""
        slots = self._slots(hashes)
        left = np.arange(len(hashes))
        while len(left):
            at = slots[left]
            free = self.entries[at] < 0
            self.entries[at[free]] = entries[left[free]]
            placed = self.entries[at] == entries[left]
            self.keys[at[placed]] = hashes[left[placed]]
            left = left[~placed]
            slots[left] = slots[left] + 1 & self.mask


class WordEncoder:
    """Encodes Arrow string columns without nulls, as the library does without special tokens,
    padding and truncation.  ``words_bits`` bounds the words that a worker keeps; a full table is
    begun anew."""

    def __init__(self, path: str, words_bits: int = 21):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.id_bytes[list(vocabulary.values())] = list(map(len, vocabulary))  # a character stands for a byte
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bits, self.most = words_bits, 1 << words_bits
        self._clear()

    def _clear(self, coming: int = 0) -> None:
        """Forget all words.  A text with more words than are kept gets a table of its size for the time."""
        self.table, self.n = _Table(max(self.bits, coming.bit_length()) + 1), 0
        self.begin, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, self.dtype), 0

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each text has."""
        found = [np.array(x.ids, self.dtype) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, self.dtype), *found]), np.array([len(x) for x in found], np.int64)

    def _encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_library``.  Words that begin with a space are encoded many in one text, which is cut
        before each of them again; the ids' byte lengths tell where words end."""
        spaced = [i for i, w in enumerate(words) if w[:1] == b" " and _CLASSES[w[-1]] == _LETTER and _CLASSES[w[1]] == _LETTER]
        other = sorted(set(range(len(words))).difference(spaced))
        joined = [b"".join(words[i] for i in spaced[a : a + 500]).decode() for a in range(0, len(spaced), 500)]
        ids, _ = self._library(joined)
        ends = np.searchsorted(np.cumsum(self.id_bytes[ids]), np.cumsum([len(words[i]) for i in spaced]), side="left") + 1
        more, counts = self._library([words[i].decode() for i in other])
        lengths = np.zeros(len(words), np.int64)
        lengths[spaced], lengths[other] = np.diff(ends, prepend=0), counts
        order = np.argsort(np.array(spaced + other, np.int64))
        begins = np.concatenate([ends - np.diff(ends, prepend=0), len(ids) + np.cumsum(counts) - counts]).astype(np.int64)[order]
        return _gather(np.concatenate([ids, more]), begins, lengths), lengths

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids, lengths = self._encode_words(words)
        while len(self.pool) < self.used + len(ids):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.begin) < self.n + len(words):
            self.begin, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.length))
        self.pool[self.used : self.used + len(ids)] = ids
        new = slice(self.n, self.n + len(words))
        self.begin[new], self.length[new] = self.used + np.cumsum(lengths) - lengths, lengths
        self.table.add(hashes, np.arange(self.n, self.n + len(words), dtype=np.int32))
        self.n, self.used = self.n + len(words), self.used + len(ids)

    def encode(self, column: pa.Array, counts_only: bool = False) -> tuple[np.ndarray | None, np.ndarray]:
        """The ids of all texts in order (None if only counted), and how many each text has."""
        column = column.cast(pa.large_string())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        ids, counts, a = [], [], 0
        while a < len(column):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _SLICE, side="right")) - 1)
            some, n = self._slice(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], counts_only)
            ids.append(some)
            counts.append(n)
            a = b
        return (None if counts_only else np.concatenate([np.zeros(0, self.dtype), *ids])), np.concatenate([np.zeros(0, np.int64), *counts])

    def _slice(self, data: np.ndarray, offsets: np.ndarray, counts_only: bool) -> tuple[np.ndarray | None, np.ndarray]:
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(len(offsets) - 1, np.int64)
        starts, unusual = self._cut(data, offsets)
        begins = np.flatnonzero(starts)
        ends = np.append(begins[1:], len(data))
        first_word = np.searchsorted(begins, offsets)  # of each text
        values = np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, len(data)))
        hashes = (values[ends - 1] - np.where(begins > 0, values[begins - 1], np.uint64(0))) * _powers(_UNBASE, len(data))[begins]
        rehash_long(hashes, data, begins, ends)
        alone = first_word[:-1][unusual]  # of the texts that are one word here, for the library
        entries = self.table.find(hashes)
        entries[alone] = 0
        missing = np.flatnonzero(entries < 0)
        if len(missing):
            new, at = np.unique(hashes[missing], return_index=True)
            if self.n + len(new) > self.most:
                usual = np.ones(len(hashes), bool)
                usual[alone] = False
                missing = np.flatnonzero(usual)
                new, at = np.unique(hashes[missing], return_index=True)
                self._clear(len(new))
            whole, at = data.tobytes(), missing[at]
            self._learn(new, [whole[x:y] for x, y in zip(begins[at].tolist(), ends[at].tolist())])
            entries[missing] = self.table.find(hashes[missing])
        lengths = self.length[entries]
        if len(alone):
            whole = data.tobytes()
            other, lengths[alone] = self._library([whole[begins[i] : ends[i]].decode() for i in alone])
        word_ends = np.append(0, np.cumsum(lengths))
        counts = word_ends[first_word[1:]] - word_ends[first_word[:-1]]
        if counts_only:
            return None, counts
        sources = self.begin[entries]
        sources[alone] = 0
        pool = self.pool
        if len(alone):  # their ids stand before those of the table
            pool, sources = np.concatenate([other, self.pool[: self.used]]), sources + len(other)
            sources[alone] = np.cumsum(lengths[alone]) - lengths[alone]
        return _gather(pool, sources, lengths), counts

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words start, and the texts (numbers) that are left whole."""
        n = len(data)
        kinds = _CLASSES[data]
        nothing = np.zeros(1, np.uint8)
        before, after = np.concatenate([nothing, kinds[:-1]]), np.concatenate([kinds[1:], nothing])
        following = np.concatenate([data[1:], nothing])
        # the multiplication and division signs, and what comes after U+021F
        bad = (kinds == 0) | (data == 0xC3) & ((following == 0x97) | (following == 0xB7)) | (data == 0xC8) & (following > 0x9F)
        filled = np.flatnonzero(offsets[1:] > offsets[:-1])
        head, last = offsets[filled], offsets[filled + 1] - 1
        before[head], after[last] = 0, 0
        gap = (kinds == _SPACE) | (kinds == _BREAK)
        gap_before = (before == _SPACE) | (before == _BREAK)
        word_after = (after != 0) & (after != _SPACE) & (after != _BREAK)
        starts = np.where(gap, ~gap_before | word_after, (kinds != before) & (before != _SPACE))
        starts[head] = True
        for i in np.flatnonzero((data == 0x27) & (before != _OTHER) & (before != _SPACE) & (after == _LETTER)):
            size = 2 if following[i] in b"stmd" else 3 if data[i + 1 : i + 3].tobytes() in (b"re", b"ve", b"ll") else 0
            if size and (size == 2 or after[i + 1] == _LETTER):  # an English contraction
                starts[i + 1 : i + size] = False
                if i + size < n and kinds[i + size] == _LETTER:
                    starts[i + size] = True
        unusual = set(np.searchsorted(offsets, np.flatnonzero(bad), side="right").tolist())
        whole = data.tobytes()
        for token in self.added:
            at = whole.find(token)
            while at >= 0:
                unusual.add(int(np.searchsorted(offsets, at, side="right")))
                at = whole.find(token, at + 1)
        unusual = np.array(sorted(unusual), np.int64) - 1
        for t in unusual:
            starts[offsets[t] + 1 : offsets[t + 1]] = False
        return starts, unusual


def _gather(pool: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs ``pool[begin : begin + length]`` one after the other."""
    ends = np.cumsum(lengths)
    return pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - lengths), lengths)]


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker for ``path``; later tasks of the worker use its words again."""
    cache, key = worker_cache(), f"words {path}"
    if key not in cache:
        cache[key] = WordEncoder(path)
    return cache[key]
