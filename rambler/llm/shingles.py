"""Word shingles of texts as sets of 64-bit hashes, and their MinHash signatures, in numpy."""

from __future__ import annotations

import numpy as np

from rambler.llm.common import rehash_long

_rng = np.random.default_rng(1234)
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0xA0761D6478BD642F
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACE = np.uint64(0xE7037ED1A0B428DB)
# A-Z become a-z; space and U+0009 to U+000D separate words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0`` to ``base ** (n - 1)``, modulo 2 ** 64."""
    if len(_POWERS.get(base, ())) < n:
        out = np.full(max(n, 1 << 18), np.uint64(base))
        out[0] = 1
        _POWERS[base] = np.multiply.accumulate(out)
    return _POWERS[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The sorted distinct hashes of ``size`` consecutive words; of all words, if there are fewer; none without words."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(np.diff(_IS_WORD[data], prepend=False, append=False))
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return np.zeros(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE_VALUES[data] * powers(_BASE, len(data)))])
    words = (sums[ends] - sums[begins]) * powers(_UNBASE, len(data))[begins]
    rehash_long(words, data, begins, ends)
    words = mix(words + (ends - begins).astype(np.uint64))
    if len(words) < size:
        return mix((words * powers(int(_PLACE), len(words))).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(words)))
    n = len(words) - size + 1
    hashes = np.zeros(n, np.uint64)
    for k in range(size):
        hashes = hashes * _PLACE + words[k : k + n]
    return np.unique(mix(hashes))


class MinHash:
    """``n`` independent minima of a set: multiply-shift hashes of the (already mixed) members."""

    def __init__(self, n: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64)

    def __call__(self, members: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(members), 512):  # a piece stays in the processor's cache
            some = members[at : at + 512]
            np.minimum(out, (some[None, :] * self.a[:, None] + self.b[:, None]).min(1), out=out)
        return out
