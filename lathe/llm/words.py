"""Words, hashes and shingles of a block of texts as numpy arrays.

Words are runs of bytes other than space and \\x09-\\x0D in the UTF-8 text,
which equals ``[^\\x20\\x09-\\x0D]+`` on the characters. All work is on arrays over
the Arrow buffer; no Python object is made per word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Separators for words of letters: every ASCII byte but A-Z and a-z.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[65:91] = NOT_LETTERS[97:123] = NOT_LETTERS[128:] = False
#: The lowest k bytes of a word of 8.
MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], U)
_M1, _M2, _M3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Longer words are hashed one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> U(30))) * _M2
    x = (x ^ (x >> U(27))) * _M3
    return x ^ (x >> U(31))


class Words:
    """``start``/``end`` byte positions in ``data``; ``off`` the first word of each text, and the total."""

    def __init__(self, texts: pa.Array, lower: bool = True, between: np.ndarray = _SPACE) -> None:
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        n = int(off[-1] - off[0])
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]] if n else np.zeros(0, np.uint8)
        off = off - off[0]
        self.data = np.zeros(n + 8, np.uint8)
        self.data[:n] = _LOWER[raw] if lower else raw
        solid = ~between[self.data[:n]]
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        before[off[:-1][off[:-1] < n]] = False
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        after[off[1:][off[1:] > 0] - 1] = False
        self.byte_off = off
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.off = np.searchsorted(self.start, off)
        self.view = np.ndarray((n + 1,), "<u8", self.data, strides=(1,))

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.off)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.off) - 1), self.count)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.view, self.data, self.start, self.end)


def hash_spans(view: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    length = end - start
    h = length.astype(U) * _M1
    h = mix(h ^ (view[start] & MASK[np.minimum(length, 8)])) if len(start) else h
    at = np.flatnonzero((length > 8) & (length <= _LONG))
    for k in range(8, _LONG, 8):
        at = at[length[at] > k]
        if not len(at):
            break
        h[at] = mix(h[at] * _M1 ^ (view[start[at] + k] & MASK[np.minimum(length[at] - k, 8)]))
    for i in np.flatnonzero(length > _LONG):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def join_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes."""
    n = len(h) - size + 1
    out = np.full(max(n, 0), size, U) * _M1
    for j in range(size):
        out = (out ^ h[j : j + n]) * _M2
        out ^= out >> U(29)
    return mix(out)


def ngrams(h: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram hashes inside each text, and the word at which each begins."""
    if len(h) < size:
        return np.zeros(0, U), np.zeros(0, np.int64)
    ok = np.zeros(len(h) + 1, np.int32)
    lo, hi = off[:-1], np.maximum(off[1:] - size + 1, off[:-1])
    np.add.at(ok, lo, 1)
    np.add.at(ok, hi, -1)
    at = np.flatnonzero(np.cumsum(ok[: len(h) - size + 1]) > 0)
    return join_hashes(h, size)[at], at


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles; a shorter text has one, of all its words."""
    h = words.hashes()
    joined = join_hashes(h, size) if len(h) >= size else np.zeros(0, U)
    out = []
    for a, b in zip(words.off[:-1].tolist(), words.off[1:].tolist(), strict=True):
        if b - a >= size:
            s = joined[a : b - size + 1].copy()
            s.sort()
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        else:
            out.append(join_hashes(h[a:b], b - a) if b > a else np.zeros(0, U))
    return out
