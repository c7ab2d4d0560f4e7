"""Vectorised views of whole texts: Arrow buffers, words and rolling hashes.

A text column of an Arrow batch already is one byte buffer with offsets, so
words, shingles and windows of all its rows are found with a few numpy passes
and no per-word Python. Work is cut into blocks of about ``BLOCK`` bytes; a
longer document makes a block of its own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

LONG_WORD = 64          # bytes of a word above which its hash is cryptographic
BLOCK = 2 << 20
SMALL_BLOCK = 1 << 19   # where the work arrays of a block take some dozen times its bytes
_X = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_XINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = {"n": 0}

# the separators of the contracts: space and 0x09-0x0D
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

# one random 64-bit value a byte; A-Z have the values of a-z in LOWER_VALUE
BYTE_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset:] \
        if offsets is not None and len(column) else np.zeros(1, np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return d, o


def blocks(offsets: np.ndarray, limit: int = BLOCK):
    """Row ranges (first, last + 1) whose texts are about ``limit`` bytes together."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (all bits depend on all bits)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 0 to n. Those of ordinary
    blocks are kept, as many as the largest block yet asked for; those of one
    huge document are made for it alone."""
    def make(m):
        up, down = np.full(m, _X, np.uint64), np.full(m, _XINV, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)
    if n > BLOCK + (1 << 16):
        return make(n + 1)
    if _POWERS["n"] < n + 1:
        _POWERS["n"] = max(n + 1, min(2 * n, BLOCK + 1))
        _POWERS["v"] = make(_POWERS["n"])
    up, down = _POWERS["v"]
    return up[: n + 1], down[: n + 1]


class Rolling:
    """Hashes of byte ranges of one block (equal ranges, equal hashes)."""

    def __init__(self, data: np.ndarray, value: np.ndarray = BYTE_VALUE):
        up, self.down = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(value[data] * up[:-1], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scrambled hash of data[start:end] for each pair of positions."""
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def grams(self, k: int) -> np.ndarray:
        """Scrambled hash of every k-byte range, by its start."""
        if len(self.sums) <= k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[: len(self.sums) - k])


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD):
    """(start, end, row) of the words of a block; offsets start at 0. A word
    never crosses a row border."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e
    w = is_word[data]
    begin = w.copy()
    begin[1:] &= ~w[:-1]
    stop = w.copy()
    stop[:-1] &= ~w[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begin[first] = w[first]
    stop[last] = w[last]
    s = np.flatnonzero(begin)
    return s, np.flatnonzero(stop) + 1, np.searchsorted(offsets, s, side="right") - 1


def shingles(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, by its first word (order matters)."""
    m = len(word_hash) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * _X + word_hash[i: i + m]
    return mix(h)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """The sorted distinct n-word shingle hashes of each row of a block
    (A-Z lower-cased). Fewer words than n: the whole sequence as one shingle;
    no word: empty."""
    s, e, row = words(data, offsets)
    h = Rolling(data, LOWER_VALUE).ranges(s, e)
    # a polynomial modulo 2**64 has equal values for some long strings that differ in a regular way
    for k in np.flatnonzero(e - s > LONG_WORD).tolist():
        word = data[s[k]:e[k]].tobytes().lower()
        h[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    all_sh = shingles(h, n)
    bound = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(all_sh[a: b - n + 1]))
        elif b > a:
            out.append(shingles(h[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
