"""Vectorised words and word shingles over UTF-8 bytes.

A word is a maximal run of ASCII letters and digits (ASCII lower-cased) and bytes of non-ASCII
characters; everything else separates. Words are hashed with a polynomial prefix sum modulo 2^64,
so no Python object is made per word.
"""

from __future__ import annotations

import numpy as np

from riskflow.llm.common import mixed

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted modulo 2^64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each maximal run of ``inside`` bytes within a row; ``offsets`` are the row borders."""
    n = len(inside)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte run."""
    up, down = _pow(len(data) + 1)
    acc = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=acc[1:])
    return mixed((acc[end] - acc[start]) * down[start])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start byte, end byte) of each word; ``offsets`` has n + 1 row borders in ``data``."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    start, end = spans(_WORD[data], offsets)
    return hashes(_LOWER[data], start, end), np.searchsorted(offsets, start, side="right") - 1, start, end


def shingles(h: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, index of the first word) of each run of ``k`` words in a row. A row of fewer words
    has one shingle of all its words; a row without words has none."""
    per = np.bincount(row, minlength=n_rows)
    base = np.concatenate([[0], np.cumsum(per)[:-1]])
    n = len(h)
    weight = [np.uint64(pow(0xD1342543DE82EF95, k - j, 1 << 64)) for j in range(k)]
    if n >= k:
        s = h[: n - k + 1] * weight[0]
        for j in range(1, k):
            s += h[j : n - k + 1 + j] * weight[j]
        ok = row[: n - k + 1] == row[k - 1 :]
        at = np.flatnonzero(ok)
        s, r = s[ok], row[at]
    else:
        s, at, r = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    short = np.flatnonzero((per > 0) & (per < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = per[short] > j
            extra[has] += h[base[short[has]] + j] * weight[j]
        s, r, at = np.concatenate([s, extra]), np.concatenate([r, short]), np.concatenate([at, base[short]])
    return mixed(s), r, at
