"""Words of byte arrays, and their hashes, in numpy."""

from __future__ import annotations

import numpy as np

from riskflow.llm.common import mixed

#: Bytes hashed at once.
CHUNK = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
IN_WORD = ~ENDS
IN_WORD[[32, 9]] = False


class WordHash:
    """Polynomial hashes, modulo 2^64, of ranges of a byte array."""

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        self.table = draw.integers(0, 2**64, 256, dtype=np.uint64)
        self.step = int(draw.integers(0, 2**64, dtype=np.uint64)) | 1
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data):
            size = max(len(data), CHUNK + 4096)
            for name, base in (("up", self.step), ("down", pow(self.step, -1, 2**64))):
                factor = np.full(size, base, np.uint64)
                factor[0] = 1
                setattr(self, name, np.cumprod(factor))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=sums[1:])
        starts = np.minimum(starts, max(len(data) - 1, 0))
        return mixed((sums[ends] - sums[starts]) * self.down[starts]) if len(data) else np.zeros(len(starts), np.uint64)


def tokens(data: np.ndarray, offsets: np.ndarray, hasher: WordHash) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number, hash) of all words; the bytes are hashed in chunks that end between words."""
    inside = IN_WORD[data]
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = inside[1:] != inside[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    words = inside[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[words], ends[words]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    hashes, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, side="right")))
        low = starts[i]
        hashes[i:j] = hasher(data[low : ends[j - 1]], starts[i:j] - low, ends[i:j] - low)
        i = j
    return starts, ends, doc, hashes
