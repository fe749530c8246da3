"""Word shingles of texts as sorted sets of 64-bit hashes, by array operations."""

from __future__ import annotations

import numpy as np

WORDS = 5  # words to a shingle
SLICE = 1 << 20  # bytes hashed at a time
BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: ASCII white space, punctuation and control characters part words; other bytes belong to them.
PARTS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads each bit over all (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, count: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(count, base, np.uint64)]))


def word_hashes(data: bytes) -> np.ndarray:
    """Hash of each word of ``data``, which has been translated by ``PARTS``."""
    out, start = [], 0
    while start < len(data):
        end = data.find(b" ", start + SLICE)
        end = len(data) if end < 0 else end + 1
        own = np.frombuffer(data, np.uint8, end - start, start)
        inside = np.concatenate([[False], own != 0x20, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[::2], edges[1::2]
        # sum of byte * BASE**-place up to each place; a word is a difference, moved back to place 0
        sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate((own + np.uint64(1)) * powers(INVERSE, len(own))[:-1])])
        out.append(mixed((sums[last] - sums[first]) * powers(BASE, len(own))[last]))
        start = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Words are maximal runs without ASCII white space or punctuation, in lower case.
    A text of fewer than ``WORDS`` words has one shingle of them all; one without
    words has none.
    """
    data = [t.lower().encode("utf-8", "surrogatepass").translate(PARTS) for t in texts]
    hashes = word_hashes(b" ".join(data))
    ends = np.cumsum([len(d.split()) for d in data])
    out, start = [], 0
    for end in ends.tolist():
        own, start = hashes[start:end], end
        if len(own) >= WORDS:
            sums = np.zeros(len(own) - WORDS + 1, np.uint64)
            for k in range(WORDS):
                sums = mixed(sums + own[k : k + len(sums)])
            own = np.unique(sums)
        elif len(own):
            sums = np.zeros(1, np.uint64)
            for k in range(len(own)):
                sums = mixed(sums + own[k])
            own = sums
        out.append(own)
    return out
