"""Longest common extensions of a sequence of numbers, from sampled suffixes only.

Places whose remainder lies in a difference cover are sampled. Any two places
are, after fewer than PERIOD steps, both at a sample, so a query compares that
few numbers and then asks the sorted samples: the least common prefix between
two of them, by a sparse table of minima.
"""

from __future__ import annotations

import numpy as np

#: A perfect difference set; each remainder is the difference of two of them.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)


def shifts() -> np.ndarray:
    """Steps after which two places, by their remainders, are both at a sample."""
    sampled = np.isin(np.arange(PERIOD), COVER)
    steps = np.arange(PERIOD)
    both = sampled[(steps[:, None, None] + steps[:, None]) % PERIOD] & sampled[(steps[:, None, None] + steps) % PERIOD]
    if not both.any(axis=0).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=0)


SHIFTS = shifts()


class Extensions:
    """``query(i, j)``: how many numbers from place i on equal those from place j on.

    ``numbers`` are at least 0 and below 2**32 - 1. Memory is linear in their
    count, times the logarithm of the longest repeat for the sampled places.
    """

    def __init__(self, numbers: np.ndarray):
        self.size = len(numbers)
        self.numbers = np.concatenate([numbers + 1, np.zeros(PERIOD, np.int64)]).astype(np.uint32)  # 0: past the end
        places = np.arange(self.size)
        places = places[np.isin(places % PERIOD, COVER)]
        self.rank = np.full(self.size + PERIOD, -1)
        levels = self._sort(places)
        self.table = [self._neighbours(places, levels)]
        while (half := 1 << (len(self.table) - 1)) < len(self.table[0]):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]) if len(last) > half else last[:0])

    def _sort(self, places: np.ndarray) -> list[np.ndarray]:
        """Sets ``rank``; returns ranks by the first PERIOD << level numbers, 0 past the end."""
        windows = np.lib.stride_tricks.sliding_window_view(self.numbers, PERIOD)[places].astype(">u4")
        levels, step = [np.zeros(self.size + PERIOD, np.int64)], PERIOD
        distinct, own = np.unique(np.ascontiguousarray(windows).view(f"V{4 * PERIOD}").ravel(), return_inverse=True)
        levels[0][places] = own + 1
        while len(distinct) < len(places):
            after = np.minimum(places + step, self.size)  # a sample too, as its remainder is the same
            distinct, own = np.unique(levels[-1][places] * (len(places) + 1) + levels[-1][after], return_inverse=True)
            levels.append(np.zeros(self.size + PERIOD, np.int64))
            levels[-1][places] = own + 1
            step *= 2
        self.rank[places] = own
        return levels

    def _neighbours(self, places: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of each sample and the next one in order."""
        order = np.empty_like(places)
        order[self.rank[places]] = places
        a, b = order[:-1].copy(), order[1:].copy()
        for level in range(len(levels) - 1, -1, -1):
            held = levels[level][np.minimum(a, self.size)]
            same = (held > 0) & (held == levels[level][np.minimum(b, self.size)])
            a, b = a + same * (PERIOD << level), b + same * (PERIOD << level)
        steps = self._compare(a, b, np.full(len(a), PERIOD))
        return a + steps - order[:-1]

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal numbers from ``a`` and ``b`` on, ``most`` at most (none beyond the end)."""
        out = np.zeros(len(a), dtype=np.int64)
        on = np.flatnonzero((most > 0) & (np.maximum(a, b) < self.size))
        while len(on):
            at_a, at_b = a[on] + out[on], b[on] + out[on]
            same = self.numbers[at_a] == self.numbers[at_b]
            out[on] += same
            on = on[same & (out[on] < most[on])]
        return out

    def query(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For places i and j that differ; a place at the end has extension 0."""
        shift = SHIFTS[i % PERIOD, j % PERIOD]
        out = self._compare(i, j, shift)
        on = np.flatnonzero((out == shift) & (np.maximum(i, j) + shift < self.size))
        one, two = self.rank[i[on] + shift[on]], self.rank[j[on] + shift[on]]
        low, high = np.minimum(one, two), np.maximum(one, two)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level).tolist():
            of = level == k
            least = np.minimum(self.table[k][low[of]], self.table[k][high[of] - (1 << k)])
            out[on[of]] += least
        return out
