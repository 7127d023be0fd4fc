"""Suffix arrays of numbered words, by prefix doubling over the suffixes that are still tied."""

import numpy as np


class Suffixes:
    """Suffixes of a sequence of symbols from 1 on (0 marks an end), ordered by their first ``depth`` symbols or more.

    ``order`` lists the places of the suffixes, ``rank`` the slot in ``order`` at which the suffixes tied with a place begin.
    With ``keep`` the ranks of all rounds are kept, so that common lengths can be looked up.
    """

    def __init__(self, symbols: np.ndarray, depth: int, keep: bool = False):
        self.symbols, n = symbols.astype(np.int64), len(symbols)
        bits = max(1, int(self.symbols.max()).bit_length()) if n else 1
        self.width = max(1, 62 // bits)
        padded = np.concatenate([self.symbols, np.zeros(self.width, dtype=np.int64)])
        key = np.zeros(n, dtype=np.int64)
        for k in range(self.width):
            key = key << bits | padded[k : k + n]
        self.order = np.argsort(key)
        sorted_key = key[self.order]
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        slot = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        self.rank = np.empty(n, dtype=np.int64)
        self.rank[self.order] = slot
        self.levels: list[tuple[int, np.ndarray]] = []
        reach, tied = self.width, self._tied(fresh, np.arange(n))
        while True:
            if keep:
                self.levels.append((reach, self.rank.copy()))
            if reach >= depth or not len(tied):
                break
            at = self.order[tied]
            after = np.minimum(at + reach, n)
            key = self.rank[at] << 32 | np.append(self.rank + 1, 0)[after]
            sorting = np.argsort(key)
            at, key = at[sorting], key[sorting]
            self.order[tied] = at
            fresh = np.ones(len(tied), dtype=bool)
            fresh[1:] = key[1:] != key[:-1]
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(tied)), 0))
            self.rank[at] = tied[begin]
            tied = self._tied(fresh, tied)
            reach *= 2

    @staticmethod
    def _tied(fresh: np.ndarray, slots: np.ndarray) -> np.ndarray:
        alone = fresh & np.append(fresh[1:], True)
        return slots[~alone]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common start of the suffixes at the places ``a`` and ``b``, from the kept ranks."""
        n, length = len(self.symbols), np.zeros(len(a), dtype=np.int64)
        one = (1, self.symbols)
        for reach, rank in [*reversed(self.levels), *[one] * (self.width - 1)]:
            x, y = a + length, b + length
            inside = (x < n) & (y < n)
            same = np.zeros(len(a), dtype=bool)
            same[inside] = rank[x[inside]] == rank[y[inside]]
            length += reach * same
        return length

    def _differ(self, slots: np.ndarray, asked: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 where the suffixes in the slots are below, start with, or are above the asked sequences."""
        place, out, n = self.order[slots], np.zeros(len(slots), dtype=np.int8), len(self.symbols)
        left, k = np.flatnonzero(size > 0), 0
        while len(left):
            at = place[left] + k
            own = np.where(at < n, self.symbols[np.minimum(at, n - 1)], 0)
            other = asked[begin[left] + k]
            out[left] = np.sign(own - other)
            k += 1
            left = left[(own == other) & (size[left] > k)]
        return out

    def find(self, asked: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots (from, to) of the suffixes that start with each asked sequence; binary searches, side by side.

        A sequence is ``size`` symbols of ``asked`` from ``begin`` on. None found: both are the slot it would have.
        """
        return self._bound(asked, begin, size, 0), self._bound(asked, begin, size, 1)

    def _bound(self, asked: np.ndarray, begin: np.ndarray, size: np.ndarray, beyond: int) -> np.ndarray:
        low = np.zeros(len(begin), dtype=np.int64)
        high = np.full(len(begin), len(self.symbols), dtype=np.int64)
        while len(left := np.flatnonzero(low < high)):
            middle = (low[left] + high[left]) // 2
            below = self._differ(middle, asked, begin[left], size[left]) < beyond
            low[left[below]] = middle[below] + 1
            high[left[~below]] = middle[~below]
        return low

    def longest(self, asked: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length of the longest start of each asked sequence that occurs, and a place where it does (the smallest of two)."""
        slot, n = self._bound(asked, begin, size, 0), len(self.symbols)
        best, where = np.zeros(len(begin), dtype=np.int64), np.full(len(begin), -1, dtype=np.int64)
        for side in (slot - 1, slot):
            valid = np.flatnonzero((side >= 0) & (side < n))
            place, length = self.order[side[valid]], np.zeros(len(valid), dtype=np.int64)
            left = np.flatnonzero(size[valid] > 0)
            while len(left):
                at = place[left] + length[left]
                own = np.where(at < n, self.symbols[np.minimum(at, n - 1)], 0)
                same = own == asked[begin[valid[left]] + length[left]]
                left = left[same]
                length[left] += 1
                left = left[length[left] < size[valid[left]]]
            better = (length > best[valid]) | ((length == best[valid]) & (length > 0) & (place < where[valid]))
            best[valid[better]], where[valid[better]] = length[better], place[better]
        return best, where
