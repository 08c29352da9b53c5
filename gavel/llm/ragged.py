"""Many short runs of ids in one flat array, looked up and joined as arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


def gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + length], one after the other."""
    total = int(length.sum())
    if not total:
        return flat[:0]
    ends = np.cumsum(length)
    return flat[np.repeat(start - (ends - length), length) + np.arange(total)]


class RunCache:
    """Runs of ids by key, kept between slices and tasks of a Python worker.

    `make` gives the runs of keys that are new. Beyond `most` keys, or `room`
    characters of keys and ids, the cache starts anew before the next slice,
    which bounds its memory and changes no result.
    """

    def __init__(self, make: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = 1_000_000, room: int = 1 << 25) -> None:
        self.make, self.most, self.room = make, most, room
        self.clear()

    def clear(self) -> None:
        self.row: dict = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.used = self.held = 0  # ids, and characters of keys
        self.start = np.empty(1 << 12, np.int64)
        self.length = np.empty(1 << 12, np.int32)

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        out = np.empty(max(need, 2 * len(array)), array.dtype)
        out[: len(array)] = array
        return out

    def rows(self, keys: Sequence) -> np.ndarray:
        """The row of every key; `start` and `length` describe the run of a row in `flat`."""
        if len(self.row) + len(keys) > self.most or self.used + self.held > self.room:
            self.clear()
        find = self.row
        new = [k for k in keys if k not in find]
        if new:
            new = list(dict.fromkeys(new))
            ids, sizes = self.make(new)
            n = len(find)
            self.start, self.length = self._room(self.start, n + len(new)), self._room(self.length, n + len(new))
            self.flat = self._room(self.flat, self.used + len(ids))
            self.flat[self.used : self.used + len(ids)] = ids
            self.length[n : n + len(new)] = sizes
            self.start[n : n + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.used += len(ids)
            self.held += sum(map(len, new))
            find.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(find.__getitem__, keys), np.int64, len(keys))

    def joined(self, rows: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.start[rows], self.length[rows])
