"""Per-worker memory of what distinct text units encode to, with vectorised lookup.

Tokenizers act on units (words) one at a time, and a corpus repeats its words.
Each batch is dictionary-encoded, only units unseen so far are encoded, and the
ids of all rows are gathered with numpy.  ``limit`` bounds the memory: beyond it
the pool starts again, which changes time, not results.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from panelcast.llm import common as C


class Pool:
    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 500_000):
        """``encode(units)`` gives (all ids in a row, number of ids of each unit)."""
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.index: dict = {}
        self.flat = np.zeros(1 << 12, np.int32)
        self.start, self.count, self.used = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def _put(self, units: list) -> None:
        ids, counts = self.encode(units)
        at, n = len(self.index), len(units)
        self.index.update(zip(units, range(at, at + n)))
        if at + n > len(self.start):
            more = np.zeros(at + n, np.int64)
            self.start, self.count = np.concatenate([self.start, more]), np.concatenate([self.count, more])
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(self.used + len(ids), np.int32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[at : at + n] = self.used + np.cumsum(counts) - counts
        self.count[at : at + n] = counts
        self.used += len(ids)

    def find(self, units: list) -> np.ndarray:
        """Places of the units (distinct in the list) in this pool."""
        if len(self.index) + len(units) > self.limit:
            self._clear()
        get = self.index.get
        found = np.fromiter((get(u, -1) for u in units), np.int64, len(units))
        new = np.flatnonzero(found < 0)
        if len(new):
            at = len(self.index)
            self._put([units[k] for k in new])
            found[new] = np.arange(at, at + len(new))
        return found

    def gather(self, places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units at ``places`` in a row, and the row offsets into them (``rows``: offsets into places)."""
        counts = self.count[places]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.flat[C.spread(self.start[places], counts)] if len(places) else self.flat[:0], ends[rows]
