"""Bounded heaps of many slots at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

#: So many offered entries wait before they are merged into the heaps.
WAITING = 16_384
#: Below all scores.
LEAST = -(1 << 62)


class TopK:
    """The k best entries of each slot: higher scores first, equal ones by ascending id. Memory is bounded by slots times k."""

    def __init__(self, slots: int, k: int, least: int = LEAST):
        self.k = k
        #: Entries of a lower score can't enter a slot any more.
        self.floor = np.full(slots, least, np.int64)
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(slot):
            self.waiting.append((slot.astype(np.int64), score.astype(np.int64), ids.astype(np.int64)))
            self.n_waiting += len(slot)
            if self.n_waiting >= WAITING:
                self.settle()

    def settle(self) -> TopK:
        """Merges what waits. Then slot, score and id hold the entries in order."""
        if self.waiting:
            slot, score, ids = (np.concatenate(x) for x in zip((self.slot, self.score, self.id), *self.waiting, strict=True))
            self.waiting, self.n_waiting = [], 0
            order = np.lexsort((ids, -score, slot))
            rank = ranks(slot[order])
            order = order[rank < self.k]
            self.slot, self.score, self.id = slot[order], score[order], ids[order]
            full = ranks(self.slot) == self.k - 1
            self.floor[self.slot[full]] = np.maximum(self.floor[self.slot[full]], self.score[full])
        return self


def ranks(slot: np.ndarray) -> np.ndarray:
    """The place, from 0, of each entry within its slot; equal slots stand together."""
    if not len(slot):
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    return np.arange(len(slot)) - np.repeat(begins, np.diff(np.r_[begins, len(slot)]))
