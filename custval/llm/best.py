"""The best few candidates of many groups at once, kept within a task."""

from __future__ import annotations

import numpy as np


class Best:
    """The ``k`` highest-scoring candidates of each group; ties by id, null ids last.

    ``least`` is the score that a candidate of a group needs: at first what
    the caller asks for, later that of the group's ``k``-th.
    """

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, np.array(least, np.int64)
        self.parts, self.size = [np.empty((4, 0), np.int64)], 0        # group, score, id is null, id

    def add(self, group: np.ndarray, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        self.parts.append(np.stack([group, score, null.astype(np.int64), ids]))
        self.size += len(group)
        if self.size > max(1 << 16, 4 * self.k * len(self.least)):
            self.cut()

    def cut(self) -> np.ndarray:
        """(group, score, id is null, id) of the candidates left, by group and rank."""
        rows = np.hstack(self.parts)
        group, score, null, ids = rows
        rows = rows[:, np.lexsort((ids, null, -score, group))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        last = rows[:, place == self.k - 1]
        self.least[last[0]] = np.maximum(last[1], self.least[last[0]])
        rows = rows[:, place < self.k]
        self.parts, self.size = [rows], rows.shape[1]
        return rows
