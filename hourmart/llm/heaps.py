"""Bounded best lists of many owners at once, kept in arrays."""

from __future__ import annotations

import numpy as np


class Heaps:
    """For each owner its ``k`` best entries: highest score first, equal scores by smaller id.

    Lists of parts of the data merge into that of the whole: an entry outside the best ``k`` of
    its part has ``k`` better ones in the whole, too.
    """

    def __init__(self, owners: int, k: int, lowest: float | int) -> None:
        self.k, self.lowest = k, lowest
        self.score = np.full((owners, k), lowest)
        self.ids = np.zeros((owners, k), np.int64)
        self.more = np.zeros((owners, k), np.int64)
        self.filled = np.zeros(owners, np.int64)

    def floor(self) -> np.ndarray:
        """The score that an entry of each owner must reach to enter."""
        return np.where(self.filled == self.k, self.score[:, -1], self.lowest)

    def add(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray, more: np.ndarray) -> None:
        """Offer entries; ``more`` is a number that an entry carries along."""
        if not len(owner):
            return
        touched = np.unique(owner)
        row, place = np.nonzero(np.arange(self.k) < self.filled[touched][:, None])
        row = touched[row]
        owner = np.concatenate([owner, row])
        score = np.concatenate([score, self.score[row, place]])
        ids = np.concatenate([ids, self.ids[row, place]])
        more = np.concatenate([more, self.more[row, place]])
        order = np.lexsort((ids, -score, owner))
        owner = owner[order]
        begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        sizes = np.diff(np.append(begins, len(owner)))
        place = np.arange(len(owner)) - np.repeat(begins, sizes)
        kept = place < self.k
        order, owner, place = order[kept], owner[kept], place[kept]
        self.score[owner, place] = score[order]
        self.ids[owner, place] = ids[order]
        self.more[owner, place] = more[order]
        self.filled[touched] = np.minimum(sizes, self.k)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owner, score, id and carried number of every entry."""
        owner, place = np.nonzero(np.arange(self.k) < self.filled[:, None])
        return owner, self.score[owner, place], self.ids[owner, place], self.more[owner, place]
