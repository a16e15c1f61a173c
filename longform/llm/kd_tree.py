"""K-d trees over letter-count vectors, and range searches by the letters that may be gained and lost.

A node splits its words at a count of one letter, the letter and count that part them most evenly. A search
carries how many letters a match may have more (``up``) and fewer (``down``) than the query. On the side of a split where the
query does not lie, every word differs from it in that letter by at least the distance to the cut, so that
much of the budget is spent; a box whose budget is overdrawn is pruned. Budgets are 0 or 1: a letter on which one unit is
spent cannot be charged again within it, so the sums are exact L1 distances to the boxes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Letters of the words: a-z, and U+00C0 to U+00FF; as Latin-1 bytes.
LETTERS = (*range(97, 123), *range(0xC0, 0x100))
_COLUMN = np.zeros(256, np.int64)
_COLUMN[list(LETTERS)] = np.arange(len(LETTERS))
#: Counts above this are equal: no distance grows by that.
MOST = 255
#: Letters fold into so many groups of three bits for ``outlines``.
GROUPS = 42


def vectors(words: list[bytes]) -> np.ndarray:
    """One row of letter counts for each word (Latin-1 bytes)."""
    rows = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    cells = rows * len(LETTERS) + _COLUMN[np.frombuffer(b"".join(words), np.uint8)]
    counts = np.bincount(cells, minlength=len(words) * len(LETTERS))
    return np.minimum(counts, MOST).astype(np.uint8).reshape(len(words), len(LETTERS))


def outlines(counts: np.ndarray) -> np.ndarray:
    """Two 63-bit rows for each vector: of each group of letters, one bit for a count of at least 1, 2 and 3.

    Vectors at an L1 distance of d differ in at most d of these bits.
    """
    grouped = np.zeros((len(counts), GROUPS), np.int64)
    for letter in range(counts.shape[1]):
        grouped[:, letter % GROUPS] += counts[:, letter]
    out = np.zeros((len(counts), 2), np.uint64)
    for group in range(GROUPS):
        for k in range(3):
            out[:, group // 21] |= (grouped[:, group] > k).astype(np.uint64) << np.uint64(group % 21 * 3 + k)
    return out


def _best_cut(counts: np.ndarray) -> tuple[int, int, int]:
    """(words on the smaller side, letter, count): the split ``<= count`` that is most even."""
    best, cut = (0, 0, 0), 0
    while True:
        below = (counts <= cut).sum(0)
        if below.min() == len(counts):
            return best
        even = np.minimum(below, len(counts) - below)
        letter = int(even.argmax())
        best = max(best, (int(even[letter]), letter, cut), key=lambda b: b[0])
        cut += 1


class KdTree:
    """``cells[k]``: the rows in leaf k. ``nodes[i]``: (letter, cut, left, right); a child below zero is the leaf -1 - child."""

    def __init__(self, counts: np.ndarray, leaf: int):
        self.nodes: list[list[int]] = []
        self.cells: list[np.ndarray] = []
        self.root = 0
        todo = [(np.arange(len(counts)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            size, letter, cut = _best_cut(counts[rows]) if len(rows) > leaf else (0, 0, 0)
            if size:
                child = len(self.nodes)
                self.nodes.append([letter, cut, 0, 0])
                low = counts[rows, letter] <= cut
                todo += [(rows[low], child, 2), (rows[~low], child, 3)]
            else:
                child = -1 - len(self.cells)
                self.cells.append(rows)
            if parent < 0:
                self.root = child
            else:
                self.nodes[parent][side] = child

    def reach(self, counts: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``counts`` whose matches may lie in it), for matches that have up to ``up`` letters more and ``down`` fewer."""
        n = len(counts)
        todo = [(self.root, np.arange(n), np.full(n, up, np.int16), np.full(n, down, np.int16))]
        while todo:
            at, rows, more, fewer = todo.pop()
            if not len(rows):
                continue
            if at < 0:
                yield -1 - at, rows
                continue
            letter, cut, low, high = self.nodes[at]
            over = counts[rows, letter].astype(np.int16) - cut
            left = np.flatnonzero(np.maximum(over, 0) <= fewer)
            right = np.flatnonzero(np.maximum(1 - over, 0) <= more)
            todo.append((low, rows[left], more[left], fewer[left] - np.maximum(over[left], 0)))
            todo.append((high, rows[right], more[right] - np.maximum(1 - over[right], 0), fewer[right]))
