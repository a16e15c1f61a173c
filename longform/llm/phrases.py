"""Phrases of texts by rolling-hash triggers, as arrays."""

from __future__ import annotations

import numpy as np

from longform.llm.wordhash import U, _powers, _VALUES, mix

#: Bytes of the rolling hash, and the part of a window in which its trigger begins.
GRAM = 16
REACH = 64
LENGTH = 100
#: What every window of a trigger has in common: the bytes from the trigger on.
SHARED = LENGTH - REACH
#: Starts handled at a time; a longer text is cut, which only makes two phrases of one.
PIECE = 1 << 20
_LOW = U((1 << 24) - 1)


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    total = np.zeros(len(raw) + 1, U)
    np.cumsum(_VALUES[raw] * _powers(2 * PIECE + 4 * LENGTH)[0][: len(raw)], out=total[1:])
    return total


def hash_between(total: np.ndarray, start: np.ndarray, stop: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
    """64-bit hashes of the bytes from start to stop."""
    return mix((total[stop] - total[start]) * _powers(2 * PIECE + 4 * LENGTH)[1][start] + np.asarray(salt).astype(U), 3)


def triggers(raw: np.ndarray, valid: np.ndarray, total: np.ndarray) -> np.ndarray:
    """For each valid start of a window, its trigger: the leftmost smallest rolling hash that begins in its first REACH bytes."""
    n = len(raw) - GRAM + 1
    at = np.arange(n)
    value = (hash_between(total, at, at + GRAM) & ~_LOW) | at.astype(U)
    rows = -(-(n + REACH) // REACH)
    grid = np.full(rows * REACH, ~U(0))
    grid[:n] = value
    grid = grid.reshape(rows, REACH)
    left = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    right = np.minimum.accumulate(grid, 1).ravel()
    return (np.minimum(left[valid], right[valid + REACH - 1]) & _LOW).astype(np.int64)


def phrases(data: bytes):
    """All phrases of a text: (key, unit, trigger, first start, last start) as arrays.

    A phrase is a trigger with the run of windows that have it. ``key`` hashes what all windows
    of such a trigger share, ``unit`` the whole stretch that the run covers.
    """
    out = []
    for begin in range(0, max(len(data) - LENGTH + 1, 0), PIECE):
        raw = np.frombuffer(data[begin : begin + PIECE + LENGTH - 1], np.uint8)
        total = prefix_sums(raw)
        t = triggers(raw, np.arange(len(raw) - LENGTH + 1), total)
        first = np.flatnonzero(np.diff(t, prepend=-1))
        last = np.append(first[1:], len(t)) - 1
        t = t[first]
        key = hash_between(total, t, t + SHARED)
        unit = hash_between(total, first, last + LENGTH, (t - first) * 4096 + (last - first) + 1)
        out.append((key.view(np.int64), unit.view(np.int64), t + begin, first + begin, last + begin))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _stretches(data: bytes, first: np.ndarray, last: np.ndarray):
    """The bytes that the windows of some runs of starts cover, run by run, in buffers of about PIECE bytes.

    Yields (a, b, buffer's running sums, place in the buffer of the first start of each run from a to b).
    """
    sizes = last - first + LENGTH
    cut = np.searchsorted(np.cumsum(sizes), np.arange(PIECE, int(sizes.sum()) + PIECE, PIECE))
    bounds = np.unique(np.concatenate([[0], cut, [len(first)]]).clip(0, len(first)))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        raw = np.frombuffer(b"".join(data[f : f + s] for f, s in zip(first[a:b], sizes[a:b], strict=True)), np.uint8)
        yield a, b, prefix_sums(raw), np.cumsum(sizes[a:b]) - sizes[a:b]


def quarters(data: bytes, trigger: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Runs cut by how far their windows begin ahead of the trigger, each with a hash of what all its windows share.

    Yields (run, first start, last start, hash). A quarter of REACH leaves all but REACH / 4 bytes of a window shared.
    """
    step = REACH // 4
    for a, b, total, at in _stretches(data, first, last):
        for low in range(0, REACH, step):
            high = low + step - 1
            begin = np.maximum(first[a:b], trigger[a:b] - high)
            end = np.minimum(last[a:b], trigger[a:b] - low)
            some = np.flatnonzero(begin <= end)
            if not len(some):
                continue
            # shared by all windows that begin from high to low bytes ahead, whether or not this run has them all
            start = at[some] + trigger[a:b][some] - first[a:b][some] - low
            name = hash_between(total, start, start + LENGTH - step + 1, low + 1)
            yield some + a, begin[some], end[some], name.view(np.int64)


def window_hashes(data: bytes, first: np.ndarray, last: np.ndarray):
    """(run, start, hash) of every window that starts in one of some runs of starts."""
    for a, b, total, place in _stretches(data, first, last):
        n = last[a:b] - first[a:b] + 1
        run = np.repeat(np.arange(a, b), n)
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(place, n) + inside
        yield run, np.repeat(first[a:b], n) + inside, hash_between(total, at, at + LENGTH).view(np.int64)
