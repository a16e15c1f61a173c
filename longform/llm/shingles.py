"""Five-word shingles of whole texts as sorted arrays of distinct 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import numpy as np

from longform.llm.wordhash import U, groups, mix, split_words, utf8

WIDTH = 5
_STEP = 0xD6E8FEB86659FD93
#: Signatures are computed over so many hashes at a time, to stay in the processor's cache.
CHUNK = 1 << 15


def shingle_sets(texts: list) -> list[np.ndarray]:
    """Distinct shingles of each text: runs of five words with A-Z in lower case, the whole text if it has fewer, none without words."""
    out: list[np.ndarray] = []
    weight = [U(pow(_STEP, k, 2**64)) for k in range(WIDTH)]
    data = [utf8(t) for t in texts]
    for part in groups(data):
        words = split_words(data[part], lower=True)
        w, first = words.hashes, words.first
        n = max(len(w) - WIDTH + 1, 0)
        runs = sum((w[k : k + n] * weight[k] for k in range(WIDTH)), np.zeros(n, U))
        runs = mix(runs, WIDTH)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= WIDTH:
                out.append(np.unique(runs[a : b - WIDTH + 1]))
            elif b > a:
                out.append(mix(sum((w[a + k : a + k + 1] * weight[k] for k in range(b - a)), np.zeros(1, U)), b - a))
            else:
                out.append(np.zeros(0, U))
    return out


def hash_family(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of k hash functions."""
    seeds = np.arange(k, dtype=U)
    return mix(seeds, 101) | U(1), mix(seeds, 202)


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """One row of k 32-bit minima per set; sets must not be empty."""
    out = np.zeros((len(sets), k), np.uint32)
    factor, offset = hash_family(k)
    start = 0
    while start < len(sets):
        stop, held = start + 1, len(sets[start])
        while stop < len(sets) and held + len(sets[stop]) <= CHUNK:
            held += len(sets[stop])
            stop += 1
        flat = np.concatenate(sets[start:stop])
        at = np.cumsum([0, *map(len, sets[start : stop - 1])])
        for j in range(k):
            out[start:stop, j] = np.minimum.reduceat(flat * factor[j] + offset[j], at) >> U(32)
        start = stop
    return out


def digest(values: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return b"".join(int(mix(values, seed).sum(dtype=U)).to_bytes(8, "little") for seed in (11, 12))
