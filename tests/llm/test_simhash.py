import random

import pytest
from pyspark.sql import functions as F

from longform.llm import simhash
from longform.llm.simhash import fingerprint, near_duplicates, near_links, rings


def plain_fingerprint(text):
    import xxhash

    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [words] if 0 < len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(b" ".join(r), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Components of (id, fingerprint) by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= 2:
                root[find(i)] = find(j)
    ids = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            ids[find(i)] = min(ids.get(find(i), name), name)
    return [(name, f"{f:016x}", ids.get(find(i))) for i, (name, f) in enumerate(rows)]


def key(row):
    return (row[0] is None, row[0] or 0, row[1])


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(3))
    rows, n = [], 0
    for _ in range(15):
        base = [word() for _ in range(rng.choice([1, 2, 3, 60, 300, 900]))]
        for _ in range(rng.randint(1, 8)):
            text = [word() if rng.random() < rng.choice([0, 0.004]) else w for w in base]
            rows.append((n * 7 % 101, (" \n".join(text)).title()))
            n += 1
    return rows


def test_documents_match_brute_force(documents):
    rows = [*corpus(), (500, None), (501, ""), (502, " \t"), (503, "a"), (504, "A b"), (505, "a B c")]
    got = sorted((tuple(r) for r in near_duplicates(documents(rows)).collect()), key=key)
    want = sorted(brute([(i, plain_fingerprint(t)) for i, t in rows]), key=key)
    assert got == want
    assert len({r[2] for r in got}) < len(rows) - 15  # there are components


@pytest.mark.parametrize("block", [512, 8, 1])
def test_no_link_is_lost_at_any_ring(spark, monkeypatch, block):
    """Crowded buckets: fingerprints that agree in most bits go through all rings."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    centre = [rng.getrandbits(64) for _ in range(6)]
    prints = {c for c in centre} | {0, 2**64 - 1}
    for c in centre:
        for _ in range(40):
            flipped = c
            for _ in range(rng.randint(1, 9)):
                flipped ^= 1 << (rng.randrange(64) if rng.random() < 0.5 else rng.randrange(12))
            prints.add(flipped)
    prints = sorted(prints)
    table = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fingerprint long")
    links = [(r.u % 2**64, r.v % 2**64) for r in near_links(table).collect()]
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    want = brute([(i, p) for i, p in enumerate(prints)])
    first = {}
    for (name, _, component), p in zip(want, prints, strict=True):
        first.setdefault(component, find(p))
        assert find(p) == first[component]
    assert len({find(p) for p in prints}) == len({c for *_, c in want})


def test_rings_bring_every_close_pair_together():
    """Any two fingerprints within the distance meet in some bucket of each ring, within a chain's budgets."""
    import numpy as np

    rng = random.Random(1)
    for level in rings():
        for _ in range(300):
            different = 0
            for _ in range(rng.randint(0, 2)):
                different |= 1 << rng.randrange(64)
            meets = [m for m in level if not different & m.mask]
            assert any(simhash.close(np.array([different], np.uint64), m.chains)[0] for m in meets)
    assert [len(level[0].rest) for level in rings()] == [32, 16, 8]


def test_fingerprint_of_long_and_odd_texts():
    for text in ("x" * 50_000, " ".join(f"w{i % 700}" for i in range(40_000)), "É é ÀB c d e", "a\x0bb\x0cc\x1cd e f"):
        assert fingerprint(text) == plain_fingerprint(text)


def test_awkward(awkward, nothing):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by_id[3] == by_id[4] == by_id[5] == {("0" * 16, 3)}
    assert by_id[1] == by_id[2] and {c for _, c in by_id[1]} == {1}
    assert {c for _, c in by_id[None]} == {1, 3}  # rows without an id belong to components and name none
    assert near_duplicates(nothing).count() == 0
    nameless = awkward.where("doc_id IS NULL").withColumn("text", F.lit("alone here"))
    assert {r.component_id for r in near_duplicates(nameless).collect()} == {None}
