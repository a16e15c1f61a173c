import random

import pytest

from longform.llm import near_dedup
from longform.llm.near_dedup import band_rows, drop_near_duplicates, least_matches, near_duplicates


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def corpus(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 30, 120]))]
        for _ in range(rng.randint(1, 14)):
            text = [word() if rng.random() < rng.choice([0, 0.005, 0.02, 0.04]) else w for w in base]
            rows.append((n, " ".join(text).upper() if rng.random() < 0.2 else " ".join(text)))
            n += 1
    return rows


@pytest.mark.parametrize("hubs", [0, 1])
@pytest.mark.parametrize("percent", [80, 85])
def test_components_match_brute_force(spark, documents, monkeypatch, hubs, percent):
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", hubs)
    rows = corpus()
    got = sorted(tuple(r) for r in near_duplicates(documents(rows), percent).collect())
    assert got == brute(rows, percent)


def test_blocks_of_a_bucket_lose_no_link(spark, documents, monkeypatch):
    monkeypatch.setattr(near_dedup, "HUB_ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    rows = corpus(9)
    assert sorted(tuple(r) for r in near_duplicates(documents(rows), 80).collect()) == brute(rows, 80)


def test_bounds():
    for percent in (80, 85):
        r = band_rows(percent)
        assert (1 - (percent / 100) ** r) ** (128 // r) <= 1e-6
    assert least_matches(85, 32) < 27 and least_matches(85, 128) > 4 * 16
    assert least_matches(85, 128) < 0.85 * 128


def test_awkward(awkward):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(awkward).collect()}
    n = len(shingles("lorem ipsum dolor sit amet, consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua"))
    assert {(1, n, 1, True), (2, n, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (None, n, None, True)} <= got
    assert (8, 1, 8, True) in got
    kept = drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 2


def test_texts_of_one_id_are_linked(documents):
    got = near_duplicates(documents([(5, "a b c d e f"), (5, "q r s t u v"), (7, "q r s t u v"), (2, "a b c d e f")])).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(5, 2), (7, 2), (2, 2)}


def test_empty(nothing):
    assert near_duplicates(nothing).count() == 0
    assert drop_near_duplicates(nothing).count() == 0


def test_map_columns_are_kept(documents):
    from pyspark.sql import functions as F

    docs = documents([(1, "b b"), (1, "a a"), (1, "a a"), (2, "c c")]).withColumn("tags", F.create_map(F.lit("k"), F.col("text")))
    kept = sorted((r.doc_id, r.text, r.tags["k"]) for r in drop_near_duplicates(docs).collect())
    assert kept == [(1, "a a", "a a"), (2, "c c", "c c")]
