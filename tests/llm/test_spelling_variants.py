import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from longform.llm import spelling_variants as variants
from longform.llm.kd_tree import KdTree, outlines, vectors
from longform.llm.queries import QUERIES


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            words[word] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def brute(words):
    """By deletions: words are near if they are equal but for one letter in one place, or one gives the other by deleting one."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def collected(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def lexicon(seed, n=700):
    rng, words = random.Random(seed), {}
    base = ["".join(rng.choice("abcdeéÀ") for _ in range(rng.randint(4, 9))) for _ in range(n // 4)]
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
        words["".join(w)] = rng.choice([3, 4, 6, 8, 8, 17, 40])
    return {w: c for w, c in words.items() if len(w) >= 5}


@pytest.mark.parametrize("cell, block, leaf", [(8192, 32768, 16), (40, 32768, 4), (40, 25, 2)])
def test_near_words_match_brute_force(spark, monkeypatch, cell, block, leaf):
    for name, value in (("CELL", cell), ("BLOCK", block), ("LEAF", leaf)):
        monkeypatch.setattr(variants, name, value)
    words = lexicon(cell + block)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert collected(variants.variant_groups(table)) == brute(words)


def test_cells_of_a_small_sample_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(variants, "SAMPLE", 60)
    monkeypatch.setattr(variants, "LONGEST", 7)
    monkeypatch.setattr(variants, "CELL", 8)
    monkeypatch.setattr(variants, "LEAF", 2)
    words = lexicon(5)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert collected(variants.variant_groups(table)) == brute(words)


def test_tree_reaches_every_match():
    rng = np.random.default_rng(4)
    words = [bytes(rng.choice(list(b"abcd\xe9"), rng.integers(5, 8))) for _ in range(400)]
    counts = vectors(words)
    tree = KdTree(counts, 5)
    assert sorted(np.concatenate(tree.cells).tolist()) == list(range(400))
    for up, down in ((0, 0), (1, 0), (1, 1)):
        found = {(int(q), int(s)) for leaf, rows in tree.reach(counts, up, down) for q in rows for s in tree.cells[leaf]}
        for q in range(0, 400, 7):
            difference = counts.astype(int) - counts[q].astype(int)
            match = (np.maximum(difference, 0).sum(1) <= up) & (np.maximum(-difference, 0).sum(1) <= down)
            assert {(q, s) for s in np.flatnonzero(match).tolist()} <= found
    distance = np.abs(counts[:, None].astype(int) - counts[None].astype(int)).sum(2)
    bits = outlines(counts)
    assert (np.bitwise_count(bits[:, None] ^ bits[None]).sum(2) <= distance).all()


def test_one_inserted():
    def of(short, long):
        a, b = (np.frombuffer(x.encode("latin-1"), np.uint8)[None] for x in (short, long))
        return bool(variants.one_inserted(a, b)[0])

    assert of("abc", "xabc") and of("abc", "abcx") and of("abc", "axbc") and of("aaa", "aaaa")
    assert not of("abc", "acbx") and not of("abc", "bcxa") and not of("abc", "xxbc")


def test_documents_match_brute_force(documents):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefÉñ×") for _ in range(rng.randint(3, 8))) for _ in range(30)]
    rows = [(i if i % 9 else None, " ".join(rng.choice(base).title() for _ in range(rng.randint(0, 200))) + "\n1a!") for i in range(120)]
    rows += [(900, None), (901, ""), (902, "z" * 50_000 + " " + "z" * 49_999), (903, " ".join(["z" * 50_000, "z" * 49_999] * 3))]
    rows += [(903, " ".join(["z" * 50_000, "z" * 49_999] * 3))]
    words = counted(rows)
    assert len(words) > 25 and max(map(len, words)) > 40_000
    assert collected(variants.variant_groups(variants.vocabulary(documents(rows), dent=True))) == brute(words)


def test_awkward(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert collected(variants.variant_groups(variants.vocabulary(awkward, dent=True))) == brute(counted(rows))
    assert variants.variant_groups(variants.vocabulary(nothing, dent=True)).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(QUERIES["op13_spelling_variants"](spark, sf)) == brute(counted(rows))
