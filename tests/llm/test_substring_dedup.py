import hashlib
import random

from longform.llm.substring_dedup import remove_repeats


def brute(rows):
    first = {}
    rows = sorted(rows)
    for i, t in rows:
        b = t.encode()
        for a in range(len(b) - 99):
            first.setdefault(b[a : a + 100], (i, a))
    out = []
    for i, t in rows:
        b = t.encode()
        gone = bytearray(len(b))
        for a in range(len(b) - 99):
            if first[b[a : a + 100]] != (i, a):
                gone[a : a + 100] = b"\1" * 100
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_matches_brute_force(documents):
    rng = random.Random(1)
    base = "".join(rng.choice("abcdefgh é") for _ in range(2500))
    cut = lambda: (lambda k: base[k : k + rng.randint(60, 260)])(rng.randint(0, 2300))
    rows = [(0, ""), (1, "x" * 99), (2, "x" * 100), (3, "x" * 350), (4, "ab" * 200), (5, base), (6, base[:900] + "Q" + base[901:]), (7, base[500:900]), (8, base)]
    rows += [(9, "zz" + base[5:300] + "yy" + base[200:700]), (10, "y" * 150 + base[:150] + "y" * 150)]
    rows += [(20 + i, "".join(cut() for _ in range(6))) for i in range(25)]
    got = sorted(tuple(r)[:5] for r in remove_repeats(documents(rows)).collect())
    assert got == brute(rows)


def test_long_texts_are_cut_without_losing_matches(documents, monkeypatch):
    from longform.llm import phrases

    rng = random.Random(3)
    base = "".join(rng.choice("abcdefghij") for _ in range(900))
    rows = [(1, base), (2, base[100:700] + "!" + base[300:])]
    want = {}
    for piece in (phrases.PIECE, 64):
        monkeypatch.setattr(phrases, "PIECE", piece)
        data = (base + base).encode()
        key, unit, at, first, last = phrases.phrases(data)
        covered = sorted(s for a, b in zip(first, last) for s in range(a, b + 1))
        assert covered == list(range(len(data) - 99))
        want[piece] = dict(zip(at.tolist(), key.tolist()))
        monkeypatch.undo()
    assert want[64].items() <= want[1 << 20].items() or set(want[64]) == set(want[1 << 20])
    assert sorted(tuple(r)[:5] for r in remove_repeats(documents(rows)).collect()) == brute(rows)


def test_awkward(awkward):
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in remove_repeats(awkward).collect()]
    n = max(b for i, b, _ in got if i == 1)
    assert got.count((1, n, 0)) == 2 and (2, n, n) in got and (None, n, n) in got
    assert (3, 0, 0) in got and (None, 0, 0) in got
    assert (7, 50_000, 49_900) not in got and (7, 50_000, 49_999) in got  # all windows but the first start later


def test_different_texts_of_one_id(documents):
    got = remove_repeats(documents([(1, "a" * 60 + "b" * 80), (1, "c" + "a" * 60 + "b" * 80)])).collect()
    assert sorted(r.n_removed for r in got) in ([0, 140], [0, 140]) and len(got) == 2


def test_empty(nothing):
    assert remove_repeats(nothing).count() == 0
