import random
import tracemalloc

import pytest

from longform.llm import nbest
from longform.llm.nbest import BLANK, Lattice, segmentations
from longform.llm.queries import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return Lattice(PATH)


def brute(model, text):
    marked, out = BLANK + text.replace(" ", BLANK) if text else "", []

    def walk(at, score, ids):
        if at == len(marked):
            out.append((score, tuple(ids)))
            return
        for stop in range(at + 1, min(len(marked), at + 16) + 1):
            i = model.id_of.get(marked[at:stop])
            if i is not None:
                walk(stop, score + model.score_of[i], [*ids, i])
        if marked[at] not in model.id_of:
            walk(at + 1, score + model.unknown_score, ids + model.bytes_of(marked[at]))

    walk(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("n", [1, 2, 4, 7])
@pytest.mark.parametrize("splits", [True, False])
def test_matches_all_paths(model, n, splits, monkeypatch):
    monkeypatch.setattr(model, "splits", splits)
    model._forget()
    rng = random.Random(n)
    texts = ["", "a", "the cat", "ab  cd", "\n a", " é", "x😀y", "  "]
    texts += ["".join(rng.choice("ab the\nñ😀") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    for text, got in zip(texts, model.segment(texts, n)):
        every = brute(model, text)
        assert [s for s, _ in got] == pytest.approx([s for s, _ in every[:n]])
        paths = {tuple(ids.tolist()) for _, ids in got}
        assert len(paths) == len(got) and paths <= {ids for _, ids in every}
        assert all(model.decode(ids) == text for ids in paths)
    model._forget()


def test_search_and_arrays_agree(model):
    for part in ("▁segmentation", "▁unbelievably", "▁▁▁" + "abc" * 8):
        best, gap, size, ids = model._solve([part])
        found = model.search(part, 2)
        assert best[0] == pytest.approx(found[0][0]) and gap[0] == pytest.approx(found[0][0] - found[1][0])
        assert sum(model.score_of[i] for i in ids) == pytest.approx(best[0]) and size[0] == len(ids)


def test_query_over_rows(awkward, nothing):
    got = segmentations(awkward, PATH, n=3, with_ids=True).collect()
    assert len(got) == awkward.count() and all(r.round_trip for r in got)
    empty = [r for r in got if r.doc_id in (3, 4)]
    assert all(r.n_pieces == 0 and r.score == 0 and r.nbest_scores == [0.0] and r.ids == [] for r in empty)
    assert all(r.nbest_scores == sorted(r.nbest_scores, reverse=True) and r.n_pieces == r.nbest_pieces[0] for r in got)
    assert segmentations(nothing, PATH).count() == 0


def _plain(found):
    return [[(score, ids.tolist()) for score, ids in f] for f in found]


def test_parts_are_numbered_and_forgotten(model, monkeypatch):
    """A table that starts anew in the middle gives what a large one gives, and holds no more than a batch needs."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeñ😀") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts = [None, "", *[" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(40)]]
    model._forget()
    want = _plain(model.segment(texts, 3))
    assert len(model._known) == len(model._names) == len(model._best) == len(model._at) > 250
    monkeypatch.setattr(nbest, "REMEMBERED", 100)
    monkeypatch.setattr(nbest, "PARTS_AT_ONCE", 7)
    monkeypatch.setattr(nbest, "CHARS_AT_ONCE", 60)
    model._forget()
    got = [x for i in range(0, len(texts), 2) for x in _plain(model.segment(texts[i : i + 2], 3))]
    assert [[ids for _, ids in f] for f in got] == [[ids for _, ids in f] for f in want]
    assert [s for f in got for s, _ in f] == pytest.approx([s for f in want for s, _ in f])
    assert len(model._known) <= 170
    model._forget()


def test_memory_of_a_batch(model):
    """Beyond the table of parts, a task holds little more than a few bytes for each character in hand."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(2000)]
    texts = [" ".join(rng.choices(words, k=3000)) for _ in range(100)]
    model._forget()
    for _ in model.segment([" ".join(words)], 4):
        pass
    most = 0
    tracemalloc.start()
    for rows in nbest._slices([len(t) for t in texts]):
        for _ in model.segment(texts[rows], 4):
            pass
        most = max(most, tracemalloc.get_traced_memory()[1])
    tracemalloc.stop()
    model._forget()
    assert most < 12e6


def test_workers_need_no_pandas(spark):
    """Rows go to Python and back as Arrow, in batches of any size."""
    docs = spark.createDataFrame([(i if i % 5 else None, None if i % 7 == 0 else "some words " * (i % 50)) for i in range(300)], "doc_id long, text string")
    got = segmentations(docs, PATH, n=2, with_ids=True)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    rows = got.collect()
    assert len(rows) == 300 and all(r.round_trip and len(r.ids) == r.n_pieces for r in rows)
    assert sum(r.doc_id is None for r in rows) == 60
