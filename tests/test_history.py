"""Drift over many loads, and dense numbers for names."""

import random

from longform.operators.drift import DriftHistory, instability
from longform.sources.dictionary import Dictionary

CELLS = "vendor_id string, lab_provided_attribute string, row_index int"


def test_state_equals_recomputing(spark, tmp_path):
    rng = random.Random(6)
    loads = [[(v, a, i) for v in "ab" for a in ("ph", "cu", "zn", "é #") if rng.random() < 0.6 for i in range(rng.randint(1, 3))] for _ in range(5)]
    loads[2] = []
    history = DriftHistory(spark, str(tmp_path / "drift"))
    assert history.state().isEmpty()
    for k, rows in enumerate(loads):
        history.record(spark.createDataFrame(rows, CELLS), k)
        history.record(spark.createDataFrame([("x", "twice", 1)], CELLS), k)  # recorded already
    want = {}
    for v, a in {r[:2] for rows in loads for r in rows}:
        seen = [k for k, rows in enumerate(loads) if any(r[:2] == (v, a) for r in rows)]
        spells = sum(k - 1 not in seen for k in seen)
        want[v, a] = (seen[0], seen[-1], len(seen), spells, sum(r[:2] == (v, a) for rows in loads for r in rows))
    assert {tuple(r[:2]): tuple(r[2:]) for r in history.state().collect()} == want
    for r in instability(history.state(), 4).collect():
        mine = {a: [any(x[:2] == (r.vendor_id, a) for x in rows) for rows in loads] for v, a in want if v == r.vendor_id}
        first = min(k for seen in mine.values() for k, s in enumerate(seen) if s)
        came = sum(seen[k] and not (k and seen[k - 1]) for seen in mine.values() for k in range(first + 1, 5))
        went = sum(seen[k] and not seen[k + 1] for seen in mine.values() for k in range(4))
        assert (r.attributes, r.present, r.came, r.went) == (len(mine), sum(s[4] for s in mine.values()), came, went)
        assert r.changes_per_load == (came + went) / (4 - first)


def test_numbers_are_dense_and_stay(spark, tmp_path):
    dictionary = Dictionary(spark, str(tmp_path / "names"))
    assert dictionary.read().isEmpty()
    frame = lambda words: spark.createDataFrame([(w,) for w in words], "w string")
    first = {r.name: r.id for r in dictionary.extend(frame(["b", "a", "b", None, "", "é"])).collect()}
    assert sorted(first.values()) == [0, 1, 2, 3] and sorted(first, key=first.get) == ["", "a", "b", "é"]
    many = [f"name {i}" for i in range(3000)]
    second = {r.name: r.id for r in dictionary.extend(frame(["a", *many])).collect()}
    assert first.items() <= second.items() and sorted(second.values()) == list(range(3004))
    assert {r.name: r.id for r in dictionary.extend(frame(["a", None])).collect()} == second
    assert dictionary.extend(frame(many).where("false")).count() == 3004
