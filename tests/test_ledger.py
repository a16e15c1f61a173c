"""The batch ledger: every file lands once, whatever run fails where."""

import os

import pytest
from pyspark.sql import functions as F

from longform.sources.files import Taken, commit_text, listed_files, names, read_text
from longform.streaming.ledger import changed_files, land_new, landed_table, prepare, publish, published, recover


class Crash(Exception):
    pass


def crash(note):
    raise Crash(note["run"])


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write(text)


def values(spark, out):
    cells = landed_table(spark, out)
    return sorted(((r.file_name, r.lab_provided_value) for r in cells.collect()), key=str)


@pytest.fixture
def folders(tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(source, "vendor_a 1.csv", "x,y\n1,2\n")
    put(source, "vendor_b#2.csv", "x,y\n3,4\n")
    return source, out


A, B = [("vendor_a 1.csv", "1"), ("vendor_a 1.csv", "2")], [("vendor_b#2.csv", "3"), ("vendor_b#2.csv", "4")]


def test_only_new_files_land(spark, folders):
    source, out = folders
    assert landed_table(spark, out).isEmpty() and published(spark, out) == []
    first = land_new(spark, source, out, threshold=2)
    assert len(first) == 1 and values(spark, out) == A + B
    assert land_new(spark, source, out, threshold=2) == []
    put(source, "vendor_c.csv", "x,y\n5,\n")
    put(source, "vendor_d.csv", "no header\n")
    put(source, "vendor_e.csv", "")
    second = land_new(spark, source, out, threshold=2)
    assert len(second) == 1 and values(spark, out)[-2:] == [("vendor_c.csv", "5"), ("vendor_c.csv", None)]
    ledger = landed_table(spark, out, "files").collect()
    assert sorted((r.file_name, r.run) for r in ledger) == [
        ("vendor_a 1.csv", first[0]),
        ("vendor_b#2.csv", first[0]),
        *[(f"vendor_{x}.csv", second[0]) for x in "cd"],
    ]
    assert sorted(r.file_name for r in landed_table(spark, out, "errors").collect()) == ["vendor_d.csv"]
    assert land_new(spark, source, out, threshold=2) == []
    assert [(m["files"], m["cells"]) for m in published(spark, out)] == [(2, 4), (2, 2)]
    put(source, "vendor_e.csv", "x,y\n7,8\n")
    assert len(land_new(spark, source, out, threshold=2)) == 1 and ("vendor_e.csv", "8") in values(spark, out)


def test_crash_between_writing_and_publishing_is_continued(spark, folders):
    source, out = folders
    with pytest.raises(Crash) as failed:
        land_new(spark, source, out, threshold=2, before_publish=crash)
    assert landed_table(spark, out).isEmpty() and landed_table(spark, out, "files").isEmpty()
    put(source, "vendor_c.csv", "x,y\n5,6\n")
    runs = land_new(spark, source, out, threshold=2)
    assert runs[0] == str(failed.value) and len(runs) == 2
    assert values(spark, out) == [*A, *B, ("vendor_c.csv", "5"), ("vendor_c.csv", "6")]


def test_crash_while_writing_is_discarded(spark, folders, monkeypatch):
    source, out = folders
    import longform.streaming.ledger as ledger

    def refuse(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "commit_text", refuse)  # the cells are written, the note is not
        with pytest.raises(Crash):
            land_new(spark, source, out, threshold=2)
    assert len(names(spark, f"{out}/cells")) == 1 and landed_table(spark, out).isEmpty()
    assert recover(spark, out) == []
    assert len(land_new(spark, source, out, threshold=2)) == 1
    assert values(spark, out) == A + B and len(names(spark, f"{out}/cells")) == 2


def test_of_two_runs_at_once_one_is_published(spark, folders):
    source, out = folders
    notes = [prepare(spark, source, out, threshold=2) for _ in range(2)]
    done = recover(spark, out)
    other = next(n for n in notes if n["run"] not in done)
    with pytest.raises(Taken):
        publish(spark, out, other)
    assert values(spark, out) == A + B
    assert land_new(spark, source, out, threshold=2) == [] and values(spark, out) == A + B


def test_large_backlogs_go_in_several_runs(spark, folders):
    source, out = folders
    put(source, "vendor_c.csv", "x,y\n5,6\n")
    assert len(land_new(spark, source, out, threshold=2, max_files=2)) == 2
    assert len(values(spark, out)) == 6


def test_changed_files_are_told(spark, folders):
    source, out = folders
    land_new(spark, source, out, threshold=2)
    assert changed_files(spark, source, out).isEmpty()
    put(source, "vendor_a 1.csv", "x,y\n1,2\n7,8\n")
    assert [r.file_name for r in changed_files(spark, source, out).collect()] == ["vendor_a 1.csv"]
    assert land_new(spark, source, out, threshold=2) == []


def test_commits_refuse_a_taken_name(spark, tmp_path):
    path = str(tmp_path / "notes" / "one.json")
    commit_text(spark, path, "é1")
    with pytest.raises(Taken):
        commit_text(spark, path, "2")
    assert read_text(spark, path) == "é1" and names(spark, str(tmp_path / "notes")) == ["one.json"]


def test_listing_reads_sizes_only(spark, folders):
    source, _ = folders
    files = listed_files(spark, source)
    assert sorted((r.file_name, r.file_size) for r in files.collect()) == [("vendor_a 1.csv", 8), ("vendor_b#2.csv", 8)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert files.where(F.col("file_size") == 0).isEmpty()
