"""Records without known names, and tables clustered along a curve."""

import random

import pytest
from pyspark.sql import functions as F

from longform.functions.dialect import CsvDialect
from longform.operators.records import pivot_records, row_maps, unpivot_records
from longform.plans.bronze import land_long
from longform.sources import clustered
from longform.sources.clustered import ClusteredTable, range_cuts, range_number, z_order

CELLS = "k int, lab_provided_attribute string, lab_provided_value string"
TABLE = "vendor_id string, lab_provided_attribute string, file_name string, row_index int"


def test_names_are_found_with_the_records(spark):
    rows = [(1, "a", "1"), (1, "b", None), (2, "c d", "x"), (2, "a", "2"), (2, "a", "3"), (2, "a", None), (3, None, "q"), (4, "e`f", ""), (4, "é,<", "z"), (None, "a", "5")]
    found = pivot_records(spark.createDataFrame(rows, CELLS), ["k"])
    assert found.names() == ["a", "b", "c d", "e`f", "é,<"]
    wide = {r.k: tuple(r)[1:] for r in found.columns().collect()}
    assert wide == {
        1: ("1", None, None, None, None),
        2: ("3", None, "x", None, None),
        3: (None,) * 5,
        4: (None, None, None, "", "z"),
        None: ("5", None, None, None, None),
    }


def test_records_keep_nulls_apart_from_gaps(spark):
    rng = random.Random(8)
    rows = [(k, f"n{j}", rng.choice(["x", "", None])) for k in range(40) for j in range(9) if rng.random() < 0.6]
    cells = spark.createDataFrame(rows, CELLS)
    again = unpivot_records(pivot_records(cells, ["k"]).df)
    assert sorted(map(str, again.collect())) == sorted(map(str, cells.collect()))


def test_ragged_files_come_back(spark, tmp_path):
    (tmp_path / "vendor_a one.csv").write_text("notes,,\nid,ph,cu\n1,2\n3,,4,5\n\n6,7,8\n")
    (tmp_path / "vendor_b two.csv").write_text("id,zn (mg),ph\n1,,\n2\n")
    cells = land_long(spark, str(tmp_path), CsvDialect(), threshold=3).cells
    keys = ["file_name", "row_index"]
    found = pivot_records(cells, keys)
    assert found.names() == ["cu", "id", "ph", "zn (mg)"]
    entries = unpivot_records(found.df)
    want = cells.select(*entries.columns)
    assert sorted(map(str, entries.collect())) == sorted(map(str, want.collect()))
    again = row_maps(entries, keys).select(*keys, F.to_json("record", {"ignoreNullFields": "false"}).alias("j"))
    first = row_maps(cells, keys).select(*keys, F.to_json("record", {"ignoreNullFields": "false"}).alias("j"))
    assert again.exceptAll(first).isEmpty() and first.exceptAll(again).isEmpty()


def test_records_of_nothing_and_of_clashing_names(spark):
    none = pivot_records(spark.createDataFrame([], CELLS), ["k"])
    assert none.names() == [] and none.columns().columns == ["k"] and unpivot_records(none.df).isEmpty()
    with pytest.raises(ValueError, match="also keys"):
        pivot_records(spark.createDataFrame([(1, "k", "2")], CELLS), ["k"]).columns()


def _rows(seed=3):
    rng = random.Random(seed)
    rows = [(f"v{rng.randrange(3)}", f"a{rng.randrange(40):02d}", f"f{rng.randrange(60)}", i) for i in range(4000)]
    return rows + [("v1", "a07", "hot", i) for i in range(4000, 8000)] + [(None, "a01", None, 1), ("", "é", "f\U0001f600", 2)]


def test_every_row_is_written_and_found(spark, tmp_path):
    df = spark.createDataFrame(_rows(), TABLE)
    table = ClusteredTable(spark, str(tmp_path / "t"), ("vendor_id", "lab_provided_attribute", "file_name"))
    table.write(df, rows_per_file=200)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, df.collect()))
    sizes = [r.row_count for r in table.zones().collect()]
    assert sum(sizes) == df.count() and len(sizes) > 30 and max(sizes) < 800  # the hot file, half of all rows, is cut as well
    for wanted in ({"lab_provided_attribute": ["a03"]}, {"vendor_id": ["v2"], "file_name": ["f5", "f9"]}, {"vendor_id": [None]}, {"file_name": ["f\U0001f600", None]}):
        want = [r for r in _rows() if all(r[df.columns.index(c)] in values for c, values in wanted.items())]
        assert sorted(map(str, map(tuple, table.read(wanted).collect()))) == sorted(map(str, want))
    assert table.read({"vendor_id": ["no such"]}).isEmpty()
    with pytest.raises(ValueError, match="not clustered"):
        table.read({"row_index": ["1"]})


def test_a_filter_on_any_column_opens_few_files(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"v{rng.randrange(16):02d}", f"a{rng.randrange(16):02d}", f"f{rng.randrange(16):02d}", i) for i in range(20000)]
    table = ClusteredTable(spark, str(tmp_path / "t"), ("vendor_id", "lab_provided_attribute", "file_name"))
    table.write(spark.createDataFrame(rows, TABLE), rows_per_file=50)
    files = table.zones().count()
    for column, value in (("vendor_id", "v05"), ("lab_provided_attribute", "a11"), ("file_name", "f02")):
        read = table.read({column: [value]})
        assert len(read.inputFiles()) < files / 3
        assert read.count() == sum(r[("vendor_id", "lab_provided_attribute", "file_name").index(column)] == value for r in rows)
        assert "PushedFilters: [In" in read._jdf.queryExecution().toString() or "PushedFilters: [IsNotNull" in read._jdf.queryExecution().toString()


def test_range_numbers_and_places(spark, monkeypatch):
    values = [f"{i:04d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in [*values, None, ""]], "v string")
    cuts = range_cuts(df, "v")
    assert len(cuts) == 255 and cuts == sorted(cuts)
    got = {r.v: r.n for r in df.select("v", range_number(F.col("v"), cuts).alias("n")).collect()}
    assert got == {v: 0 if v is None else sum(c <= v for c in cuts) for v in [*values, None, ""]}
    place = lambda *n: spark.range(1).select(z_order([F.lit(x) for x in n]).alias("z")).first().z
    few = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    assert [r.n for r in few.select(range_number(F.col("v"), range_cuts(few, "v")).alias("n")).collect()] == [0, 85, 170]
    assert [place(0, 0), place(0, 1), place(1, 0), place(3, 2), place(255, 255)] == [0, 1, 2, 14, 65535]
    monkeypatch.setattr(clustered, "SAMPLE", 4)
    assert len(range_cuts(df, "v")) == 3


def test_empty_table(spark, tmp_path):
    table = ClusteredTable(spark, str(tmp_path / "t"), ("vendor_id",))
    table.write(spark.createDataFrame([], TABLE))
    assert table.read().isEmpty() and table.read({"vendor_id": ["v1"]}).isEmpty()
