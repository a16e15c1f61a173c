"""Growing tables, and names within a few edits."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row, types as T

from longform.operators.similar_names import mapping_suggestions, near_names
from longform.sources.schema_log import GrowingTable, wider


def kind(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("int", "int", "int"),
        ("byte", "long", "long"),
        ("long", "double", "double"),
        ("float", "int", "double"),
        ("double", "string", "string"),
        ("date", "timestamp", "timestamp"),
        ("boolean", "int", "string"),
        ("decimal(10,2)", "int", "decimal(12,2)"),
        ("decimal(38,2)", "decimal(38,10)", "double"),
        ("struct<a:int,b:string>", "struct<b:int,c:date>", "struct<a:int,b:string,c:date>"),
        ("array<int>", "array<long>", "array<bigint>"),
        ("map<string,int>", "map<string,struct<x:int>>", None),
        ("int", "array<int>", None),
    ],
)
def test_lattice(spark, a, b, both):
    for x, y in ((a, b), (b, a)):
        if both is None:
            with pytest.raises(ValueError):
                wider(kind(x), kind(y))
        else:
            got = wider(kind(x), kind(y))
            assert sorted(got.simpleString()) == sorted(kind(both).simpleString())


def test_a_table_grows_without_rewriting(spark, tmp_path):
    table = GrowingTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.append(spark.createDataFrame([(1, Row(x=1)), (2, None)], "id int, s struct<x:int>"))
    first = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    table.append(spark.createDataFrame([(2**40, Row(x=2, y="q"), [1])], "id long, s struct<x:int,y:string>, `odd name` array<int>"))
    table.append(spark.createDataFrame([(7,)], "id int"))
    assert len(table.schemas()) == 2
    table.append(spark.createDataFrame([("x", Row(x=dt.date(2024, 1, 2)), [2**40])], "id string, s struct<x:date>, `odd name` array<long>"))
    rows = table.read().collect()
    want = {
        ("1", ("1", None), None),
        ("2", None, None),
        (str(2**40), ("2", "q"), (1,)),
        ("7", None, None),
        ("x", ("2024-01-02", None), (2**40,)),
    }
    assert {(r.id, r.s and tuple(r.s), r["odd name"] and tuple(r["odd name"])) for r in rows} == want
    assert all(p.stat().st_mtime_ns == t for p, t in first.items()) and len(table.schemas()) == 3
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([([1],)], "id array<int>"))
    assert table.read().count() == 5
    table.register("grown")
    assert spark.sql("SELECT count(s.y) AS n FROM grown").first().n == 1


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [1, 2])
def test_near_names_match_all_pairs(spark, distance):
    rng = random.Random(distance)
    word = lambda: "".join(rng.choice("abcé_") for _ in range(rng.randint(0, 9)))
    left, right = {word() for _ in range(150)} | {"aaaaaaaaaa", "abababab"}, {word() for _ in range(150)} | {"aaaaaaaa", "babababa"}
    frame = lambda words: spark.createDataFrame([(w,) for w in [*words, None, *sorted(words)[:3]]], "w string")
    got = near_names(frame(left), frame(right), distance).collect()
    want = {(a, b, edits(a, b)) for a in left for b in right if edits(a, b) <= distance}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_suggestions(spark):
    cells = spark.createDataFrame([("a", "sampl_barcode"), ("a", "pH"), ("a", "ph"), ("a", "Copper ppm"), ("a", "junk"), ("b", "sampl_barcode"), ("c", "ph")], "vendor_id string, lab_provided_attribute string")
    mapping = spark.createDataFrame([("a", "sample_barcode", "1"), ("a", "ph", "2"), ("a", "copper_ppm", "3"), ("a", "pb", "4"), ("b", "acidity", "2")], "vendor_id string, vendor_column_name string, canonical_column_id string")
    got = {tuple(r) for r in mapping_suggestions(cells, mapping).collect()}
    assert got == {("a", "sampl_barcode", "sample_barcode", "1", 1, 1), ("a", "pH", "ph", "2", 0, 1), ("a", "pH", "pb", "4", 1, 2), ("a", "Copper ppm", "copper_ppm", "3", 0, 1)}
