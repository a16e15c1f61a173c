import pytest
from pyspark.sql import functions as F

from longform.operators import cells as C, header as H

GRID = "file_id string, line_no bigint, cells array<string>"


def grid(spark, **files):
    rows = [(name, i, cells) for name, lines in files.items() for i, cells in enumerate(lines)]
    return spark.createDataFrame(rows, GRID)


def found(header):
    return {r.file_id: (r.header_line_no, list(r.header_cells)) for r in header.collect()}


def test_first_wide_row_is_the_header(spark):
    g = grid(spark, f=[[None] * 3, [None, None, "header"], ["A", "B", "C"], ["1", "2", "3"]])
    assert found(H.detect_header(g, 3)) == {"f": (2, ["A", "B", "C"])}


def test_missing_header_is_listed(spark):
    g = grid(spark, f=[[None, None], [None, "Header"]], ok=[["a", "b"]])
    header = H.detect_header(g, 2)
    assert list(found(header)) == ["ok"]
    assert [tuple(r) for r in H.files_without_header(g, header).collect()] == [("f", "Could not find header row.")]


def test_peek_and_argmax(spark):
    lines = [["m", ""], *[["x", "", ""]] * 10, ["a", "b", "c"]]
    g = grid(spark, f=lines)
    assert found(H.detect_header(g, 3, peek=10)) == {}
    assert found(H.detect_header(g, 3)) == {"f": (11, ["a", "b", "c"])}
    g = grid(spark, f=[["m"], ["a", "b"], ["1", "2"], ["", ""]])
    assert found(H.detect_header_argmax(g)) == {"f": (1, ["a", "b"])}


def test_threshold_may_depend_on_the_vendor(spark):
    g = grid(spark, vendor_a=[["a", "b"], ["x", "y", "z"]], vendor_b=[["a", "b"], ["x", "y", "z"]])
    t = H.threshold_by_vendor(F.col("file_id"), {"vendor_a": 3}, default=2)
    assert {k: v[0] for k, v in found(H.detect_header(g, t)).items()} == {"vendor_a": 1, "vendor_b": 0}


def test_unnamed_columns_go_with_their_data(spark):
    g = grid(spark, f=[[None, "A", "B", None], [None, "1", "2", None], ["junk", "3", "4", "x", "beyond"], ["s", "5"]])
    rows = H.drop_unnamed_columns(g, H.detect_header(g, 2)).orderBy("row_index").collect()
    assert [list(r.cells) for r in rows] == [["1", "2"], ["3", "4", "beyond"], ["5"]]


@pytest.mark.parametrize(
    "names, want",
    [
        ("foo,bar,bar,bar,foo", "foo,bar,bar_1,bar_2,foo_1"),
        ("a,a,a_1", "a,a_1,a_1"),
        ("one", "one"),
    ],
)
def test_repeated_names_get_suffixes(spark, names, want):
    df = spark.range(1).select(F.split(F.lit(names), ",").alias("n"))
    assert df.select(H.deduplicated(F.col("n")).alias("n")).first().n == want.split(",")


def test_unpivot_positions(spark):
    g = grid(spark, f=[["", "A", "", "B", " "], ["x", "1", "y", "", "2"], ["x", "3"]])
    rows = C.unpivot_cells(g, H.detect_header(g, 2)).orderBy("row_index", "column_index").collect()
    assert [(r.row_index, r.column_index, r.source_column_index, r.lab_provided_attribute, r.lab_provided_value) for r in rows] == [
        (1, 1, 2, "A", "1"),
        (1, 2, 4, "B", None),
        (1, 3, 5, " ", "2"),
        (2, 1, 2, "A", "3"),
    ]


def test_unpivot_and_pivot_are_inverse(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "", "x")], "k int, p string, q string")
    cells = C.unpivot_columns(df, ["k"])
    assert cells.count() == 6
    back = C.pivot_back(cells, ["k"], ["p", "q"], "lab_provided_attribute")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
