import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from brute import parse
from longform.functions.dialect import CsvDialect
from longform.operators.cells import BRONZE_SCHEMA, conform_bronze
from longform.plans.bronze import append_wide, land_long, land_wide, land_wide_files, wide_errors
from longform.sources.csv_lines import read_grid
from longform.sources.reference_data import VENDOR_B_RENAMES

FIELDS = ["file_name", "row_index", "column_index", "lab_provided_attribute", "lab_provided_value"]


def cells_of(landing):
    return sorted((tuple(r) for r in landing.cells.select(*FIELDS).collect()), key=str)


def expected(folder, threshold, **options):
    rows = []
    for name in os.listdir(folder):
        found = parse(os.path.join(folder, name), threshold, **options)
        rows += [(name, *cell) for cell in found or []]
    return sorted(rows, key=str)


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return path


def test_end_to_end_example(spark, tmp_path):
    put(tmp_path, "x.csv", ",,Header\n,A,B\n,1,2\n,3,4\n")
    assert cells_of(land_long(spark, str(tmp_path), threshold=2)) == [
        ("x.csv", 1, 1, "A", "1"),
        ("x.csv", 1, 2, "B", "2"),
        ("x.csv", 2, 1, "A", "3"),
        ("x.csv", 2, 2, "B", "4"),
    ]


def test_metadata_padding_and_positions(spark, tmp_path):
    header = "sampl_barcode,lab_id,Date_Recieved,date_proccessed,ph,Copper_Ppm,zinc_ppm"
    rows = [f"PYB{i:04d}-000000,PSL-01 0000{i % 10},2024-02-0{1 + i % 9},2024-03-01,6.5{i % 10},136.,\"\"" for i in range(10)]
    pad = ',"","",""'
    text = "\n".join(['"","","","","","","",""' + pad, "Lab Report" + pad, header + pad, *[r + pad for r in rows]]) + "\n"
    put(tmp_path, "vendor_a_excel.csv", text)
    landing = land_long(spark, str(tmp_path), threshold=5)
    got = landing.cells.collect()
    assert len(got) == 70 and {r.vendor_id for r in got} == {"vendor_a"}
    assert {r.row_index for r in got} == set(range(1, 11))
    assert {r.source_line_no for r in got} == set(range(3, 13))
    assert sum(r.lab_provided_value is None for r in got) == 10
    assert landing.headers.first().header_line_no == 2


def test_default_threshold_is_ten(spark, tmp_path):
    names = ",".join(f"c{i}" for i in range(10))
    put(tmp_path, "wide.csv", names + "\n" + "\n".join(",".join("1" * 10) for _ in range(15)) + "\n")
    put(tmp_path, "narrow.csv", names[:-3] + "\n1,2\n")
    landing = land_long(spark, str(tmp_path))
    assert landing.cells.select("row_index").distinct().count() == 15
    assert [(r.file_name, r.error) for r in landing.errors.collect()] == [("narrow.csv", "Could not find header row.")]


ODD_CELLS = ["", "a", '"q', 'x"y', '"a,b"', '"l1\nl2"', '"d""q"', '"d""q\n\n,"tail', " sp", '5"', '"" x', '"a"b"c', "é", '"\r\n"']


def odd_files(folder, files=24, seed=3):
    rnd = random.Random(seed)
    for k in range(files):
        lines = ["meta,,"] * rnd.randint(0, 3)
        if k % 10 != 9:
            lines.append(rnd.choice(['a,b,"",c,a', '"a","b x",,c,"d""e"', " ,a,a,a_1"]))
        for _ in range(rnd.randint(0, 50)):
            pool = ["1", "", "zz", '"y"'] if k % 3 == 0 else ODD_CELLS
            lines.append(",".join(rnd.choice(pool) for _ in range(rnd.randint(0, 7))))
        # a closing quote and a plain last line: no field is open at the end
        put(folder, f"vendor_{'ab'[k % 2]}_{k}.csv", "\n".join(lines) + '\n"\nend\n')


def test_odd_files_match_brute_force(spark, tmp_path):
    odd_files(tmp_path)
    landing = land_long(spark, str(tmp_path), threshold=4)
    want = [r if r[4] is None or not r[4].endswith("\n") else (*r[:4], r[4].rstrip("\n") or None) for r in expected(tmp_path, 4)]
    got = [r if r[4] is None or not r[4].endswith("\n") else (*r[:4], r[4].rstrip("\n") or None) for r in cells_of(landing)]
    assert sorted(got, key=str) == sorted(want, key=str)
    without = {n for n in os.listdir(tmp_path) if parse(tmp_path / n, 4) is None}
    assert {r.file_name for r in landing.errors.collect() if r.error == "Could not find header row."} == without


def test_split_files_match_whole_files(spark, tmp_path, small_splits):
    """Splits of a few lines: numbering, header and quote state carry across them."""
    put(tmp_path, "vendor_a.csv", "m\n" * 40 + "a,b,c,d\n" + "".join(f"{i},x,,z\n" for i in range(200)))
    put(tmp_path, "vendor_b.csv", "a,b,c,d\n" + "".join(f'{i},"two\nlines ""{i}""",,z\n' for i in range(150)))
    put(tmp_path, "vendor_c.csv", "a,b,c,d\n" + '1,"' + "long text, over many splits\n" * 60 + '",3,4\n5,6,7,8\n')
    assert cells_of(land_long(spark, str(tmp_path), threshold=4)) == expected(tmp_path, 4)


def test_unclosed_quote_loses_no_row(spark, tmp_path, small_splits):
    put(tmp_path, "good.csv", "a,b\n1,\"x\ny\"\n")
    put(tmp_path, "bad.csv", 'a,b\n1,2\n3,"' + "never closed\n" * 300)
    landing = land_long(spark, str(tmp_path), threshold=2)
    assert [(r.file_name, r.error) for r in landing.errors.collect()] == [("bad.csv", "Quoted field is never closed.")]
    got = cells_of(landing)
    assert [r for r in got if r[0] == "good.csv"] == [("good.csv", 1, 1, "a", "1"), ("good.csv", 1, 2, "b", "x\ny")]
    bad = [r for r in got if r[0] == "bad.csv"]
    assert [r[4] for r in bad[:3]] == ["1", "2", "3"] and bad[3][4].rstrip("\n") == "\n".join(["never closed"] * 300)


def test_long_record_lands_whole(spark, tmp_path, conf):
    conf("spark.sql.files.maxPartitionBytes", "4m")
    body = ("x" * 99_999 + "\n") * 200
    put(tmp_path, "long.csv", f'a,b\n1,2\n3,"{body}"\n5,6\n')
    landing = land_long(spark, str(tmp_path), threshold=2)
    assert landing.errors.count() == 0
    got = {(r.row_index, r.column_index): r.n for r in landing.cells.selectExpr("row_index", "column_index", "length(lab_provided_value) AS n").collect()}
    assert got == {(1, 1): 1, (1, 2): 1, (2, 1): 1, (2, 2): len(body), (3, 1): 1, (3, 2): 1}


def test_numbers_survive_another_parallelism(spark, tmp_path, conf):
    """The cluster grows or shrinks between building a landing and running it."""
    conf("spark.sql.files.minPartitionNum", "4")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    conf("spark.sql.files.openCostInBytes", "1")
    conf("spark.sql.leafNodeDefaultParallelism", "4")
    text = "a,b,c\n" + "".join(f"{i},{i * 2},x\n" for i in range(30_000))
    put(tmp_path, "vendor_a.csv", text)
    landing = land_long(spark, str(tmp_path), threshold=3)
    for cores in ("7", "2", "16"):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
        got = landing.cells.filter("column_index = 1").selectExpr("count(*)", "count_if(lab_provided_value = row_index - 1)").first()
        assert tuple(got) == (30_000, 30_000)


def test_another_split_size_fails_rather_than_lose_lines(spark, tmp_path, conf):
    conf("spark.sql.files.openCostInBytes", "1")
    conf("spark.sql.files.maxPartitionBytes", "40000")
    put(tmp_path, "vendor_a.csv", "a,b,c\n" + "".join(f"{i},{i * 2},x\n" for i in range(30_000)))
    landing = land_long(spark, str(tmp_path), threshold=3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "17000")
    with pytest.raises(Exception, match="split differently"):
        landing.cells.write.format("noop").mode("overwrite").save()


def test_every_file_appears_somewhere(spark, tmp_path):
    put(tmp_path, "good.csv", "a,b\n1,2\n")
    put(tmp_path, "none.csv", "")
    put(tmp_path, "narrow.csv", "a\n1\n")
    (tmp_path / "broken.csv").write_bytes(b"a,b\n\xff\xfe,2\n")
    landing = land_long(spark, str(tmp_path), threshold=2)
    assert {(r.file_name, r.error) for r in landing.errors.collect()} == {
        ("none.csv", "File is empty."),
        ("narrow.csv", "Could not find header row."),
        ("broken.csv", "File is not valid in its encoding."),
    }
    assert {r[0] for r in cells_of(landing)} == {"good.csv", "broken.csv"}


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "utf-8-sig", "utf-8", "utf-16-le", "utf-16-be"])
def test_encodings_and_line_ends(spark, tmp_path, encoding):
    text = "næme,b\r\né,ÿ£\r\n\"x,y\",2\r\n" + ("€,œ\r\n" if encoding not in ("latin-1",) else "")
    put(tmp_path, "x.csv", text, encoding)
    name = {"utf-16-le": "utf-16le", "utf-16-be": "utf-16be"}.get(encoding, encoding)
    got = cells_of(land_long(spark, str(tmp_path), dialect=CsvDialect(encoding=name), threshold=2))
    want = [("næme", "é"), ("b", "ÿ£"), ("næme", "x,y"), ("b", "2")] + ([("næme", "€"), ("b", "œ")] if encoding != "latin-1" else [])
    assert [r[3:] for r in got] == want


def test_shuffled_join_gives_the_same(spark, tmp_path, small_splits, monkeypatch):
    """Beyond the broadcast limit the small tables are joined by shuffling, salted."""
    from longform.sources import storage

    odd_files(tmp_path, files=8)
    first = cells_of(land_long(spark, str(tmp_path), threshold=4))
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 1)
    landing = land_long(spark, str(tmp_path), threshold=4)
    # the planner may still broadcast by its own check of size; forbid that, too
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert cells_of(landing) == first
        assert "BroadcastHashJoin" not in landing.cells._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encoding_and_options(spark, tmp_path):
    put(tmp_path, "latin.csv", "naïve;b;c\n1;'x;y';3\n", "iso-8859-1")
    dialect = CsvDialect(delimiter=";", quotechar="'", encoding="ISO-8859-1")
    want = expected(tmp_path, 3, encoding="iso-8859-1", delimiter=";", quotechar="'")
    assert cells_of(land_long(spark, str(tmp_path), dialect, threshold=3)) == want


def test_utf16(spark, tmp_path):
    put(tmp_path, "wide.csv", "ä,b\n1,2\n3,4\n", "utf-16-le")
    got = cells_of(land_long(spark, str(tmp_path), CsvDialect(encoding="UTF-16LE"), threshold=2))
    assert got == expected(tmp_path, 2, encoding="utf-16-le")


def test_folder_named_like_a_file(spark, tmp_path):
    put(tmp_path, "vendor_a one+two.csv/part-00000.csv", "a,b\n1,2\n")
    put(tmp_path, "vendor_a one+two.csv/_SUCCESS", "")
    put(tmp_path, "vendor_abc.csv", "a,b\n1,2\n")
    put(tmp_path, "other.csv", "a,b\n1,2\n")
    rows = land_long(spark, str(tmp_path), threshold=2).cells.select("file_name", "vendor_id").distinct().collect()
    assert {tuple(r) for r in rows} == {
        ("vendor_a one+two.csv", "vendor_a"),
        ("vendor_abc.csv", "vendor_a"),
        ("other.csv", "unknown"),
    }


def test_threshold_by_vendor(spark, tmp_path):
    text = "x,y\na,b,c\n1,2,3\n"
    put(tmp_path, "vendor_a.csv", text)
    put(tmp_path, "vendor_b.csv", text)
    found = land_long(spark, str(tmp_path), threshold={"vendor_a": 3, "vendor_b": 2}).headers
    assert {(r.vendor_id, r.header_line_no) for r in found.collect()} == {("vendor_a", 1), ("vendor_b", 0)}


def test_fixed_schema_and_one_timestamp(spark, tmp_path):
    put(tmp_path, "vendor_a.csv", "a,b\n1,\n2,3\n")
    when = dt.datetime(2024, 5, 6, 7, 8, 9)
    bronze = conform_bronze(land_long(spark, str(tmp_path), threshold=2, ingested_at=when).cells)
    assert [(f.name, f.dataType) for f in bronze.schema] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]
    assert not bronze.schema["file_name"].nullable and bronze.schema["lab_provided_value"].nullable
    assert {r.ingestion_timestamp for r in bronze.collect()} == {when}


def test_fixed_schema_refuses_nulls(spark, tmp_path):
    put(tmp_path, "vendor_a.csv", "a,b\n1,2\n")
    cells = land_long(spark, str(tmp_path), threshold=2).cells.withColumn("vendor_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="vendor_id must not be null"):
        conform_bronze(cells).collect()


def test_grid_keeps_blank_lines_and_widths(spark, tmp_path):
    put(tmp_path, "g.csv", 'a,"",c\n\n,,\n" ",x\n')
    rows = [(r.line_no, r.n_tokens, list(r.cells)) for r in read_grid(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert rows == [(0, 3, ["a", None, "c"]), (1, 0, []), (2, 3, [None] * 3), (3, 2, [" ", "x"])]


def test_wide_landing(spark, tmp_path):
    put(tmp_path, "vendor_a.csv", "meta\nsampl_barcode,lab_id,date_recieved,date_proccessed,ph,,zinc_ppm\n1,2,3,4,5,,7\n")
    put(tmp_path, "vendor_b.csv", "sample-barcode,#lab_id,date-received,date-processed,acidity,cu-total,zn-total\n8,9,10,11,12,13\n")
    superset = ["sample_barcode", "lab_id", "date_received", "date_processed", "ph", "copper_ppm", "zinc_ppm", "lead_ppm"]
    wide = land_wide(spark, str(tmp_path), superset, {"vendor_b": VENDOR_B_RENAMES})
    rows = {r.file_name: [r[c] for c in superset] for r in wide.collect()}
    assert rows == {
        "vendor_a.csv": ["1", "2", "3", "4", "5", None, "7", None],
        "vendor_b.csv": ["8", "9", "10", "11", "12", "13", None, None],
    }


def test_wide_landing_by_threshold(spark, tmp_path):
    """With a threshold, a fuller row below the header does not pass for one."""
    put(tmp_path, "vendor_a.csv", "meta\na,b,,d\n1,2,junk,4\n")
    wide = land_wide(spark, str(tmp_path), ["a", "b", "d"], {}, threshold=3)
    assert [tuple(r) for r in wide.select("a", "b", "d").collect()] == [("1", "2", "4")]


def test_folder_without_lines(spark, tmp_path):
    put(tmp_path, "vendor_a none.csv", "")
    landing = land_long(spark, str(tmp_path), threshold=2)
    assert landing.cells.isEmpty() and landing.headers.isEmpty()
    assert [(r.file_name, r.error) for r in landing.errors.collect()] == [("vendor_a none.csv", "File is empty.")]


def test_empty_files_with_odd_names(spark, tmp_path):
    names = ["a b.csv", "c%20d.csv", "e+f#g.csv", "h é.csv", "i?j.csv"]
    for name in names:
        put(tmp_path, f"vendor_a {name}", "")
        put(tmp_path, f"vendor_b {name}", "a,b\n1,2\n")
    landing = land_long(spark, str(tmp_path), threshold=2)
    assert sorted(r.file_name for r in landing.errors.collect()) == sorted(f"vendor_a {n}" for n in names)
    assert landing.cells.count() == 2 * len(names)


def test_folder_without_files(spark, tmp_path):
    landing = land_long(spark, str(tmp_path), threshold=2)
    assert landing.cells.isEmpty() and landing.headers.isEmpty() and landing.errors.isEmpty()


def test_nothing_but_an_empty_table_is_observed(spark):
    from longform.sources.storage import settle

    empty = settle(spark.range(5).filter("false"), "empty")
    assert empty.fits and empty.df.count() == 0


def test_wide_files_that_do_not_land_are_told(spark, tmp_path):
    put(tmp_path, "vendor_a_good.csv", "a,b,c\n1,2,3\n")
    put(tmp_path, "vendor_a_blank.csv", "\n" * 12 + "a,b,c\n1,2,3\n")
    put(tmp_path, "vendor_a_none.csv", "")
    told = lambda **o: {(r.file_name, r.error) for r in wide_errors(spark, str(tmp_path), **o).collect()}
    none = ("vendor_a_none.csv", "File is empty.")
    assert told() == {("vendor_a_blank.csv", "Could not find header row."), none}
    assert told(threshold=4) == {(f"vendor_a_{n}.csv", "Could not find header row.") for n in ("good", "blank")} | {none}


def test_wide_rows_and_errors_of_one_landing(spark, tmp_path):
    put(tmp_path, "vendor_a 1.csv", "a,b\n1,2\n")
    put(tmp_path, "none.csv", "\n\n")
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "open.csv", 'a,b\n3,"4\n')
    landing = land_wide_files(spark, str(tmp_path), ["a", "b"], {})
    assert sorted((r.file_name, r.a) for r in landing.rows.collect()) == [("open.csv", "3"), ("vendor_a 1.csv", "1")]
    told = {(r.file_id, r.error) for r in landing.errors.collect()}
    assert told == {(r.file_id, r.error) for r in wide_errors(spark, str(tmp_path)).collect()} and len(told) == 3


def test_wide_loads_appended_to_a_table(spark, tmp_path):
    put(tmp_path / "one", "a.csv", "a,b\n1,2\n")
    put(tmp_path / "two", "b.csv", "b,c\n5,6\n")
    put(tmp_path / "two", "none.csv", "\n")
    name = "longform_wide_test_" + tmp_path.name.replace("-", "_")
    assert append_wide(spark, str(tmp_path / "one"), name, ["a", "b"], {}).isEmpty()
    errors = append_wide(spark, str(tmp_path / "two"), name, ["b", "c"], {})
    assert errors.count() == 1
    assert sorted(map(str, ((r.a, r.b, r.c) for r in spark.table(name).collect()))) == ["('1', '2', None)", "(None, '5', '6')"]
    spark.sql(f"DROP TABLE {name}")
