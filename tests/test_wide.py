from pyspark.sql import functions as F

from longform.functions import names as N
from longform.operators import checks as K, wide as W

TYPOS = {
    "sampl_barcode": "sample_barcode",
    "sample_barcod": "sample_barcode",
    "sampl_barcod": "sample_barcod",
    "date_recieved": "date_received",
    "Date_Recieved": "Date_Recieved",
    "date_proccessed": "date_processed",
    "Sampl_Barcode": "Sampl_Barcode",
    "ph": "ph",
}
CHARACTERS = {"#lab_id": "lab_id", "organic_matter%": "organic_matter_pct", "cu-total": "cu_total", "ph": "ph"}


def test_names_known_and_unknown_agree(spark):
    for table, known, expr in ((TYPOS, W.repaired_name, N.repair_typos), (CHARACTERS, W.sanitized_name, N.sanitize)):
        df = spark.createDataFrame([(n,) for n in table], "n string")
        assert {r.n: r.m for r in df.select("n", expr(F.col("n")).alias("m")).collect()} == table
        assert {n: known(n) for n in table} == table


def test_renames_keep_values(spark):
    df = spark.createDataFrame([("1", "2")], "`cu-total` string, `#a.b` string")
    assert W.sanitize_names(df).first().asDict() == {"cu_total": "1", "a.b": "2"}


def test_superset_union_sorts_and_keeps_duplicates(spark):
    a = spark.createDataFrame([("1", "2")], "b string, a string")
    c = spark.createDataFrame([("3",)], "c string")
    out = W.superset_union(a, c, c)
    assert out.columns == ["a", "b", "c"] and out.count() == 3


def test_align_drops_and_adds(spark):
    df = spark.createDataFrame([("1", "2")], "a string, extra string")
    out = W.align_superset(df, ["z", "a"])
    assert out.columns == ["z", "a"] and out.first() == (None, "1")


def test_empty_columns_go_in_one_job(spark):
    df = spark.createDataFrame([("1", "", None, "x"), ("", "", None, None)], "a string, b string, c string, ` ` string")
    assert W.remove_empty_columns(df).columns == ["a"]


def test_dispatch(spark):
    a = spark.createDataFrame([("1",)], "ph string")
    b = spark.createDataFrame([("2", "x")], "acidity string, dropped string")
    out = W.vendor_dispatch({"vendor_a": a, "vendor_b": b}, {"vendor_b": {"acidity": "ph"}})
    assert sorted(tuple(r) for r in out.select("ph", "vendor_id").collect()) == [("1", "vendor_a"), ("2", "vendor_b")]


def test_identifier_formats(spark):
    assert N.id_pattern("PYB", 14, 7) == "^PYB[0-9]{4}-[0-9]{6}$"
    assert N.id_pattern("PSL-", 12, 6, " ") == "^PSL-[0-9]{2} [0-9]{5}$"
    ids = spark.createDataFrame([("PYB6134-404166",), ("PYB613-4404166",), (None,)], "i string")
    assert tuple(K.id_format_check(ids, "i", "PYB", 14, 7).first()) == (1, 1, 1)


def test_defects(spark):
    df = spark.createDataFrame([("Sampl_Barcode",), (" ph",), ("cu-total",), ("laboratory",)], "lab_provided_attribute string")
    rows = {r.lab_provided_attribute: r for r in K.header_defects(df).collect()}
    assert rows["Sampl_Barcode"].has_typo and rows["Sampl_Barcode"].has_casing
    assert rows[" ph"].has_outer_whitespace and not rows[" ph"].has_inner_whitespace
    assert rows["cu-total"].has_bad_character and not rows["laboratory"].has_typo


def test_packages_by_table_and_dictionary(spark):
    cells = spark.createDataFrame(
        [("f", "ph"), ("f", "copper_ppm"), ("f", "ph"), ("g", "ph")], "file_name string, lab_provided_attribute string"
    )
    packages = {"p": ("ph", "copper_ppm"), "q": ("ph",)}
    table = spark.createDataFrame([(p, m) for p, ms in packages.items() for m in ms], "package string, lab_provided_attribute string")
    want = [("f", "p"), ("f", "q"), ("g", "q")]
    assert sorted(map(tuple, K.package_detection(cells, packages).collect())) == want
    assert sorted(map(tuple, K.package_detection_from_table(cells, table).select("file_name", "package").collect())) == want
