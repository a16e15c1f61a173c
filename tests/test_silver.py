import hashlib

import pytest
from pyspark.sql import functions as F

from longform.functions import values as V
from longform.operators import reports, silver as Z
from longform.plans.gold import star_schema
from longform.sources import reference_data as R

CELLS = (
    "vendor_id string, file_name string, row_index bigint, lab_provided_attribute string, lab_provided_value string"
)


def cells(spark, *rows):
    return spark.createDataFrame([(v, f"{v}.csv", i, a, x) for v, i, a, x in rows], CELLS)


@pytest.fixture
def sample(spark):
    return cells(
        spark,
        ("vendor_a", 1, "ph", "6.5"),
        ("vendor_a", 1, " ph", "6.5"),
        ("vendor_a", 1, "Copper_Ppm", "1"),
        ("vendor_a", 1, "sample_barcode", "PYB1"),
        ("vendor_a", 2, "ph", "high"),
        ("vendor_b", 1, "acidity", "136."),
        ("vendor_b", 1, "sample_barcod", "PYB2"),
        ("vendor_b", 1, "date_received", "2024-01-01"),
        ("vendor_b", 1, "ph", "7"),
    )


def silver(spark, df):
    return Z.standardize(df, R.vendor_column_mapping(spark), R.canonical_column_definitions(spark))


def test_reference_tables(spark):
    canonical, mapping = R.canonical_column_definitions(spark), R.vendor_column_mapping(spark)
    assert canonical.count() == 15 and mapping.count() == 27
    assert {r["canonical_column_name"]: r["canonical_column_id"] for r in canonical.collect()}["ph"] == "3a11665f"
    assert mapping.filter("vendor_id = 'vendor_a'").count() == 13
    assert mapping.filter("notes like '%''acidity''%'").count() == 1
    assert Z.mapping_integrity(mapping, canonical).isEmpty()
    synonyms = {r.canonical_column_id: r.name_count for r in Z.mapping_synonyms(mapping).collect()}
    assert synonyms[R.key_of("col_ph")] == 2 and synonyms[R.key_of("col_sample_barcode")] == 3


def test_integrity_finds_each_problem(spark):
    mapping = spark.createDataFrame(
        [("a", "x", "1"), ("a", "x", "2"), ("b", "x", "9")], "vendor_id string, vendor_column_name string, canonical_column_id string"
    )
    canonical = spark.createDataFrame([("1",), ("2",), ("2",)], "canonical_column_id string")
    found = {(r.problem, r.key, r.occurrences) for r in Z.mapping_integrity(mapping, canonical).collect()}
    assert found == {("duplicate_canonical", "2", 2), ("duplicate_mapping", "a|x", 2), ("dangling_mapping", "9", 1)}


def test_keys(spark):
    row = spark.range(1).select(
        V.surrogate_key(F.lit("col_ph")).alias("one"),
        V.surrogate_key(F.lit("vendor_a"), F.lit("ph")).alias("two"),
        V.surrogate_key(F.lit(None).cast("string"), F.lit("x")).alias("null_part"),
    ).first()
    assert (row.one, row.two) == ("3a11665f", "a9079c26")
    assert row.null_part == hashlib.sha256(b"|x").hexdigest()[:8]
    assert V.clip is not None and R.key_of("vendor_a", "ph") == row.two


def test_mapping_is_exact(spark, sample):
    out = {(r.vendor_id, r.row_index, r.lab_provided_attribute): r.canonical_column_name for r in silver(spark, sample).collect()}
    assert out == {
        ("vendor_a", 1, "ph"): "ph",
        ("vendor_a", 1, " ph"): None,
        ("vendor_a", 1, "Copper_Ppm"): None,
        ("vendor_a", 1, "sample_barcode"): "sample_barcode",
        ("vendor_a", 2, "ph"): "ph",
        ("vendor_b", 1, "acidity"): "ph",
        ("vendor_b", 1, "sample_barcod"): "sample_barcode",
        ("vendor_b", 1, "date_received"): None,
        ("vendor_b", 1, "ph"): None,
    }


def test_sql_text_agrees(spark, sample):
    sql = Z.standardize_sql(spark, sample, R.vendor_column_mapping(spark), R.canonical_column_definitions(spark))
    assert sorted(map(str, sql.collect())) == sorted(map(str, silver(spark, sample).select(sql.columns).collect()))


def test_salted_join_agrees(spark, sample, monkeypatch):
    from longform.sources import storage

    want = sorted(map(str, silver(spark, sample).collect()))
    monkeypatch.setattr(storage, "BROADCAST_BYTES", 1)
    salted = silver(spark, sample)
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(str, salted.collect())) == want


def test_duplicate_mapping_repeats_cells(spark, sample):
    twice = R.vendor_column_mapping(spark).unionAll(R.vendor_column_mapping(spark).filter("vendor_column_name = 'ph'"))
    out = Z.standardize(sample, twice, R.canonical_column_definitions(spark))
    assert out.count() == sample.count() + 2


def test_vendorless_join_reaches_other_vendors(spark, sample):
    out = Z.standardize_by_attribute(sample, R.vendor_column_mapping(spark), R.canonical_column_definitions(spark))
    assert out.filter("vendor_id = 'vendor_b' and lab_provided_attribute = 'ph'").first().canonical_column_name == "ph"


def test_numeric_value_and_coverage(spark, sample):
    rows = Z.with_numeric_value(silver(spark, sample)).collect()
    numbers = {(r.vendor_id, r.row_index, r.lab_provided_attribute): r.numeric_value for r in rows}
    assert numbers[("vendor_b", 1, "acidity")] == 136.0
    assert numbers[("vendor_a", 2, "ph")] is None and numbers[("vendor_a", 1, "sample_barcode")] is None
    coverage = [tuple(r) for r in reports.mapping_coverage(silver(spark, sample)).collect()]
    assert coverage == [("vendor_a", 5, 3, 2), ("vendor_b", 4, 2, 2)]
    usage = [tuple(r) for r in reports.canonical_usage(silver(spark, sample)).collect()]
    assert usage == [("ph", "measurement", 2, 3), ("sample_barcode", "sample_identifier", 2, 2)]


def test_star_schema_keys_join(spark, sample):
    star = star_schema(silver(spark, sample), ["sample_barcode"])
    assert star.samples.count() == 2
    facts = star.measurements.join(star.samples, "sample_key", "left").collect()
    assert sorted((r.sample_barcode or "", r.value or -1.0) for r in facts) == [("", -1.0), ("PYB1", 6.5), ("PYB2", 136.0)]


def test_typed_flags_junk_as_null(spark):
    raw = spark.createDataFrame([("2024-01-02", "136."), ("02/01/2024", "n/a"), (None, None)], "d string, x string")
    rows = Z.typed(raw, ["d"], ["x"]).collect()
    assert [(str(r.d), r.x) for r in rows] == [("2024-01-02", 136.0), ("None", None), ("None", None)]


@pytest.mark.parametrize("x, n, want", [(0.001234, 3, 0.00123), (136.4, 3, 136.0), (0.0, 3, 0.0), (None, 2, None), (-98765.0, 2, -99000.0)])
def test_significant_figures(spark, x, n, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(V.round_significant("x", n).alias("y")).first().y == want
