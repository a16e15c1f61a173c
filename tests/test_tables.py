import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from longform.operators import provenance as P
from longform.plans.medallion import clean_medallion, long_medallion
from longform.sources import reference_data as R, tables as S
from longform.streaming.incremental import landed, new_files, stream_long

HEADER = "sample_barcode,lab_id,date_received,date_processed,ph,copper_ppm,zinc_ppm\n"


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as handle:
        handle.write(text)


def test_clean_medallion(spark, tmp_path):
    rows = [
        "PYB1,PSL-1,2024-01-02,2024-01-09,6.33,5.0,10.0",
        "PYB2,PSL-1,2024-01-30,2024-02-09,6.35,6.03,11.09",
        "PYB3,PSL-1,2024-03-30,2024-04-09,7.,n/a,1",
    ]
    write(tmp_path, "vendor_a_basic_clean.csv", HEADER + "\n".join(rows) + "\n")
    gold = clean_medallion(spark, str(tmp_path / "vendor_a_basic_clean.csv"), "vendor_a").collect()
    assert [str(r.month_start)[:7] for r in gold] == ["2024-01", "2024-03"]
    first = gold[0]
    assert first.vendor_name == "vendor_a" and first.sample_count == 2
    assert (round(first.avg_ph, 4), first.min_ph, first.max_ph) == (6.34, 6.33, 6.35)
    assert round(first.avg_copper_ppm, 4) == 5.515 and round(first.avg_zinc_ppm, 4) == 10.545
    assert gold[1].stddev_ph is None and gold[1].avg_copper_ppm is None
    raw = spark.table("bronze.vendor_a_samples_raw")
    assert {r.source_file_name for r in raw.collect()} == {"vendor_a_basic_clean.csv"}
    assert raw.select("ingestion_id").distinct().count() == 1
    silver = spark.table("silver.vendor_a_samples_cleaned")
    assert dict(silver.dtypes)["date_received"] == "date" and dict(silver.dtypes)["ph"] == "double"
    assert "databricks_ingestion_metadata" in silver.columns


def test_long_medallion(spark, tmp_path):
    write(tmp_path, "vendor_a_x.csv", "Lab report,,\n" + HEADER + "PYB1,PSL-1,2024-01-02,2024-01-09,6.33,5.0,\n")
    write(tmp_path, "vendor_b_x.csv", HEADER.replace("ph,", "acidity,") + "PYB2,AT1,2024-01-02,2024-01-09,6.4,5.0,1\n")
    write(tmp_path, "vendor_b_broken.csv", "nothing,here\n")
    landing = long_medallion(spark, str(tmp_path), R.vendor_column_mapping(spark), R.canonical_column_definitions(spark))
    assert [r.file_name for r in landing.errors.collect()] == ["vendor_b_broken.csv"]
    silver = spark.table("silver.lab_samples_standardized")
    ph = silver.filter("canonical_column_name = 'ph'").select("vendor_id", "lab_provided_value").collect()
    assert sorted(map(tuple, ph)) == [("vendor_a", "6.33"), ("vendor_b", "6.4")]
    assert silver.count() == 14
    # one vendor's report reads one vendor's folder
    plan = silver.filter("vendor_id = 'vendor_a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(vendor_id" in plan
    # a second run replaces the tables
    long_medallion(spark, str(tmp_path), R.vendor_column_mapping(spark), R.canonical_column_definitions(spark))
    assert spark.table("bronze.lab_samples_unpivoted").count() == 14


def test_part_files_are_numbered_on(spark, tmp_path):
    folder = tmp_path / "vendor_a y.csv"
    for part, rows in enumerate([["PYB1", "PYB2"], ["PYB3"], ["PYB4", "PYB5"]]):
        write(folder, f"part-0000{part}.csv", HEADER + "".join(f"{name},PSL,2024-01-02,2024-01-09,6.3,5,1\n" for name in rows))
    write(tmp_path, "vendor_b z.csv", HEADER + "PYB6,PSL,2024-01-02,2024-01-09,6.3,5,1\n")
    write(folder, "part-00003.csv", "")
    names = {"bronze": "bronze.numbered_parts", "silver": "silver.numbered_parts"}
    landing = long_medallion(spark, str(tmp_path), R.vendor_column_mapping(spark), R.canonical_column_definitions(spark), **names)
    assert [(r.file_name, r.error) for r in landing.errors.collect()] == [("vendor_a y.csv", "File is empty.")]
    bronze = spark.table("bronze.numbered_parts").filter("lab_provided_attribute = 'sample_barcode'")
    got = {(r.file_name, r.row_index): r.lab_provided_value for r in bronze.collect()}
    assert got == {("vendor_a y.csv", i): f"PYB{i}" for i in range(1, 6)} | {("vendor_b z.csv", 1): "PYB6"}


def test_row_numbers_of_split_csv(spark, tmp_path, small_splits):
    write(tmp_path, "a.csv", "i,t\n" + "".join(f"{i},row\n" for i in range(1, 301)))
    write(tmp_path, "b.csv", "i,t\n" + "".join(f"{i},row\n" for i in range(1, 51)))
    numbered = P.with_file_row_number(S.read_csv_text(spark, str(tmp_path)))
    assert numbered.columns == ["i", "t", "file_row_number"]
    assert numbered.count() == 350 and numbered.filter("i <> file_row_number").isEmpty()


def test_append_with_merged_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    S.append_path(spark.createDataFrame([("1", "2")], "a string, b string"), path)
    S.append_path(spark.createDataFrame([("3", "4")], "a string, c string"), path)
    assert sorted((r.a, r.b, r.c) for r in S.read_merged(spark, path).collect()) == [("1", "2", None), ("3", None, "4")]


def test_csv_sink_single_file(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    S.write_csv(spark.range(100).repartition(4), path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    assert S.read_csv_text(spark, path).count() == 100


def test_stream_lands_each_file_once(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    run = lambda: stream_long(spark, source, out, ckpt, threshold=2).awaitTermination()
    write(source, "vendor_a_1.csv", "meta\na,b\n1,\"x\ny\"\n")
    write(source, "bad.csv", "one\n")
    run()
    run()
    assert sorted((r.file_name, r.row_index, r.lab_provided_value) for r in landed(spark, out).collect()) == [
        ("vendor_a_1.csv", 1, "1"),
        ("vendor_a_1.csv", 1, "x\ny"),
    ]
    write(source, "vendor_b_1.csv", "a,b\n3,4\n")
    run()
    rows = landed(spark, out)
    assert rows.count() == 4 and rows.filter("file_name = 'vendor_b_1.csv'").count() == 2
    assert [r.file_name for r in spark.read.parquet(out + "/errors").collect()] == ["bad.csv"]


def test_ledger(spark):
    files = spark.createDataFrame([("a",), ("b",)], "file_id string")
    ledger = spark.createDataFrame([("a",), ("a",)], "file_id string")
    assert [r.file_id for r in new_files(files, ledger).collect()] == ["b"]


def test_audit_joins_back(spark):
    cells = spark.createDataFrame(
        [("v", "f", 1, "a", "x"), ("v", "f", 1, "b", None), ("v", "f", 2, "a", "y"), ("v", "g", 1, "a", "z")],
        "vendor_id string, file_name string, row_index int, lab_provided_attribute string, lab_provided_value string",
    )
    audit = P.ingestion_audit(cells, "run")
    rows = {r.file_name: (r.cell_count, r.null_cells, r.attribute_count, r.row_count) for r in audit.collect()}
    assert rows == {"f": (3, 1, 2, 2), "g": (1, 0, 1, 1)}
    joined = P.with_batch_id(cells, "run").join(audit.select("batch_id", F.col("file_name").alias("g")), "batch_id")
    assert joined.count() == 4 and joined.filter("file_name <> g").isEmpty()


def test_files_of_one_name_stay_apart(spark, tmp_path):
    """Part files of a folder, and one name in two folders, are files of their own in the audit and the star."""
    from longform.operators.silver import standardize
    from longform.plans.bronze import land_long
    from longform.plans.gold import star_schema

    for i, place in enumerate(["one/vendor_a.csv/part-0.csv", "one/vendor_a.csv/part-1.csv", "two/vendor_a.csv"]):
        path = tmp_path / place
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("sample_barcode,ph\n" + "".join(f"b{i}{k},{i}.{k}\n" for k in range(3)))
    cells = land_long(spark, str(tmp_path), threshold=2).cells
    mapping = spark.createDataFrame([("vendor_a", "sample_barcode", "s"), ("vendor_a", "ph", "p")], "vendor_id string, vendor_column_name string, canonical_column_id string")
    canonical = spark.createDataFrame([("s", "barcode", "sample", "string"), ("p", "ph", "measurement", "numeric")], "canonical_column_id string, canonical_column_name string, column_category string, data_type string")
    audit = P.ingestion_audit(cells, "run").collect()
    assert len(audit) == 3 and len({r.batch_id for r in audit}) == 3 and {r.cell_count for r in audit} == {6}
    star = star_schema(standardize(cells, mapping, canonical), ["barcode"])
    joined = star.measurements.join(star.samples, "sample_key").select("barcode", "value").collect()
    assert {(r.barcode, r.value) for r in joined} == {(f"b{i}{k}", float(f"{i}.{k}")) for i in range(3) for k in range(3)}


def test_append_to_a_table(spark):
    name = "longform_append_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    S.append_table(spark.createDataFrame([(1, "a")], "k bigint, v string"), name)
    S.append_table(spark.createDataFrame([("b", 2)], "v string, k bigint"), name)
    with pytest.raises(ValueError):
        S.append_table(spark.createDataFrame([("x", "b")], "k string, v string"), name)
    with pytest.raises(ValueError):
        S.append_table(spark.createDataFrame([(3, "c", 1.0)], "k bigint, v string, w double"), name)
    S.append_table(spark.createDataFrame([(3, 1.0)], "k bigint, w double"), name, merge_schema=True)
    assert sorted(tuple(r) for r in spark.table(name).select("k", "v", "w").collect()) == [(1, "a", None), (2, "b", None), (3, None, 1.0)]
    spark.sql(f"DROP TABLE {name}")


PARTITIONED = """
import sys
from pyspark.sql import SparkSession, functions as F
from longform.sources.tables import overwrite_table
base = sys.argv[1]
options = {"eventLog.enabled": "true", "eventLog.dir": base + "/log", "eventLog.rolling.enabled": "false", "eventLog.compress": "false", "ui.enabled": "false", "sql.warehouse.dir": base + "/warehouse"}
builder = SparkSession.builder.master("local[2]")
for key, value in options.items():
    builder = builder.config("spark." + key, value)
spark = builder.getOrCreate()
rows = spark.range(400000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), (F.col("id") % 3).cast("string"))).alias("vendor"))
overwrite_table(rows, "cells", partition_by=("vendor",), path=base + "/table")
assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) is None
got = {r.vendor: (r.n, r.s) for r in spark.table("cells").groupBy("vendor").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()}
ids = {None: range(0, 400000, 3), "v1": range(1, 400000, 3), "v2": range(2, 400000, 3)}
assert got == {v: (len(r), sum(r)) for v, r in ids.items()}
many = rows.withColumn("vendor", F.col("id") % 100)
overwrite_table(many, "more", partition_by=("vendor",), path=base + "/more")
got = {r.vendor: r.s for r in spark.table("more").groupBy("vendor").agg(F.sum("id").alias("s")).collect()}
assert got == {v: sum(range(v, 400000, 100)) for v in range(100)}
spark.stop()
"""


def test_partitioned_writes_hold_no_rows(tmp_path):
    """The tasks that write a few folders need no memory for sorting, however many rows they have; any number of folders is whole."""
    (tmp_path / "log").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])}
    subprocess.run([sys.executable, "-c", PARTITIONED, str(tmp_path)], cwd=tmp_path, env=env, check=True)
    peaks = {}
    for log in (tmp_path / "log").iterdir():
        for event in map(json.loads, log.read_text().splitlines()):
            if event["Event"] == "SparkListenerTaskEnd":
                peaks.setdefault(event["Stage ID"], []).append(event["Task Metrics"]["Peak Execution Memory"])
    assert peaks and max(peaks[min(peaks)]) < 1 << 16
