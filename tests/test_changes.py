"""Mapping changes, file checksums and joins with hot keys."""

import glob
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from longform.operators.silver import standardize
from longform.plans.mapping_changes import SilverTable, latest_version, mapping_changes, save_version
from longform.sources.checksums import BASES, PRIME, file_checksums, power

MAPPING = "vendor_id string, vendor_column_name string, canonical_column_id string, notes string"
CANONICAL = "canonical_column_id string, canonical_column_name string, column_category string, data_type string, description string"
CELLS = "vendor_id string, file_name string, row_index int, lab_provided_attribute string, lab_provided_value string"


@pytest.fixture
def tables(spark):
    mapping = lambda *rows: spark.createDataFrame([(*r, "") for r in rows], MAPPING)
    canonical = lambda *rows: spark.createDataFrame([(*r, "c", "numeric", "") for r in rows], CANONICAL)
    return mapping, canonical


ONE = [("a", "ph", "1"), ("a", "cu", "2"), ("a", "zn", "3"), ("b", "ph", "1"), ("b", "7", "2"), ("b", "x=y/z", "3")]
NAMES = [("1", "ph"), ("2", "copper"), ("3", "zinc")]


def test_changes_by_key(tables):
    mapping, canonical = tables
    two = [("a", "ph", "1"), ("a", "cu", "3"), ("a", "zn", "3"), ("a", "zn", "3"), ("b", "ph", "1"), ("b", "7", "2"), ("c", "ph", "1")]
    got = mapping_changes((mapping(*ONE), canonical(*NAMES)), (mapping(*two), canonical(("1", "ph"), ("2", "Cu"), ("3", "zinc"))))
    found = {(r.vendor_id, r.lab_provided_attribute): r.change for r in got.collect()}
    assert found == {("a", "cu"): "changed", ("a", "zn"): "changed", ("b", "x=y/z"): "gone", ("b", "7"): "changed", ("c", "ph"): "new"}
    same = (mapping(*ONE), canonical(*NAMES))
    assert mapping_changes(same, same).isEmpty()


def test_only_changed_folders_are_written(spark, tables, tmp_path):
    mapping, canonical = tables
    cells = [(v, f"{v}.csv", i, a, str(i)) for v, a in [*[m[:2] for m in ONE], ("b", "new"), ("c", "ph")] for i in range(5)]
    cells = spark.createDataFrame(cells, CELLS)
    store, path = str(tmp_path / "mapping"), str(tmp_path / "silver")
    silver = SilverTable(spark, path)
    save_version(spark, store, mapping(*ONE), canonical(*NAMES))
    assert silver.refresh(cells, store).count() == 8 and silver.refresh(cells, store) is None
    files = lambda: set(glob.glob(f"{path}/**/*.parquet", recursive=True))
    rows = lambda df: sorted(map(str, df.select(sorted(df.columns)).collect()))
    before = files()
    two = [("a", "ph", "1"), ("a", "cu", "3"), ("a", "zn", "3"), ("a", "zn", "3"), ("b", "ph", "1"), ("b", "7", "2"), ("b", "new", "2")]
    new = (mapping(*two), canonical(*NAMES))
    assert save_version(spark, store, *new) == 2 == latest_version(spark, store)
    silver.refresh(cells, store)
    assert rows(silver.read(cells)) == rows(standardize(cells, *new))
    kept = {os.path.dirname(f) for f in before & files()}
    assert len(kept) == 4 and len(before - files()) == 4  # a/ph, b/ph, b/7 and c/ph stay
    # a refresh that failed before its note runs again
    for left in glob.glob(f"{path}-notes/*000001.json*", include_hidden=True):
        os.remove(left)
    assert silver.version() == 1
    silver.refresh(cells, store)
    assert silver.version() == 2 and rows(silver.read(cells)) == rows(standardize(cells, *new))


def checksum(data: bytes):
    lines = data.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    halves = []
    for half in (0, 1):
        total = 0
        for line in reversed(lines):
            total = (total * BASES[half] + int(hashlib.md5(line).hexdigest()[7 * half : 7 * half + 7], 16)) % PRIME
        halves.append(f"{total:08x}")
    return len(data), len(lines), data.endswith(b"\n"), "".join(halves)


def test_checksums_equal_one_pass_whatever_the_splits(spark, conf, tmp_path):
    rng = random.Random(3)
    files = {
        "a.csv": b"".join(bytes(rng.choice(b"abc,\r\xe9") for _ in range(rng.randint(0, 60))) + b"\n" for _ in range(300)),
        "b.csv": b"one line without an end",
        "c.csv": b"\n\n\nx",
        "d 1.csv": "é,ü\r\n".encode() * 90,
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    (tmp_path / "empty.csv").write_bytes(b"")
    want = {n: checksum(d) for n, d in files.items()}
    for size in ("128m", "777", "64"):
        conf("spark.sql.files.maxPartitionBytes", size)
        conf("spark.sql.files.openCostInBytes", "1")
        rows = file_checksums(spark, str(tmp_path)).collect()
        assert {r.file_name: (r.file_size, r.line_count, r.ends_in_break, r.checksum) for r in rows} == want
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfx\ny\n")
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfx\ny")
    rows = {r.file_name: r for r in file_checksums(spark, str(tmp_path)).collect()}
    assert (rows["a.csv"].file_size, rows["a.csv"].ends_in_break, rows["b.csv"].ends_in_break) == (7, True, False)
    assert rows["a.csv"].checksum == rows["b.csv"].checksum == checksum(b"x\ny\n")[3]


def test_powers(spark):
    exponents = [0, 1, 2047, 2048, 2**21, 2**31 - 3, -1, -2048, -(10**9), 10**12]
    for base in BASES:
        got = spark.createDataFrame([(e,) for e in exponents], "e long").select(power(base, F.col("e")).alias("p")).collect()
        assert [r.p for r in got] == [pow(base, e % (PRIME - 1), PRIME) for e in exponents]


@pytest.fixture
def no_broadcast(conf, monkeypatch):
    from longform.operators import silver
    from longform.sources import storage

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    for module in (storage, silver):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)


def test_hot_keys_spread_without_a_broadcast(spark, tables, no_broadcast):
    """One key has 90 % of the rows, nulls have 5 %: both forms of the join deal them evenly and lose nothing."""
    from longform.operators.silver import standardize_sql
    from longform.sources.storage import deal_hot, hot_keys

    mapping, canonical = tables
    keys = ["lab_provided_attribute", "vendor_id"]
    attribute = F.when(F.col("id") % 20 < 18, "ph").when(F.col("id") % 20 == 18, None).otherwise(F.concat(F.lit("n"), F.col("id") % 997))
    cells = spark.range(40_000).select(
        F.lit("a").alias("vendor_id"), F.lit("a.csv").alias("file_name"), F.col("id").cast("int").alias("row_index"), attribute.alias("lab_provided_attribute"), F.lit("1").alias("lab_provided_value")
    )
    many = [("a", f"n{i}", "2") for i in range(997)]
    tables_ = (mapping(("a", "ph", "1"), ("a", "ph", "9"), *many), canonical(*NAMES))
    assert len(hot_keys(cells, keys, 8)) == 1 and len(hot_keys(cells, keys, 40)) == 2
    rows = standardize(cells, *tables_)
    counts = {r.canonical_column_id: r.n for r in rows.groupBy("canonical_column_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {"1": 36_000, "2": 2_000, None: 38_000}  # the second row of ph names an unknown id; nulls stay
    as_sql = standardize_sql(spark, cells, *tables_)
    assert as_sql.columns == rows.columns
    assert as_sql.exceptAll(rows).isEmpty() and rows.exceptAll(as_sql).isEmpty()
    for df in (rows, as_sql):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan
    dealt, repeated = deal_hot(cells, tables_[0].withColumnRenamed("vendor_column_name", keys[0]), keys, ["file_name", "row_index"])
    sizes = [r.n for r in dealt.repartition(8, *keys, "_salt").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * 40_000 / 8  # unsalted, one task would have 36,000 rows
    assert 999 + 7 <= repeated.count() <= 999 + 2 * 9  # only the hot key's two rows are repeated


def test_no_hot_keys(spark, tables, no_broadcast):
    from longform.sources.storage import hot_keys

    cells = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    assert hot_keys(cells, ["k"], 8) == {} and hot_keys(cells.where("false"), ["k"], 8) == {}
