"""What the physical plans must and must not contain."""

import pytest

from longform.catalog import inputs as I
from longform.operators import cells as C, reports, silver as Z
from longform.plans.bronze import land_long

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="no supplied tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_landing_shuffles_no_rows(spark, tmp_path):
    (tmp_path / "vendor_a.csv").write_text("a,b\n1,2\n")
    text = plan(land_long(spark, str(tmp_path), threshold=2).cells)
    assert "Exchange hashpartitioning" not in text and "Sort [" not in text
    assert text.count("BroadcastHashJoin") == 2 and "Python" not in text


def test_header_search_hash_aggregates(spark):
    from longform.operators.header import detect_header

    text = plan(detect_header(I.order_grid(spark, SF), 5))
    assert "ObjectHashAggregate" in text and "SortAggregate" not in text


def test_standardising_is_one_broadcast_join(spark):
    silver = Z.standardize(I.long_cells(spark, SF), I.mapping(spark), I.canonical(spark))
    text = plan(silver)
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text and "Python" not in text
    # a filter on mapped cells turns the outer join into an inner one
    assert "LeftOuter" not in plan(Z.mapped_only(silver)).split("Union")[0]


def test_reports_prune_and_combine(spark):
    from longform.catalog.registry import table

    monthly = reports.monthly_summary(table(spark, SF, "lineitem"), "l_shipdate", "l_returnflag", "l_orderkey", "l_quantity")
    text = plan(monthly)
    assert text.count("HashAggregate") == 2 and text.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_unpivot_is_one_scan(spark):
    from longform.catalog.registry import table

    text = plan(C.unpivot_columns(table(spark, SF, "orders"), ["o_orderkey"], ["o_custkey", "o_orderstatus"]))
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_filters_reach_the_scan(spark):
    from longform.catalog.registry import table

    text = plan(table(spark, SF, "orders").filter("o_custkey = 7").select("o_orderkey"))
    assert "EqualTo(o_custkey,7)" in text


def test_split_summary_sorts_nothing(spark, tmp_path):
    from pyspark.sql import functions as F

    from longform.functions.dialect import CsvDialect
    from longform.sources.csv_lines import _split_summary, scan_lines

    (tmp_path / "vendor_a.csv").write_text("a,b\n1,2\n")
    lines = scan_lines(spark, str(tmp_path)).withColumn("seq", F.monotonically_increasing_id())
    text = plan(_split_summary(lines, CsvDialect(), 2))
    assert text.count("ObjectHashAggregate") == 2 and "Sort" not in text
