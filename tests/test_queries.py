"""Every registered query against its SQL on the supplied tables."""

import os

import pytest

import __spark_entry__ as entry
from longform import catalog
from compare import connect, duck_result, spark_result

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no supplied tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    got = spark_result(entry.queries()[name](spark, SF))
    want = duck_result(duck, entry.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "no rows"


def test_entry(spark):
    assert [r.vendor_id for r in entry.entry(spark).collect()] == ["vendor_a", "vendor_b"]
