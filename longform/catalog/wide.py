"""Queries over wide tables: the repairs of the wide path."""

from __future__ import annotations

from pyspark.sql import functions as F

from longform.catalog import inputs as I
from longform.catalog.registry import query, table
from longform.operators import wide as W



@query(
    "rename_projection",
    "SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation, CAST(round(s_acctbal * 100) AS BIGINT) AS balance FROM supplier",
)
def rename_projection(spark, sf_dir):
    return W.rename_projection(I.suppliers(spark, sf_dir), I.RENAMES["vendor_b"])


@query(
    "superset_union",
    "SELECT CAST(NULL AS BIGINT) AS c_acctbal_cents, c_custkey, NULL AS c_mktsegment, c_name, c_nationkey FROM customer "
    "UNION ALL SELECT CAST(round(c_acctbal * 100) AS BIGINT), c_custkey, c_mktsegment, c_name, NULL FROM customer",
)
def superset_union(spark, sf_dir):
    """Two packages of one vendor, each without some columns of the other."""
    a = I.customers(spark, sf_dir)
    return W.superset_union(
        a.select("c_custkey", "c_name", "c_nationkey"), a.select("c_custkey", "c_name", "c_acctbal_cents", "c_mktsegment")
    )


@query(
    "align_superset",
    "SELECT s_nationkey, CAST(NULL AS VARCHAR) AS s_region, s_suppkey FROM supplier",
)
def align_superset(spark, sf_dir):
    return W.align_superset(I.suppliers(spark, sf_dir), ["s_nationkey", "s_region", "s_suppkey"])


TYPO_NAMES = {
    "c_custkey": "sampl_barcode",
    "c_name": "date_recieved",
    "c_nationkey": "Proccessed_Date",
    "c_acctbal_cents": "date_proccessed",
    "c_mktsegment": "Sample_id_barcod",
}


@query(
    "fix_header_typos",
    'SELECT c_custkey AS sample_barcode, c_name AS date_received, c_nationkey AS "Proccessed_Date", '
    "CAST(round(c_acctbal * 100) AS BIGINT) AS date_processed, "
    'c_mktsegment AS "Sample_id_barcode" FROM customer',
)
def fix_header_typos(spark, sf_dir):
    """A capitalised typo is detected but not repaired, as the rule is case-sensitive."""
    return W.fix_header_typos(I.customers(spark, sf_dir).withColumnsRenamed(TYPO_NAMES))


@query(
    "remove_empty_columns",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_orderstatus ELSE '' END AS sparse FROM orders",
)
def remove_empty_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return W.remove_empty_columns(
        orders.select(
            "o_orderkey",
            F.lit(None).cast("string").alias("all_null"),
            F.lit("").alias("all_blank"),
            F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderstatus")).otherwise("").alias("sparse"),
            F.col("o_orderstatus").alias(" "),
        )
    )


@query(
    "sanitize_names",
    "SELECT c_custkey AS lab_id, c_name AS sample_barcode, c_nationkey AS organic_matter_pct, "
    "CAST(round(c_acctbal * 100) AS BIGINT) AS cu_total, c_mktsegment FROM customer",
)
def sanitize_names(spark, sf_dir):
    spoiled = I.customers(spark, sf_dir).withColumnsRenamed(
        {"c_custkey": "#lab_id", "c_name": "sample-barcode", "c_nationkey": "organic_matter%", "c_acctbal_cents": "cu-total"}
    )
    return W.sanitize_names(spoiled)


@query(
    "vendor_dispatch",
    "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, CAST(round(c_acctbal * 100) AS BIGINT) AS balance, "
    "c_mktsegment AS segment, 'vendor_a' AS vendor_id FROM customer UNION ALL "
    "SELECT s_suppkey, s_name, s_nationkey, CAST(round(s_acctbal * 100) AS BIGINT), NULL, 'vendor_b' FROM supplier",
)
def vendor_dispatch(spark, sf_dir):
    """Vendor A's names are the standard, so it passes as it is."""
    a = W.bulk_rename(I.customers(spark, sf_dir), I.RENAMES["vendor_a"])
    return W.vendor_dispatch({"vendor_a": a, "vendor_b": I.suppliers(spark, sf_dir)}, {"vendor_b": I.RENAMES["vendor_b"]})


@query(
    "bulk_rename",
    "SELECT c_custkey AS key, c_name, c_nationkey AS nation, CAST(round(c_acctbal * 100) AS BIGINT) AS c_acctbal_cents, "
    "c_mktsegment FROM customer",
)
def bulk_rename(spark, sf_dir):
    return W.bulk_rename(I.customers(spark, sf_dir), {"c_custkey": "key", "c_nationkey": "nation", "absent": "ignored"})
