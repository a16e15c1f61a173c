"""Queries that check, profile, pivot and model."""

from __future__ import annotations

from pyspark.sql import functions as F

from longform.catalog import inputs as I
from longform.catalog.ingest import landing
from longform.catalog.registry import query, table
from longform.catalog.standard import TYPED_SQL, silver, typed_orders
from longform.functions import values as V
from longform.operators import cells as C, checks as K, provenance as P, reports, silver as Z
from longform.plans.gold import star_schema
from longform.sources.storage import join_small

# -- value rules ---------------------------------------------------------------


@query(
    "clip_bounds",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, greatest(10.0, least(l_quantity, 40.0)) AS both, "
    "least(l_quantity, 40.0) AS top, CASE WHEN l_linenumber <> 3 THEN greatest(l_quantity, 10.0) END AS bottom FROM lineitem",
)
def clip_bounds(spark, sf_dir):
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        V.clip(quantity, 10.0, 40.0).alias("both"),
        V.clip(quantity, high=40.0).alias("top"),
        V.clip(F.when(F.col("l_linenumber") != 3, quantity), low=10.0).alias("bottom"),
    )


@query(
    "round_sig_figs",
    """SELECT o_orderkey, CAST(round(o_totalprice / power(10, d)) * power(10, d) AS BIGINT) AS price_3,
       CASE WHEN o_custkey = 0 THEN 0.0 ELSE
         round(round(o_custkey / 1000.0 * power(10, 1 - floor(log10(o_custkey / 1000.0)))) / power(10, 1 - floor(log10(o_custkey / 1000.0))), 6)
       END AS small_2
FROM (SELECT *, floor(log10(o_totalprice)) - 2 AS d FROM orders)""",
)
def round_sig_figs(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        V.round_significant("o_totalprice", 3).cast("bigint").alias("price_3"),
        F.round(V.round_significant(F.col("o_custkey") / 1000.0, 2), 6).alias("small_2"),
    )


@query(
    "null_profile",
    """WITH t AS (SELECT * FROM orders),
p AS (SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS null_count FROM t
  UNION ALL SELECT 'price_high', count(*) - count(CASE WHEN o_totalprice > 100000 THEN o_totalprice END) FROM t
  UNION ALL SELECT 'status_f', count(*) - count(CASE WHEN o_orderstatus = 'F' THEN 1 END) FROM t)
SELECT column_name, (SELECT count(*) FROM t) AS row_count, null_count,
       round(null_count / (SELECT count(*) FROM t), 6) AS null_share FROM p""",
)
def null_profile(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price_high"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).alias("status_f"),
    )
    profile = K.null_profile(orders, ["o_orderkey", "price_high", "status_f"])
    return profile.withColumn("null_share", F.round("null_share", 6))


@query(
    "turnaround_days",
    f"""SELECT sample_barcode, CAST(date_diff('day', date_received, date_processed) AS INTEGER) AS turnaround_days,
       date_diff('day', date_received, date_processed) < 1 AS below_minimum FROM ({TYPED_SQL})""",
)
def turnaround_days(spark, sf_dir):
    days = K.turnaround(typed_orders(spark, sf_dir), "date_received", "date_processed")
    return days.select("sample_barcode", "turnaround_days", "below_minimum")


@query(
    "id_format_check",
    """SELECT count(*) FILTER (regexp_matches(i, '^Customer#[0-9]{9}$')) AS valid,
       count(*) FILTER (NOT regexp_matches(i, '^Customer#[0-9]{9}$')) AS invalid,
       count(*) FILTER (i IS NULL) AS missing
FROM (SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL
                  WHEN c_custkey % 5 = 0 THEN replace(c_name, '#', '-') ELSE c_name END AS i FROM customer)""",
)
def id_format_check(spark, sf_dir):
    key = F.col("c_custkey")
    names = (
        F.when(key % 9 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 0, F.replace("c_name", F.lit("#"), F.lit("-")))
        .otherwise(F.col("c_name"))
    )
    df = table(spark, sf_dir, "customer").select(names.alias("i"))
    return K.id_format_check(df, "i", "Customer", 18, 8, "#")


SPOILED = ["ph", "date_recieved", "Copper_Ppm", " zinc", "sampl_barcod", "lab id", "#id", "om%", "cu-totl", "sample_barcode"]


@query(
    "header_defects",
    "WITH names(i, name) AS (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in enumerate(SPOILED))
    + """)
SELECT name AS lab_provided_attribute, count(*) AS record_count,
       contains(lower(name), 'recieved') OR (contains(lower(name), 'sampl') AND NOT contains(lower(name), 'sample'))
         OR (contains(lower(name), 'barcod') AND NOT contains(lower(name), 'barcode')) OR contains(lower(name), 'totl') AS has_typo,
       name <> lower(name) AS has_casing, name <> trim(name) AS has_outer_whitespace,
       contains(trim(name), ' ') AS has_inner_whitespace, regexp_matches(name, '[#%-]') AS has_bad_character
FROM orders JOIN names ON o_custkey % 10 = i GROUP BY name""",
)
def header_defects(spark, sf_dir):
    names = F.array(*[F.lit(n) for n in SPOILED])
    name = F.get(names, (F.col("o_custkey") % 10).cast("int"))
    return K.header_defects(table(spark, sf_dir, "orders").select(name.alias("lab_provided_attribute")))


PACKAGES = {
    "basic": ("c_custkey", "c_name"),
    "full": ("c_custkey", "c_name", "c_nationkey", "c_acctbal_cents", "c_mktsegment"),
    "supplier": ("s_suppkey", "s_name"),
    "mixed": ("c_custkey", "s_suppkey"),
}
PACKAGE_SQL = ", ".join(f"('{p}', '{m}')" for p, members in PACKAGES.items() for m in members)


@query(
    "package_detection",
    f"""WITH {I.LONG_SQL}, packages(package, member) AS (VALUES {PACKAGE_SQL}),
sizes AS (SELECT package, count(*) AS size FROM packages GROUP BY package)
SELECT f.file_name, p.package FROM (SELECT DISTINCT file_name, lab_provided_attribute FROM long) f
JOIN packages p ON f.lab_provided_attribute = p.member JOIN sizes s ON p.package = s.package
GROUP BY f.file_name, p.package, s.size HAVING count(*) = s.size""",
)
def package_detection(spark, sf_dir):
    return K.package_detection(I.long_cells(spark, sf_dir), PACKAGES)


# -- quality -------------------------------------------------------------------


@query(
    "quality_rules",
    f"""WITH t AS ({TYPED_SQL}), r AS (
  SELECT 'ph in range' AS rule, ph BETWEEN 0 AND 14 AS ok FROM t
  UNION ALL SELECT 'ph not negative', ph >= 0 FROM t
  UNION ALL SELECT 'processed after received', date_processed >= date_received FROM t)
SELECT rule, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed, count(*) FILTER (ok IS NULL) AS unknown
FROM r GROUP BY rule""",
)
def quality_rules(spark, sf_dir):
    return K.rule_summary(
        typed_orders(spark, sf_dir),
        {
            "ph in range": K.in_range("ph", 0, 14),
            "ph not negative": K.non_negative("ph"),
            "processed after received": K.not_before("date_processed", "date_received"),
        },
    )


@query(
    "quality_flags",
    f"""WITH {I.SILVER_SQL}
SELECT vendor_id, file_name, row_index, column_index, canonical_column_id IS NOT NULL AS is_mapped,
       CASE WHEN v IS NULL THEN NULL WHEN data_type = 'numeric' THEN TRY_CAST(v AS DOUBLE) IS NOT NULL ELSE true END AS is_parsed
FROM (SELECT *, CASE WHEN row_index % 8 = 0 THEN 'n/a' WHEN row_index % 8 = 1 THEN NULL ELSE lab_provided_value END AS v FROM silver)""",
)
def quality_flags(spark, sf_dir):
    row = F.col("row_index") % 8
    spoiled = F.when(row == 0, F.lit("n/a")).when(row != 1, F.col("lab_provided_value"))
    flagged = K.with_quality_flags(silver(spark, sf_dir).withColumn("lab_provided_value", spoiled))
    return flagged.select("vendor_id", "file_name", "row_index", "column_index", "is_mapped", "is_parsed")


# -- pivot, drift, audit -------------------------------------------------------

PIVOT = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


@query(
    "pivot_back",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority, "
    "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders",
)
def pivot_back(spark, sf_dir):
    """Unpivot and pivot again: the rows come back."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    cells = C.unpivot_columns(orders, ["o_orderkey"], PIVOT)
    return C.pivot_back(cells, ["o_orderkey"], PIVOT, "lab_provided_attribute")


@query(
    "schema_drift",
    """WITH before AS (SELECT o_orderstatus AS vendor_id, o_orderpriority AS a FROM orders WHERE o_orderdate < DATE '1998-01-01' AND NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')),
after AS (SELECT o_orderstatus AS vendor_id, o_orderpriority AS a FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND NOT (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')),
o AS (SELECT vendor_id, a, count(*) AS n FROM before GROUP BY 1, 2), w AS (SELECT vendor_id, a, count(*) AS n FROM after GROUP BY 1, 2)
SELECT coalesce(o.vendor_id, w.vendor_id) AS vendor_id, coalesce(o.a, w.a) AS lab_provided_attribute,
       CASE WHEN o.n IS NULL THEN 'new' WHEN w.n IS NULL THEN 'gone' ELSE 'kept' END AS change,
       coalesce(o.n, 0) AS records_before, coalesce(w.n, 0) AS records_after
FROM o FULL JOIN w ON o.vendor_id = w.vendor_id AND o.a = w.a""",
)
def schema_drift(spark, sf_dir):
    """Order priorities per status as attributes, in the loads before and after a date."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("vendor_id"), F.col("o_orderpriority").alias("lab_provided_attribute"), "o_orderdate"
    )
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    is_cell = lambda v, a: (F.col("vendor_id") == v) & (F.col("lab_provided_attribute") == a)
    return reports.schema_drift(
        orders.filter(~late & ~is_cell("F", "5-LOW")), orders.filter(late & ~is_cell("P", "2-HIGH"))
    )


@query(
    "attribute_presence",
    "SELECT o_orderstatus AS vendor_id, o_orderpriority AS lab_provided_attribute, CAST(min(o_orderdate) AS DATE) AS first_seen, "
    "CAST(max(o_orderdate) AS DATE) AS last_seen, count(*) AS record_count FROM orders GROUP BY 1, 2",
)
def attribute_presence(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("vendor_id"),
        F.col("o_orderpriority").alias("lab_provided_attribute"),
        F.col("o_orderdate").cast("date").alias("load_day"),
    )
    return reports.attribute_presence(orders, "load_day")


@query(
    "ingestion_audit",
    f"""WITH {I.FILE_CELLS_SQL}
SELECT vendor_id, file_name, count(*) AS cell_count, count(*) - count(lab_provided_value) AS null_cells,
       count(DISTINCT lab_provided_attribute) AS attribute_count, max(row_index) AS row_count,
       sha256('run-1|' || file_name) AS batch_id
FROM file_cells GROUP BY vendor_id, file_name""",
)
def ingestion_audit(spark, sf_dir):
    audit = P.ingestion_audit(landing(spark, sf_dir).cells, "run-1", file_key="file_name")
    return audit.withColumn("null_cells", F.col("null_cells").cast("bigint"))


@query(
    "ingestion_link",
    f"""WITH {I.LONG_SQL},
pairs AS (SELECT DISTINCT sha256('run-1|' || file_name) AS batch_id,
                 sha256(vendor_id || '|' || CAST(row_index AS VARCHAR)) AS record_id FROM long)
SELECT batch_id, record_id, sha256(batch_id || '|' || record_id) AS link_id FROM pairs""",
)
def ingestion_link(spark, sf_dir):
    cells = P.with_batch_id(I.long_cells(spark, sf_dir), "run-1")
    return P.ingestion_link(cells, ["vendor_id", "row_index"])


# -- gold ----------------------------------------------------------------------


def _star(spark, sf_dir):
    return star_schema(silver(spark, sf_dir), ["key", "name", "nation"])


@query(
    "gold_star",
    f"""WITH {I.SILVER_SQL},
sample AS (
  SELECT vendor_id, file_name, row_index, max(lab_provided_value) FILTER (canonical_column_name = 'key') AS key,
         max(lab_provided_value) FILTER (canonical_column_name = 'name') AS name,
         max(lab_provided_value) FILTER (canonical_column_name = 'nation') AS nation
  FROM silver WHERE canonical_column_name IN ('key', 'name', 'nation') GROUP BY 1, 2, 3)
SELECT s.vendor_id, s.key, s.name, s.nation, f.canonical_column_name, CAST(f.lab_provided_value AS DOUBLE) AS value
FROM silver f JOIN sample s ON f.file_name = s.file_name AND f.row_index = s.row_index
WHERE f.column_category = 'measurement'""",
)
def gold_star(spark, sf_dir):
    """The fact joined back to both dimensions by their keys."""
    star = _star(spark, sf_dir)
    facts = star.measurements.drop("vendor_id").join(star.samples, "sample_key")
    return join_small(facts, star.analytes, ["analyte_key"], "inner", ["sample_key"]).select(
        "vendor_id", "key", "name", "nation", "canonical_column_name", "value"
    )


@query(
    "cross_vendor",
    f"""WITH {I.SILVER_SQL}, numbers AS (
  SELECT *, CASE WHEN data_type = 'numeric' THEN TRY_CAST(lab_provided_value AS DOUBLE) END AS x FROM silver)
SELECT canonical_column_name, vendor_id, count(*) AS value_count, round(avg(x), 2) AS avg_value,
       round(stddev_samp(x), 2) AS stddev_value, min(x) AS min_value, max(x) AS max_value
FROM numbers WHERE x IS NOT NULL GROUP BY 1, 2""",
)
def cross_vendor(spark, sf_dir):
    stats = reports.cross_vendor(Z.with_numeric_value(silver(spark, sf_dir)))
    return stats.withColumns({"avg_value": F.round("avg_value", 2), "stddev_value": F.round("stddev_value", 2)})
