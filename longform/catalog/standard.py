"""Queries over standardised (silver) cells, mapping tables and typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.catalog import inputs as I
from longform.catalog.ingest import landing
from longform.catalog.registry import query, table
from longform.functions import values as V
from longform.operators import reports, silver as Z
from longform.sources import reference_data as R, tables as S
from longform.sources.storage import scratch_path

SILVER_FIELDS = (
    "vendor_id, file_name, row_index, column_index, lab_provided_attribute, lab_provided_value, "
    "canonical_column_id, canonical_column_name, column_category, data_type"
)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.standardize(I.long_cells(spark, sf_dir), I.mapping(spark), I.canonical(spark))


@query("silver_standardize", f"WITH {I.SILVER_SQL}\nSELECT {SILVER_FIELDS} FROM silver")
def silver_standardize(spark, sf_dir):
    return silver(spark, sf_dir)


@query("silver_standardize_sql", f"WITH {I.SILVER_SQL}\nSELECT {SILVER_FIELDS} FROM silver")
def silver_standardize_sql(spark, sf_dir):
    return Z.standardize_sql(spark, I.long_cells(spark, sf_dir), I.mapping(spark), I.canonical(spark))


# a second vendor that also sends c_name, so the vendor-less join repeats its cells
EXTRA_ROW = ("vendor_b", "c_name", R.key_of("col_opened"), "clash")
EXTRA_SQL = I.values_cte("mapping", I.MAPPING_FIELDS, [*I.MAPPING, EXTRA_ROW])
CANONICAL_SQL = I.values_cte("canonical", I.CANONICAL_FIELDS, I.CANONICAL)


def _clashing_mapping(spark: SparkSession) -> DataFrame:
    return R.inline(spark, I.MAPPING_FIELDS, [*I.MAPPING, EXTRA_ROW])


@query(
    "standardize_attr_only",
    f"""WITH {I.LONG_SQL}, {EXTRA_SQL}, {CANONICAL_SQL}
SELECT l.*, c.canonical_column_id, c.canonical_column_name, c.column_category, c.data_type
FROM long l LEFT JOIN mapping m ON l.lab_provided_attribute = m.vendor_column_name
LEFT JOIN canonical c ON m.canonical_column_id = c.canonical_column_id""",
)
def standardize_attr_only(spark, sf_dir):
    return Z.standardize_by_attribute(I.long_cells(spark, sf_dir), _clashing_mapping(spark), I.canonical(spark))


@query(
    "map_one_step",
    f"""WITH {I.LONG_SQL}, {EXTRA_SQL}
SELECT l.*, m.vendor_id AS mapping_vendor_id, m.canonical_column_id
FROM long l LEFT JOIN mapping m ON l.lab_provided_attribute = m.vendor_column_name""",
)
def map_one_step(spark, sf_dir):
    return Z.map_one_step(I.long_cells(spark, sf_dir), _clashing_mapping(spark))


@query("mapped_only", f"WITH {I.SILVER_SQL}\nSELECT {SILVER_FIELDS} FROM silver WHERE canonical_column_id IS NOT NULL")
def mapped_only(spark, sf_dir):
    return Z.mapped_only(silver(spark, sf_dir))


@query(
    "numeric_value",
    f"""WITH {I.SILVER_SQL}
SELECT {SILVER_FIELDS},
       CASE WHEN data_type = 'numeric' THEN TRY_CAST(lab_provided_value AS DOUBLE) END AS numeric_value FROM silver""",
)
def numeric_value(spark, sf_dir):
    return Z.with_numeric_value(silver(spark, sf_dir))


@query(
    "surrogate_key",
    "SELECT c_custkey, left(sha256('vendor_a|' || c_name), 8) AS name_key, "
    "left(sha256(coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END, '') || '|' || "
    "CAST(c_nationkey AS VARCHAR)), 8) AS group_key FROM customer",
)
def surrogate_key(spark, sf_dir):
    """The second key has nulls among its parts; they keep their place."""
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        V.surrogate_key(F.lit("vendor_a"), "c_name").alias("name_key"),
        V.surrogate_key(segment, "c_nationkey").alias("group_key"),
    )


# -- mapping tables derived from part: brand = vendor, part name = vendor column, type = canonical


def part_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("vendor_id"),
        F.col("p_name").alias("vendor_column_name"),
        V.surrogate_key("p_type", "p_size").alias("canonical_column_id"),
    )


def part_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only even sizes are defined, and those that four divides are defined twice."""
    part = table(spark, sf_dir, "part").filter(F.col("p_size") % 2 == 0)
    return part.select("p_type", "p_size", (F.col("p_size") % 4 == 0).alias("again")).distinct().select(
        V.surrogate_key("p_type", "p_size").alias("canonical_column_id"),
        F.explode(F.when(F.col("again"), F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("version"),
    )


PART_SQL = """mapping AS (
  SELECT p_brand AS vendor_id, p_name AS vendor_column_name,
         left(sha256(p_type || '|' || CAST(p_size AS VARCHAR)), 8) AS canonical_column_id FROM part),
defined AS (SELECT DISTINCT p_type, p_size FROM part WHERE p_size % 2 = 0),
canonical AS (
  SELECT left(sha256(p_type || '|' || CAST(p_size AS VARCHAR)), 8) AS canonical_column_id FROM defined
  UNION ALL
  SELECT left(sha256(p_type || '|' || CAST(p_size AS VARCHAR)), 8) FROM defined WHERE p_size % 4 = 0)"""


@query(
    "mapping_integrity",
    f"""WITH {PART_SQL}
SELECT 'duplicate_canonical' AS problem, canonical_column_id AS key, count(*) AS occurrences
FROM canonical GROUP BY canonical_column_id HAVING count(*) > 1
UNION ALL
SELECT 'duplicate_mapping', vendor_id || '|' || vendor_column_name, count(*)
FROM mapping GROUP BY vendor_id, vendor_column_name HAVING count(*) > 1
UNION ALL
SELECT 'dangling_mapping', canonical_column_id, count(*) FROM mapping
WHERE canonical_column_id NOT IN (SELECT canonical_column_id FROM canonical) GROUP BY canonical_column_id""",
)
def mapping_integrity(spark, sf_dir):
    return Z.mapping_integrity(part_mapping(spark, sf_dir), part_canonical(spark, sf_dir))


@query(
    "mapping_synonyms",
    f"""WITH {PART_SQL}
SELECT canonical_column_id, count(DISTINCT vendor_id) AS vendor_count, count(DISTINCT vendor_column_name) AS name_count,
       min(vendor_column_name) AS first_name, max(vendor_column_name) AS last_name
FROM mapping GROUP BY canonical_column_id HAVING count(DISTINCT vendor_column_name) > 1""",
)
def mapping_synonyms(spark, sf_dir):
    return Z.mapping_synonyms(part_mapping(spark, sf_dir))


@query(
    "mapping_tables",
    f"""WITH {I.LONG_SQL}, {I.MAPPING_SQL}
SELECT m.vendor_id, m.vendor_column_name, m.canonical_column_id, m.notes, c.canonical_column_name, c.data_type,
       count(l.lab_provided_attribute) AS record_count
FROM mapping m JOIN canonical c ON m.canonical_column_id = c.canonical_column_id
LEFT JOIN long l ON l.vendor_id = m.vendor_id AND l.lab_provided_attribute = m.vendor_column_name
GROUP BY ALL""",
)
def mapping_tables(spark, sf_dir):
    """Mapping tables exported to CSV, loaded again with inferred types, and counted against the cells."""
    loaded = []
    for name, df in (("mapping", I.mapping(spark)), ("canonical", I.canonical(spark))):
        path = scratch_path(spark, name)
        S.write_csv(df, path, single_file=True)
        loaded.append(S.read_csv_inferred(spark, path))
    mapping, canonical = loaded
    # counts per attribute are formed map-side; only they meet the mapping
    counts = I.long_cells(spark, sf_dir).groupBy("vendor_id", F.col("lab_provided_attribute").alias("vendor_column_name")).agg(
        F.count("*").alias("n")
    )
    known = mapping.join(canonical, "canonical_column_id")
    return known.join(counts, ["vendor_id", "vendor_column_name"], "left").select(
        "vendor_id",
        "vendor_column_name",
        "canonical_column_id",
        "notes",
        "canonical_column_name",
        "data_type",
        F.coalesce("n", F.lit(0)).alias("record_count"),
    )


# -- reports -------------------------------------------------------------------

COVERAGE_SQL = """SELECT vendor_id, count(*) AS total_records, count(canonical_column_id) AS mapped_records,
       count(*) - count(canonical_column_id) AS unmapped_records FROM silver GROUP BY vendor_id"""


@query("mapping_coverage", f"WITH {I.SILVER_SQL}\n{COVERAGE_SQL}")
def mapping_coverage(spark, sf_dir):
    return reports.mapping_coverage(silver(spark, sf_dir))


@query(
    "file_mapping_coverage",
    f"""WITH {I.FILE_CELLS_SQL}, {I.MAPPING_SQL},
silver AS (
  SELECT f.*, c.canonical_column_id FROM file_cells f
  LEFT JOIN mapping m ON f.lab_provided_attribute = m.vendor_column_name AND f.vendor_id = m.vendor_id
  LEFT JOIN canonical c ON m.canonical_column_id = c.canonical_column_id)
{COVERAGE_SQL}""",
)
def file_mapping_coverage(spark, sf_dir):
    """End to end: messy files, long cells, standardised, coverage per vendor."""
    cells = landing(spark, sf_dir).cells
    return reports.mapping_coverage(Z.standardize(cells, I.mapping(spark), I.canonical(spark)))


@query(
    "unmapped_attributes",
    f"WITH {I.SILVER_SQL}\nSELECT DISTINCT vendor_id, lab_provided_attribute FROM silver WHERE canonical_column_id IS NULL",
)
def unmapped_attributes(spark, sf_dir):
    return reports.unmapped_attributes(silver(spark, sf_dir))


@query(
    "canonical_usage",
    f"""WITH {I.SILVER_SQL}
SELECT canonical_column_name, column_category, count(DISTINCT vendor_id) AS vendor_count, count(*) AS record_count
FROM silver WHERE canonical_column_name IS NOT NULL GROUP BY 1, 2""",
)
def canonical_usage(spark, sf_dir):
    return reports.canonical_usage(silver(spark, sf_dir))


COUNTED = ("lineitem", "orders", "customer", "supplier")


@query(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED),
)
def row_counts(spark, sf_dir):
    return reports.row_counts({t: table(spark, sf_dir, t) for t in COUNTED})


@query(
    "preview",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
)
def preview(spark, sf_dir):
    first = reports.preview(table(spark, sf_dir, "orders"), 20, F.desc("o_totalprice"), "o_orderkey")
    return first.select("o_orderkey", "o_custkey", "o_orderstatus")


# -- typed rows and monthly summary -------------------------------------------


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a wide all-text bronze table; some values are junk."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return orders.select(
        key.cast("string").alias("sample_barcode"),
        F.when(key % 50 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_received"),
        F.date_format(F.date_add("o_orderdate", (key % 9).cast("int")), "yyyy-MM-dd").alias("date_processed"),
        F.when(key % 40 == 0, "< 5").otherwise(F.concat((F.col("o_custkey") % 80).cast("string"), F.lit("."))).alias("ph"),
        F.col("o_orderstatus").alias("data_source"),
    )


TYPED_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS sample_barcode,
  CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_received,
  CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INTEGER) AS DATE) AS date_processed,
  CASE WHEN o_orderkey % 40 <> 0 THEN CAST(o_custkey % 80 AS DOUBLE) END AS ph,
  o_orderstatus AS vendor_name FROM orders"""


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.typed(
        raw_orders(spark, sf_dir), ("date_received", "date_processed"), ("ph",), {"data_source": "vendor_name"}
    )


@query("silver_typed", TYPED_SQL)
def silver_typed(spark, sf_dir):
    return typed_orders(spark, sf_dir).drop("silver_processed_at")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns})


@query(
    "gold_monthly",
    """SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month_start, l_returnflag AS vendor_name,
       count(l_orderkey) AS sample_count, round(avg(l_quantity), 2) AS avg_quantity,
       round(stddev_samp(l_quantity), 2) AS stddev_quantity, min(l_quantity) AS min_quantity,
       max(l_quantity) AS max_quantity, round(avg(l_extendedprice), 2) AS avg_price, round(avg(l_tax), 4) AS avg_tax
FROM lineitem GROUP BY 1, 2""",
)
def gold_monthly(spark, sf_dir):
    summary = reports.monthly_summary(
        table(spark, sf_dir, "lineitem"),
        "l_shipdate",
        "l_returnflag",
        "l_orderkey",
        "l_quantity",
        ("l_extendedprice", "l_tax"),
        {"l_quantity": "quantity", "l_extendedprice": "price", "l_tax": "tax"},
    )
    rounded = _rounded(summary, "avg_quantity", "stddev_quantity", "avg_price").withColumn("avg_tax", F.round("avg_tax", 4))
    return rounded.withColumn("month_start", F.col("month_start").cast("timestamp_ntz")).drop("gold_processed_at")


@query(
    "medallion_monthly",
    f"""WITH typed AS ({TYPED_SQL})
SELECT CAST(date_trunc('month', date_received) AS DATE) AS month_start, vendor_name, count(sample_barcode) AS sample_count,
       round(avg(ph), 2) AS avg_ph, round(stddev_samp(ph), 2) AS stddev_ph, min(ph) AS min_ph, max(ph) AS max_ph
FROM typed GROUP BY 1, 2""",
)
def medallion_monthly(spark, sf_dir):
    """Raw text to typed rows to the monthly table."""
    summary = reports.monthly_summary(typed_orders(spark, sf_dir), "date_received", "vendor_name", "sample_barcode", "ph")
    return (
        _rounded(summary, "avg_ph", "stddev_ph")
        .withColumn("month_start", F.col("month_start").cast("date"))
        .drop("gold_processed_at")
    )
