"""Inputs the registered queries share, derived by Spark from the supplied tables.

``customer`` plays one vendor and ``supplier`` another: the same facts under other
names. They are used as tables, as long cells, as raw grids, and as messy CSV files.
Every helper has a SQL counterpart for the oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from longform.catalog.registry import table
from longform.operators.cells import unpivot_columns
from longform.sources.reference_data import inline, key_of
from longform.sources.storage import scratch_path

# -- mapping tables for the two vendors ---------------------------------------

CANONICAL = [
    (key_of("col_key"), "key", "sample_identifier", "numeric", "Number of the account"),
    (key_of("col_name"), "name", "lab_metadata", "string", "Name of the account"),
    (key_of("col_nation"), "nation", "lab_metadata", "numeric", "Number of the nation"),
    (key_of("col_balance"), "balance", "measurement", "numeric", "Balance in cents"),
    (key_of("col_opened"), "opened", "date", "date", "Never sent by these vendors"),
]
MAPPING = [
    ("vendor_a", "c_custkey", key_of("col_key"), "direct"),
    ("vendor_a", "c_name", key_of("col_name"), "direct"),
    ("vendor_a", "c_nationkey", key_of("col_nation"), "direct"),
    ("vendor_a", "c_acctbal_cents", key_of("col_balance"), "in cents"),
    ("vendor_b", "s_suppkey", key_of("col_key"), "other name"),
    ("vendor_b", "s_name", key_of("col_name"), "other name"),
    ("vendor_b", "s_nationkey", key_of("col_nation"), "other name"),
    ("vendor_b", "s_acctbal_cents", key_of("col_balance"), "other name"),
]
CANONICAL_FIELDS = ["canonical_column_id", "canonical_column_name", "column_category", "data_type", "description"]
MAPPING_FIELDS = ["vendor_id", "vendor_column_name", "canonical_column_id", "notes"]

RENAMES = {
    "vendor_a": {
        "c_custkey": "key",
        "c_name": "name",
        "c_nationkey": "nation",
        "c_acctbal_cents": "balance",
        "c_mktsegment": "segment",
    },
    "vendor_b": {"s_suppkey": "key", "s_name": "name", "s_nationkey": "nation", "s_acctbal_cents": "balance"},
}


def mapping(spark: SparkSession) -> DataFrame:
    return inline(spark, MAPPING_FIELDS, MAPPING)


def canonical(spark: SparkSession) -> DataFrame:
    return inline(spark, CANONICAL_FIELDS, CANONICAL)


def values_cte(name: str, fields: list[str], rows: list[tuple[str, ...]]) -> str:
    body = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return f"{name}({', '.join(fields)}) AS (VALUES {body})"


MAPPING_SQL = values_cte("mapping", MAPPING_FIELDS, MAPPING) + ",\n" + values_cte("canonical", CANONICAL_FIELDS, CANONICAL)


# -- wide tables ---------------------------------------------------------------


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", cents("c_acctbal").alias("c_acctbal_cents"), "c_mktsegment"
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", cents("s_acctbal").alias("s_acctbal_cents")
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, as a CSV scan would give it."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


A_COLUMNS = [
    ("c_custkey", "CAST(c_custkey AS VARCHAR)"),
    ("c_name", "c_name"),
    ("c_nationkey", "CAST(c_nationkey AS VARCHAR)"),
    ("c_acctbal_cents", "CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR)"),
    ("c_mktsegment", "c_mktsegment"),
]
B_COLUMNS = [
    ("s_suppkey", "CAST(s_suppkey AS VARCHAR)"),
    ("s_name", "s_name"),
    ("s_nationkey", "CAST(s_nationkey AS VARCHAR)"),
    ("s_acctbal_cents", "CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR)"),
]


# -- long cells ----------------------------------------------------------------


def long_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both vendors as long cells straight from the tables: one scan each, no shuffle."""
    a = customers(spark, sf_dir).withColumns(
        {
            "vendor_id": F.lit("vendor_a"),
            "file_name": F.concat(F.lit("vendor_a_"), F.lower("c_mktsegment"), F.lit(".csv")),
            "row_index": F.col("c_custkey"),
        }
    )
    b = suppliers(spark, sf_dir).withColumns(
        {
            "vendor_id": F.lit("vendor_b"),
            "file_name": F.concat(F.lit("vendor_b_"), F.pmod("s_nationkey", F.lit(5)), F.lit(".csv")),
            "row_index": F.col("s_suppkey"),
        }
    )
    keys = ["vendor_id", "file_name", "row_index"]
    return unpivot_columns(a, keys, [c for c, _ in A_COLUMNS]).unionByName(
        unpivot_columns(b, keys, [c for c, _ in B_COLUMNS])
    )


def union_of_cells(source: str, keys: str, columns: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {keys}, {i} AS column_index, '{name}' AS lab_provided_attribute, {expr} AS lab_provided_value FROM {source}"
        for i, (name, expr) in enumerate(columns, start=1)
    )


LONG_SQL = (
    "long AS (\n"
    + union_of_cells(
        "customer",
        "'vendor_a' AS vendor_id, 'vendor_a_' || lower(c_mktsegment) || '.csv' AS file_name, c_custkey AS row_index",
        A_COLUMNS,
    )
    + "\nUNION ALL\n"
    + union_of_cells(
        "supplier",
        "'vendor_b' AS vendor_id, 'vendor_b_' || CAST(s_nationkey % 5 AS VARCHAR) || '.csv' AS file_name, s_suppkey AS row_index",
        B_COLUMNS,
    )
    + ")"
)

SILVER_SQL = f"""{LONG_SQL},
{MAPPING_SQL},
silver AS (
  SELECT l.*, c.canonical_column_id, c.canonical_column_name, c.column_category, c.data_type
  FROM long l
  LEFT JOIN mapping m ON l.lab_provided_attribute = m.vendor_column_name AND l.vendor_id = m.vendor_id
  LEFT JOIN canonical c ON m.canonical_column_id = c.canonical_column_id)"""


# -- raw grids from orders -----------------------------------------------------

GRID_HEADER = ["order", "customer", "status", "", "price", "status", None]


def order_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One "file" per order priority: two metadata rows, a header row, and the orders."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    full = F.array(
        key.cast("string"),
        F.when(key % 5 == 0, "").otherwise(F.col("o_custkey").cast("string")),
        F.col("o_orderstatus"),
        F.lit("junk"),
        cents("o_totalprice").cast("string"),
        F.col("o_orderpriority"),
        F.lit("tail"),
    )
    rows = orders.select(
        F.col("o_orderpriority").alias("file_id"),
        (key + 3).alias("line_no"),
        F.when(key % 7 == 0, F.slice(full, 1, 5)).otherwise(full).alias("cells"),
    )
    text = lambda cells: F.array(*[F.lit(c).cast("string") for c in cells])
    files = orders.select(F.col("o_orderpriority").alias("file_id")).distinct()
    tops = [
        files.select("file_id", F.lit(0).cast("bigint").alias("line_no"), F.array(F.lit("Report"), "file_id").alias("cells")),
        files.select("file_id", F.lit(1).cast("bigint").alias("line_no"), text([""] * 7).alias("cells")),
        files.select("file_id", F.lit(2).cast("bigint").alias("line_no"), text(GRID_HEADER).alias("cells")),
    ]
    grid = rows
    for top in tops:
        grid = grid.unionByName(top)
    return grid


def shown(cells: Column) -> Column:
    """A row of cells as comparable text."""
    return F.concat_ws("|", F.transform(cells, lambda c: F.coalesce(c, F.lit("~"))))


# per source column of the grid: value as SQL, null where empty
GRID_VALUES = [
    "CAST(o_orderkey AS VARCHAR)",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END",
    "o_orderstatus",
    "'junk'",
    "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)",
    "o_orderpriority",
    "'tail'",
]


# -- messy CSV files -----------------------------------------------------------

A_HEADER = "c_custkey,c_name,,c_nationkey,c_acctbal_cents,c_mktsegment,c_mktsegment"
B_HEADERS = ("s_suppkey,s_name,s_nationkey,s_acctbal_cents,,", "#s_suppkey,S_Name,s-nationkey,s_acctbal_cents,,")

_written: dict[tuple[str, str], str] = {}


def _file_number(key: str, rows: int) -> Column:
    """Files of about the square root of the table's rows, so both grow together."""
    return F.floor(F.col(key) / max(1, math.ceil(math.sqrt(rows)))).cast("bigint")


def messy_files(spark: SparkSession, sf_dir: str) -> str:
    """Write both vendors as messy CSV files once per session; returns their folder.

    Vendor A has metadata rows, blank lines, an unnamed column, a repeated name, short
    rows, quoted empty cells, and names with line breaks and quotes. Vendor B has padding
    columns and spoiled names. Every tenth file has no header.
    """
    where = (spark.sparkContext.applicationId, sf_dir)
    if where in _written:
        return _written[where]
    a, b = customers(spark, sf_dir), suppliers(spark, sf_dir)
    a = a.withColumn("k", _file_number("c_custkey", a.count()))
    b = b.withColumn("k", _file_number("s_suppkey", b.count()))
    k, key = F.col("k"), F.col("c_custkey")
    name = F.when(
        (k % 4 == 1) & (key % 13 == 0), F.concat(F.lit('"'), "c_name", F.lit('\nsays ""hi"", ok"'))
    ).otherwise(F.col("c_name"))
    short = F.concat_ws(
        ",", key, name, F.lit(""), "c_nationkey", "c_acctbal_cents", F.when(key % 17 == 0, '""').otherwise(F.col("c_mktsegment"))
    )
    row = F.when(k % 10 == 9, F.concat_ws(",", key, name)).otherwise(
        F.when(key % 11 == 0, short).otherwise(F.concat_ws(",", short, F.lower("c_mktsegment")))
    )
    label = lambda vendor: F.format_string(f"{vendor}_%05d.csv", k)
    top = F.array_compact(
        F.array(
            F.when(k % 3 >= 1, F.lit("Lab report,,,")),
            F.when(k % 3 >= 2, F.concat(F.lit("Generated:,file "), k)),
            F.when(k % 6 == 5, F.lit("")),
            F.lit(A_HEADER),
        )
    )
    a_tops = a.select("k").distinct().filter(k % 10 != 9).select(label("vendor_a").alias("file"), F.posexplode(top).alias("ord", "value"))
    b_top = F.when(k % 2 == 0, B_HEADERS[0]).otherwise(B_HEADERS[1])
    b_tops = b.select("k").distinct().filter(k % 10 != 9).select(label("vendor_b").alias("file"), F.lit(0).alias("ord"), b_top.alias("value"))
    b_row = F.concat_ws(",", "s_suppkey", "s_name", "s_nationkey", "s_acctbal_cents", F.lit(""), F.lit(""))
    b_row = F.when(k % 10 == 9, F.concat_ws(",", "s_suppkey", "s_name")).otherwise(b_row)
    lines = (
        a.select(label("vendor_a").alias("file"), (key + 10).alias("ord"), row.alias("value"))
        .unionByName(a_tops)
        .unionByName(b.select(label("vendor_b").alias("file"), (F.col("s_suppkey") + 10).alias("ord"), b_row.alias("value")))
        .unionByName(b_tops)
    )
    path = scratch_path(spark, "vendor-files")
    (
        lines.repartition("file")
        .sortWithinPartitions("file", "ord")
        .select("file", "value")
        .write.partitionBy("file")
        .text(path)
    )
    _written[where] = path
    return path


FILES_SQL = """a AS (
  SELECT *, c_custkey // (SELECT CAST(ceil(sqrt(count(*))) AS BIGINT) FROM customer) AS k FROM customer),
b AS (
  SELECT *, s_suppkey // (SELECT CAST(ceil(sqrt(count(*))) AS BIGINT) FROM supplier) AS k FROM supplier),
a_rows AS (
  SELECT k, c_custkey,
         'vendor_a_' || lpad(CAST(k AS VARCHAR), 5, '0') || '.csv' AS file_name,
         k % 3 + CASE WHEN k % 6 = 5 THEN 1 ELSE 0 END AS top_rows,
         row_number() OVER (PARTITION BY k ORDER BY c_custkey) AS row_index,
         CAST(c_custkey AS VARCHAR) AS v_key,
         CASE WHEN k % 4 = 1 AND c_custkey % 13 = 0
              THEN c_name || chr(10) || 'says "hi", ok' ELSE c_name END AS v_name,
         CAST(c_nationkey AS VARCHAR) AS v_nation,
         CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) AS v_balance,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS v_segment,
         lower(c_mktsegment) AS v_lower
  FROM a),
b_rows AS (
  SELECT k, s_suppkey,
         'vendor_b_' || lpad(CAST(k AS VARCHAR), 5, '0') || '.csv' AS file_name,
         row_number() OVER (PARTITION BY k ORDER BY s_suppkey) AS row_index,
         CAST(s_suppkey AS VARCHAR) AS v_key, s_name AS v_name, CAST(s_nationkey AS VARCHAR) AS v_nation,
         CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) AS v_balance
  FROM b)"""


def _file_cells() -> str:
    a = [
        (1, 1, "'c_custkey'", "v_key", ""),
        (2, 2, "'c_name'", "v_name", ""),
        (3, 4, "'c_nationkey'", "v_nation", ""),
        (4, 5, "'c_acctbal_cents'", "v_balance", ""),
        (5, 6, "'c_mktsegment'", "v_segment", ""),
        (6, 7, "'c_mktsegment_1'", "v_lower", " AND c_custkey % 11 <> 0"),
    ]
    odd = lambda even, spoiled: f"CASE WHEN k % 2 = 0 THEN '{even}' ELSE '{spoiled}' END"
    b = [
        (1, odd("s_suppkey", "#s_suppkey"), "v_key"),
        (2, odd("s_name", "S_Name"), "v_name"),
        (3, odd("s_nationkey", "s-nationkey"), "v_nation"),
        (4, "'s_acctbal_cents'", "v_balance"),
    ]
    parts = [
        f"SELECT 'vendor_a' AS vendor_id, file_name, row_index, CAST({i} AS INTEGER) AS column_index, "
        f"{name} AS lab_provided_attribute, {value} AS lab_provided_value, CAST({pos} AS INTEGER) AS source_column_index "
        f"FROM a_rows WHERE k % 10 <> 9{also}"
        for i, pos, name, value, also in a
    ] + [
        f"SELECT 'vendor_b' AS vendor_id, file_name, row_index, CAST({i} AS INTEGER) AS column_index, "
        f"{name} AS lab_provided_attribute, {value} AS lab_provided_value, CAST({i} AS INTEGER) AS source_column_index "
        f"FROM b_rows WHERE k % 10 <> 9"
        for i, name, value in b
    ]
    return "file_cells AS (\n" + "\nUNION ALL\n".join(parts) + ")"


FILE_CELLS_SQL = FILES_SQL + ",\n" + _file_cells()
