"""Queries over files, grids and long bronze."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.catalog import inputs as I
from longform.catalog.registry import query, table
from longform.functions.names import logical_file_name, vendor_of
from longform.operators import cells as C, checks, header as H, provenance, reports
from longform.plans.bronze import Landing, append_wide, land_long, land_wide
from longform.plans.parse_warnings import parse_warnings as warnings_of
from longform.sources import tables as S
from longform.sources.csv_lines import read_grid
from longform.sources.storage import scratch_path
from longform.streaming.incremental import landed, new_files, stream_long
from longform.streaming.ledger import land_new, landed_table, published

RUN_AT = dt.datetime(2024, 1, 1)
SUPERSET = ["key", "name", "nation", "balance", "segment"]


def landing(spark: SparkSession, sf_dir: str, threshold=4) -> Landing:
    return land_long(spark, I.messy_files(spark, sf_dir), threshold=threshold, ingested_at=RUN_AT)


# -- scans and sinks -----------------------------------------------------------

B_TEXT_SQL = "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in I.B_COLUMNS) + " FROM supplier"
A_TEXT_SQL = "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in I.A_COLUMNS) + " FROM customer"


def _csv_of(df: DataFrame, label: str, **options) -> str:
    path = scratch_path(df.sparkSession, label)
    S.write_csv(df, path, **options)
    return path


@query("csv_header_scan", A_TEXT_SQL)
def csv_header_scan(spark, sf_dir):
    return S.read_csv_text(spark, _csv_of(I.customers(spark, sf_dir), "csv"))


@query(
    "csv_infer_scan",
    "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, "
    "CAST(round(c_acctbal * 100) AS INTEGER) AS c_acctbal_cents, c_mktsegment FROM customer",
)
def csv_infer_scan(spark, sf_dir):
    return S.read_csv_inferred(spark, _csv_of(I.customers(spark, sf_dir), "csv"))


@query("csv_sink_roundtrip", B_TEXT_SQL)
def csv_sink_roundtrip(spark, sf_dir):
    """Without a header line; the schema is given on reading."""
    df = I.as_text(I.suppliers(spark, sf_dir))
    return spark.read.schema(df.schema).csv(_csv_of(df, "csv", header=False))


@query(
    "raw_grid_scan",
    f"""WITH {I.FILES_SQL},
heads AS (
  SELECT DISTINCT k, file_name FROM b_rows WHERE k % 10 <> 9)
SELECT file_name, CAST(0 AS BIGINT) AS line_no, 6 AS n_tokens,
       CASE WHEN k % 2 = 0 THEN 's_suppkey|s_name|s_nationkey|s_acctbal_cents|~|~'
            ELSE '#s_suppkey|S_Name|s-nationkey|s_acctbal_cents|~|~' END AS cells
FROM heads
UNION ALL
SELECT file_name, row_index - CASE WHEN k % 10 = 9 THEN 1 ELSE 0 END,
       CASE WHEN k % 10 = 9 THEN 2 ELSE 6 END,
       v_key || '|' || v_name || CASE WHEN k % 10 = 9 THEN '' ELSE '|' || v_nation || '|' || v_balance || '|~|~' END
FROM b_rows
UNION ALL
SELECT file_name, row_index - 1 + CASE WHEN k % 10 = 9 THEN 0 ELSE top_rows + 1 END,
       CASE WHEN k % 10 = 9 THEN 2 WHEN c_custkey % 11 = 0 THEN 6 ELSE 7 END,
       v_key || '|' || v_name || CASE WHEN k % 10 = 9 THEN ''
         ELSE '|~|' || v_nation || '|' || v_balance || '|' || coalesce(v_segment, '~')
              || CASE WHEN c_custkey % 11 = 0 THEN '' ELSE '|' || v_lower END END
FROM a_rows
UNION ALL
SELECT DISTINCT file_name, CAST(t.line_no AS BIGINT), t.n_tokens, t.cells
FROM a_rows, LATERAL (
  SELECT 0 AS line_no, 4 AS n_tokens, 'Lab report|~|~|~' AS cells WHERE k % 3 >= 1
  UNION ALL SELECT 1, 2, 'Generated:|file ' || CAST(k AS VARCHAR) WHERE k % 3 = 2
  UNION ALL SELECT k % 3, 0, '' WHERE k % 6 = 5
  UNION ALL SELECT top_rows, 7, 'c_custkey|c_name|~|c_nationkey|c_acctbal_cents|c_mktsegment|c_mktsegment') t
WHERE k % 10 <> 9""",
)
def raw_grid_scan(spark, sf_dir):
    grid = read_grid(spark, I.messy_files(spark, sf_dir))
    return grid.select("file_name", "line_no", "n_tokens", I.shown(F.col("cells")).alias("cells"))


@query("table_roundtrip", f"WITH {I.LONG_SQL} SELECT * FROM long WHERE vendor_id = 'vendor_b'")
def table_roundtrip(spark, sf_dir):
    """Write a partitioned table, read back one partition by name."""
    name = "longform_cells"
    S.overwrite_table(I.long_cells(spark, sf_dir), name, partition_by=("vendor_id",), path=scratch_path(spark, "table"))
    cells = spark.table(name).filter("vendor_id = 'vendor_b'")
    return cells.select("vendor_id", "file_name", "row_index", "column_index", "lab_provided_attribute", "lab_provided_value")


@query(
    "append_merge_schema",
    "SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier",
)
def append_merge_schema(spark, sf_dir):
    path = scratch_path(spark, "merged")
    a = I.customers(spark, sf_dir)
    b = I.suppliers(spark, sf_dir)
    S.append_path(a.selectExpr("c_custkey key", "c_name name", "c_nationkey nation", "c_mktsegment segment"), path)
    S.append_path(b.selectExpr("s_suppkey key", "s_name name", "s_nationkey nation"), path)
    return S.read_merged(spark, path).select("key", "name", "nation", "segment")


@query("append_long", f"WITH {I.LONG_SQL} SELECT * FROM long")
def append_long(spark, sf_dir):
    """To a named table, in two appends that must have its schema."""
    name = f"longform_append_{uuid.uuid4().hex}"
    cells = I.long_cells(spark, sf_dir)
    for vendor in ("vendor_a", "vendor_b"):
        S.append_table(cells.filter(F.col("vendor_id") == vendor), name)
    return spark.table(name)


@query(
    "file_provenance",
    "SELECT o_orderkey, 'orders.parquet' AS source_file_name, 'vendor_a' AS data_source, "
    "true AS has_path, true AS has_run FROM orders",
)
def file_provenance(spark, sf_dir):
    """Run-dependent values are compared by their presence."""
    stamped = provenance.with_provenance(table(spark, sf_dir, "orders"), "vendor_a")
    return stamped.select(
        "o_orderkey",
        "source_file_name",
        "data_source",
        F.col("source_file_path").endswith("/orders.parquet").alias("has_path"),
        (F.length("ingestion_id") == 36).alias("has_run"),
    )


@query(
    "file_row_number",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS file_row_number FROM orders",
)
def file_row_number(spark, sf_dir):
    """The orders file is written in key order, so its row numbers follow the key."""
    return provenance.with_file_row_number(table(spark, sf_dir, "orders")).select("o_orderkey", "file_row_number")


# -- grid operators ------------------------------------------------------------


def _grid_row(columns: list[int]) -> str:
    """SQL for a row of the order grid as text, over 0-based source columns."""
    short = [c for c in columns if c < 5]
    text = lambda cs: " || '|' || ".join(f"coalesce({I.GRID_VALUES[c]}, '~')" for c in cs)
    return f"CASE WHEN o_orderkey % 7 = 0 THEN {text(short)} ELSE {text(columns)} END"


GRID_TOPS_SQL = """SELECT DISTINCT o_orderpriority AS file_id, CAST(0 AS BIGINT) AS line_no, 'Report|' || o_orderpriority AS cells FROM orders
UNION ALL SELECT DISTINCT o_orderpriority, 1, '~|~|~|~|~|~|~' FROM orders
UNION ALL SELECT DISTINCT o_orderpriority, 2, 'order|customer|status|~|price|status|~' FROM orders"""


@query(
    "grid_null_cells",
    f"SELECT o_orderpriority AS file_id, o_orderkey + 3 AS line_no, {_grid_row(list(range(7)))} AS cells FROM orders\n"
    f"UNION ALL\n{GRID_TOPS_SQL}",
)
def grid_null_cells(spark, sf_dir):
    return H.null_cells(I.order_grid(spark, sf_dir)).withColumn("cells", I.shown(F.col("cells")))


HEADER_SQL = (
    "SELECT DISTINCT o_orderpriority AS file_id, CAST(2 AS BIGINT) AS header_line_no, "
    "'order|customer|status||price|status|~' AS header_cells FROM orders"
)


def _shown_header(header: DataFrame) -> DataFrame:
    return header.withColumn("header_cells", I.shown(F.col("header_cells")))


@query("detect_header", HEADER_SQL)
def detect_header(spark, sf_dir):
    return _shown_header(H.detect_header(I.order_grid(spark, sf_dir), 5))


@query("detect_header_peek", HEADER_SQL)
def detect_header_peek(spark, sf_dir):
    return _shown_header(H.detect_header(I.order_grid(spark, sf_dir), 5, peek=10))


LATE_FILES = ("1-URGENT", "5-LOW")


@query("detect_header_beyond_peek", f"SELECT * FROM ({HEADER_SQL}) WHERE file_id NOT IN {LATE_FILES}")
def detect_header_beyond_peek(spark, sf_dir):
    """Two files begin with twelve more lines, so their headers lie beyond the peek and are not found."""
    grid = I.order_grid(spark, sf_dir)
    late = F.when(F.col("file_id").isin(*LATE_FILES), F.col("line_no") + 12).otherwise(F.col("line_no"))
    return _shown_header(H.detect_header(grid.withColumn("line_no", late), 5, peek=10))


ARGMAX_SQL = f"""WITH grid AS (
  SELECT o_orderpriority AS file_id, o_orderkey + 3 AS line_no,
         CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 7 END - CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS n,
         {_grid_row(list(range(7)))} AS cells
  FROM orders WHERE o_orderkey + 3 < 10
  UNION ALL SELECT DISTINCT o_orderpriority, 0, 2, 'Report|' || o_orderpriority FROM orders
  UNION ALL SELECT DISTINCT o_orderpriority, 2, 5, 'order|customer|status|~|price|status|~' FROM orders),
ranked AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY n DESC, line_no) AS r FROM grid)
SELECT file_id, CAST(line_no AS BIGINT) AS header_line_no, cells AS header_cells FROM ranked WHERE r = 1"""


@query("detect_header_argmax", ARGMAX_SQL)
def detect_header_argmax(spark, sf_dir):
    """Orders below line 10 fill more cells than the header row does, and win: that is the rule."""
    found = H.detect_header_argmax(H.null_cells(I.order_grid(spark, sf_dir)))
    return _shown_header(found)


@query(
    "detect_header_by_vendor",
    f"""WITH {I.FILES_SQL}
SELECT DISTINCT file_name, 'vendor_a' AS vendor_id, CAST(top_rows AS BIGINT) AS header_line_no, 6 AS named_columns
FROM a_rows WHERE k % 10 <> 9
UNION ALL
SELECT DISTINCT file_name, 'vendor_b', CAST(0 AS BIGINT), CASE WHEN k % 10 = 9 THEN 2 ELSE 4 END FROM b_rows""",
)
def detect_header_by_vendor(spark, sf_dir):
    """A header of vendor B needs only two filled cells, so none of its files fails."""
    found = landing(spark, sf_dir, {"vendor_a": 6, "vendor_b": 2}).headers
    return found.select("file_name", "vendor_id", "header_line_no", F.size("columns").alias("named_columns"))


@query(
    "skip_metadata_rows",
    f"SELECT o_orderpriority AS file_id, o_orderkey + 1 AS row_index, "
    f"{_grid_row(list(range(7)))} AS cells FROM orders",
)
def skip_metadata_rows(spark, sf_dir):
    grid = I.order_grid(spark, sf_dir)
    body = H.after_header(H.null_cells(grid), H.detect_header(grid, 5))
    return body.select("file_id", "row_index", I.shown(F.col("cells")).alias("cells"))


@query(
    "drop_unnamed_columns",
    f"SELECT o_orderpriority AS file_id, o_orderkey + 1 AS row_index, "
    f"{_grid_row([0, 1, 2, 4, 5])} AS cells FROM orders",
)
def drop_unnamed_columns(spark, sf_dir):
    grid = H.null_cells(I.order_grid(spark, sf_dir))
    body = H.drop_unnamed_columns(grid, H.detect_header(grid, 5))
    return body.select("file_id", "row_index", I.shown(F.col("cells")).alias("cells"))


@query(
    "dedupe_header",
    "SELECT DISTINCT o_orderpriority AS file_id, 'order,customer,status,price,status_1' AS names, "
    "'1,2,3,5,6' AS positions FROM orders",
)
def dedupe_header(spark, sf_dir):
    columns = H.with_columns(H.detect_header(I.order_grid(spark, sf_dir), 5))
    return columns.select(
        "file_id",
        F.array_join(F.transform("columns", lambda c: c["name"]), ",").alias("names"),
        F.array_join(F.transform("columns", lambda c: c["source_column_index"].cast("string")), ",").alias("positions"),
    )


UNPIVOT_SQL = "\nUNION ALL\n".join(
    f"SELECT o_orderpriority AS file_id, o_orderkey + 1 AS row_index, CAST({i} AS INTEGER) AS column_index, "
    f"'{name}' AS lab_provided_attribute, {I.GRID_VALUES[at]} AS lab_provided_value, "
    f"CAST({at + 1} AS INTEGER) AS source_column_index FROM orders{' WHERE o_orderkey % 7 <> 0' if at >= 5 else ''}"
    for i, (name, at) in enumerate([("order", 0), ("customer", 1), ("status", 2), ("price", 4), ("status_1", 5)], start=1)
)


@query("unpivot_cells", UNPIVOT_SQL)
def unpivot_cells(spark, sf_dir):
    grid = I.order_grid(spark, sf_dir)
    return C.unpivot_cells(grid, H.detect_header(grid, 5)).drop("source_line_no")


LINE_COLUMNS = [
    ("l_quantity", "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"),
    ("l_returnflag", "l_returnflag"),
    ("l_linestatus", "l_linestatus"),
    ("l_shipdate", "strftime(l_shipdate, '%Y-%m-%d')"),
]


@query(
    "unpivot_columns",
    I.union_of_cells("lineitem", "l_orderkey, l_partkey, l_suppkey, l_linenumber", LINE_COLUMNS).replace(
        "1 AS column_index", "CAST(1 AS INTEGER) AS column_index"
    ),
)
def unpivot_columns(spark, sf_dir):
    """The largest table, its columns known: one scan, no join, no shuffle."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").select(
        *keys,
        F.col("l_quantity").cast("bigint").alias("l_quantity"),
        "l_returnflag",
        "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )
    return C.unpivot_columns(lines, keys)


# -- whole landing -------------------------------------------------------------

CELL_FIELDS = "file_name, row_index, column_index, lab_provided_attribute, lab_provided_value, vendor_id"


@query("ingest_long", f"WITH {I.FILE_CELLS_SQL}\nSELECT {CELL_FIELDS}, source_column_index FROM file_cells")
def ingest_long(spark, sf_dir):
    return landing(spark, sf_dir).cells.drop("file_id", "source_line_no", "ingestion_timestamp")


@query(
    "conform_bronze_schema",
    f"WITH {I.FILE_CELLS_SQL}\nSELECT CAST(row_index AS INTEGER) AS row_index, column_index, lab_provided_attribute, "
    "lab_provided_value, vendor_id, file_name, true AS has_timestamp FROM file_cells",
)
def conform_bronze_schema(spark, sf_dir):
    cells = C.conform_bronze(landing(spark, sf_dir).cells)
    return cells.withColumn("has_timestamp", F.col("ingestion_timestamp").isNotNull()).drop("ingestion_timestamp")


@query(
    "ingest_errors",
    f"""WITH {I.FILES_SQL}
SELECT DISTINCT file_name, 'Could not find header row.' AS error FROM a_rows WHERE k % 10 = 9
UNION ALL
SELECT DISTINCT file_name, 'Could not find header row.' FROM b_rows WHERE k % 10 = 9""",
)
def ingest_errors(spark, sf_dir):
    return landing(spark, sf_dir).errors.select("file_name", "error")


@query(
    "vendor_from_filename",
    "SELECT o_orderkey, CASE WHEN f LIKE 'vendor_a%' THEN 'vendor_a' WHEN f LIKE 'vendor_b%' THEN 'vendor_b' "
    "ELSE 'unknown' END AS vendor_id FROM (SELECT o_orderkey, "
    "CASE WHEN o_custkey % 3 = 0 THEN 'vendor_abc.csv' WHEN o_custkey % 3 = 1 THEN 'vendor_b_' || o_orderpriority "
    "ELSE o_orderpriority END AS f FROM orders)",
)
def vendor_from_filename(spark, sf_dir):
    key = F.col("o_custkey") % 3
    name = (
        F.when(key == 0, F.lit("vendor_abc.csv"))
        .when(key == 1, F.concat(F.lit("vendor_b_"), "o_orderpriority"))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", vendor_of(name).alias("vendor_id"))


@query(
    "cells_by_file",
    f"WITH {I.FILE_CELLS_SQL}\nSELECT vendor_id, file_name, count(*) AS count FROM file_cells GROUP BY 1, 2",
)
def cells_by_file(spark, sf_dir):
    return reports.cells_by_file(landing(spark, sf_dir).cells)


@query(
    "file_defects",
    f"""WITH {I.FILES_SQL}
SELECT DISTINCT file_name, CAST(top_rows AS BIGINT) AS metadata_rows, 1 AS unnamed_columns, 6 AS named_columns
FROM a_rows WHERE k % 10 <> 9
UNION ALL
SELECT DISTINCT file_name, CAST(0 AS BIGINT), 2, 4 FROM b_rows WHERE k % 10 <> 9""",
)
def file_defects(spark, sf_dir):
    headers = landing(spark, sf_dir).headers
    return checks.file_defects(headers.withColumn("file_id", F.col("file_name"))).withColumnRenamed("file_id", "file_name")


WIDE_SQL = f"""WITH {I.FILES_SQL}
SELECT 'vendor_a' AS vendor_id, file_name, row_index, v_key AS key, v_name AS name, v_nation AS nation,
       v_balance AS balance, v_segment AS segment FROM a_rows WHERE k % 10 <> 9
UNION ALL
SELECT 'vendor_b', file_name, row_index, v_key, CASE WHEN k % 2 = 0 THEN v_name END, v_nation, v_balance, NULL
FROM b_rows WHERE k % 10 <> 9
UNION ALL
SELECT 'vendor_a', file_name, row_index - 1, NULL, NULL, NULL, NULL, NULL FROM a_rows WHERE k % 10 = 9 AND row_index > 1
UNION ALL
SELECT 'vendor_b', file_name, row_index - 1, NULL, NULL, NULL, NULL, NULL FROM b_rows WHERE k % 10 = 9 AND row_index > 1"""


@query("ingest_wide", WIDE_SQL)
def ingest_wide(spark, sf_dir):
    """In a file without a header the fullest row is taken for one, as the wide path's rule says."""
    return land_wide(spark, I.messy_files(spark, sf_dir), SUPERSET, I.RENAMES)


@query("append_wide", WIDE_SQL)
def append_wide_loads(spark, sf_dir):
    """Vendor B's files start a named table without ``segment``; vendor A's are appended to it and bring that column."""
    path, name = I.messy_files(spark, sf_dir), f"longform_wide_{uuid.uuid4().hex}"
    for vendor, columns in (("vendor_b", SUPERSET[:4]), ("vendor_a", SUPERSET)):
        append_wide(spark, f"{path}/file={vendor}_*", name, columns, I.RENAMES)
    return spark.table(name)


@query("incremental_files", f"WITH {I.FILE_CELLS_SQL}\nSELECT {CELL_FIELDS} FROM file_cells")
def incremental_files(spark, sf_dir):
    """Vendor A lands in a first run of the stream, vendor B in a second one."""
    path, out, ckpt = I.messy_files(spark, sf_dir), scratch_path(spark, "stream"), scratch_path(spark, "stream-ckpt")
    for folder in ("file=vendor_a_*", "file=vendor_*"):
        stream_long(spark, f"{path}/{folder}", out, ckpt, threshold=4, max_files=100_000).awaitTermination()
    return landed(spark, out).select(*[c.strip() for c in CELL_FIELDS.split(",")])


@query(
    "incremental_ledger",
    f"""WITH {I.FILES_SQL}
SELECT DISTINCT file_name FROM a_rows UNION ALL SELECT DISTINCT file_name FROM b_rows WHERE k % 10 <> 9""",
)
def incremental_ledger(spark, sf_dir):
    """Files left to load when the ledger lists vendor B's files without a header."""
    folder = I.messy_files(spark, sf_dir)
    text = spark.read.option("recursiveFileLookup", True).text(folder)
    files = text.select(F.col("_metadata.file_path").alias("file_id")).distinct()
    files = files.withColumn("file_name", logical_file_name(F.col("file_id")))
    ledger = landing(spark, sf_dir).errors.filter(F.col("file_name").startswith("vendor_b"))
    return new_files(files, ledger).select("file_name")


class _Crash(Exception):
    pass


def _crash(note):
    raise _Crash


def _ledger(spark, sf_dir) -> str:
    """Vendor B's files land in a run that fails before it is published; the next run takes up both vendors."""
    path, out = I.messy_files(spark, sf_dir), scratch_path(spark, "ledger")
    try:
        land_new(spark, f"{path}/file=vendor_b_*", out, threshold=4, before_publish=_crash)
    except _Crash:
        pass
    land_new(spark, path, out, threshold=4)
    return out


@query("ledger_cells", f"WITH {I.FILE_CELLS_SQL}\nSELECT {CELL_FIELDS} FROM file_cells")
def ledger_cells(spark, sf_dir):
    """Every file's cells once, although the first run failed between writing and publishing."""
    return landed_table(spark, _ledger(spark, sf_dir)).select(*[c.strip() for c in CELL_FIELDS.split(",")])


@query(
    "ledger_files",
    f"""WITH {I.FILES_SQL}
SELECT DISTINCT file_name, 1 AS run_no FROM b_rows UNION ALL SELECT DISTINCT file_name, 2 FROM a_rows""",
)
def ledger_files(spark, sf_dir):
    """Which published run each file belongs to: the failed run's files are not landed again."""
    out = _ledger(spark, sf_dir)
    runs = [m["run"] for m in published(spark, out)]  # one for each run of the ledger
    number = F.coalesce(*[F.when(F.col("run") == r, F.lit(n)) for n, r in enumerate(runs, 1)])
    return landed_table(spark, out, "files").select("file_name", number.alias("run_no"))


@query(
    "parse_warnings",
    f"""WITH {I.FILES_SQL}
SELECT file_name, count(*) AS row_count, count(*) FILTER (c_custkey % 11 = 0) AS short_rows, 0::BIGINT AS long_rows,
       CASE WHEN count(*) FILTER (c_custkey % 11 = 0) > 0 THEN 1 ELSE 0 END AS warnings
FROM a_rows WHERE k % 10 <> 9 GROUP BY file_name
UNION ALL SELECT file_name, count(*), 0, 0, 0 FROM b_rows WHERE k % 10 <> 9 GROUP BY file_name
UNION ALL SELECT DISTINCT file_name, NULL, NULL, NULL, NULL FROM a_rows WHERE k % 10 = 9
UNION ALL SELECT DISTINCT file_name, NULL, NULL, NULL, NULL FROM b_rows WHERE k % 10 = 9""",
)
def parse_warnings(spark, sf_dir):
    """Files by the oddities of their rows; those without a header have none to judge."""
    found = warnings_of(spark, I.messy_files(spark, sf_dir), threshold=4)
    return found.select("file_name", "row_count", "short_rows", "long_rows", "warnings")
