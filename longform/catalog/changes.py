"""Queries over what changes: mapping versions, files and their checksums, the mapping tables of the domain."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.catalog import inputs as I
from longform.catalog.registry import query, table
from longform.operators import silver as Z
from longform.operators.cells import unpivot_columns
from longform.operators.drift import DriftHistory
from longform.operators.records import pivot_records, unpivot_records
from longform.operators.similar_names import near_names
from longform.plans.mapping_changes import SilverTable, save_version
from longform.sources import reference_data as R, tables as S
from longform.sources.checksums import BASES, PRIME, file_checksums as checksums_of
from longform.sources.clustered import ClusteredTable
from longform.sources.dictionary import Dictionary
from longform.sources.schema_log import GrowingTable
from longform.sources.storage import scratch_path

# -- mapping versions ------------------------------------------------------------

_CHANGED = {("vendor_a", "c_nationkey"): "col_key", ("vendor_a", "c_mktsegment"): "col_opened", ("vendor_b", "s_name"): None}
#: The mapping after a change: one key points elsewhere, one is new, one is gone.
NEW_MAPPING = [
    *[row for row in I.MAPPING if row[:2] not in _CHANGED],
    *[(*key, R.key_of(seed), "second version") for key, seed in _CHANGED.items() if seed],
]
NEW_SQL = I.values_cte("mapping", I.MAPPING_FIELDS, NEW_MAPPING) + ",\n" + I.values_cte("canonical", I.CANONICAL_FIELDS, I.CANONICAL)


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, SilverTable, DataFrame, DataFrame]:
    """Cells, the silver table made with the first mapping, then mended with the second; and its files before and after."""
    cells, store = I.long_cells(spark, sf_dir), scratch_path(spark, "mapping-versions")
    silver = SilverTable(spark, scratch_path(spark, "silver"))
    files = lambda: silver.read(cells).select("vendor_id", "lab_provided_attribute", F.col("_metadata.file_name").alias("part")).distinct()
    save_version(spark, store, I.mapping(spark), I.canonical(spark))
    silver.refresh(cells, store)
    before = spark.createDataFrame(files().collect(), files().schema)  # one row per file of silver
    save_version(spark, store, R.inline(spark, I.MAPPING_FIELDS, NEW_MAPPING), I.canonical(spark))
    silver.refresh(cells, store)
    return cells, silver, before, files()


@query(
    "mapping_refresh",
    f"""WITH {I.LONG_SQL}, {NEW_SQL}
SELECT l.*, c.canonical_column_id, c.canonical_column_name, c.column_category, c.data_type
FROM long l LEFT JOIN mapping m ON l.lab_provided_attribute = m.vendor_column_name AND l.vendor_id = m.vendor_id
LEFT JOIN canonical c ON m.canonical_column_id = c.canonical_column_id""",
)
def mapping_refresh(spark, sf_dir):
    """Silver after a change of the mapping, of which only the changed keys were standardised again."""
    cells, silver, _, _ = _two_versions(spark, sf_dir)
    return silver.read(cells)


@query(
    "mapping_refresh_folders",
    f"""WITH {I.LONG_SQL}
SELECT DISTINCT vendor_id, lab_provided_attribute,
       lab_provided_attribute IN ({', '.join(f"'{name}'" for _, name in _CHANGED)}) AS written_anew FROM long""",
)
def mapping_refresh_folders(spark, sf_dir):
    """Which folders of silver have other files after the change."""
    _, _, before, after = _two_versions(spark, sf_dir)
    keys = ["vendor_id", "lab_provided_attribute"]
    stayed = before.join(after, [*keys, "part"], "left_semi").select(*keys).distinct().withColumn("stayed", F.lit(True))
    return after.select(*keys).distinct().join(stayed, keys, "left").select(*keys, F.col("stayed").isNull().alias("written_anew"))


# -- files -----------------------------------------------------------------------


def _powers_sql(name: str, base: int) -> str:
    return f"{name}(j, b) AS (SELECT 0::BIGINT, 1::BIGINT UNION ALL SELECT j + 1, b * {base} % {PRIME} FROM {name} WHERE j < (SELECT max(j) FROM lines))"


@query(
    "file_checksums",
    f"""WITH RECURSIVE lines AS (
  SELECT c_nationkey, concat_ws(',', c_custkey, c_name, c_mktsegment) AS line,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS j FROM customer
), {_powers_sql('p', BASES[0])}, {_powers_sql('q', BASES[1])}
SELECT 'nation=' || c_nationkey AS folder, sum(strlen(line) + 1)::BIGINT AS file_size, count(*) AS line_count, true AS ends_in_break,
       printf('%08x%08x', (sum(('0x' || substr(md5(line), 1, 7))::BIGINT * p.b % {PRIME}) % {PRIME})::BIGINT,
                          (sum(('0x' || substr(md5(line), 8, 7))::BIGINT * q.b % {PRIME}) % {PRIME})::BIGINT) AS checksum
FROM lines JOIN p USING (j) JOIN q USING (j) GROUP BY c_nationkey""",
)
def file_checksums(spark, sf_dir):
    """Customers as one text file per nation; size and checksum of each, formed by file splits."""
    path = scratch_path(spark, "lines")
    line = F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment").alias("value")
    lines = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), line)
    lines.repartition("nation").sortWithinPartitions("nation", "c_custkey").select("nation", "value").write.partitionBy("nation").text(path)
    found = checksums_of(spark, path)
    folder = F.regexp_extract("file_id", r"(nation=\d+)", 1).alias("folder")
    return found.select(folder, "file_size", "line_count", "ends_in_break", "checksum")


# -- the domain's own mapping tables ------------------------------------------------

_SAMPLES = [
    ("sample_barcode", "CAST(o_orderkey AS VARCHAR)"),
    ("date_received", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"),
    ("ph", "CAST(o_custkey % 14 AS VARCHAR)"),
    ("copper_ppm", "CAST(o_orderkey % 97 AS VARCHAR)"),
    ("acidity", "CAST(o_custkey % 13 AS VARCHAR)"),
    ("cu_total", "CAST(o_orderkey % 89 AS VARCHAR)"),
]
_DOMAIN_SQL = (
    I.values_cte("mapping", I.MAPPING_FIELDS, [(v, n, R.key_of(seed), notes.replace("'", "''")) for v, n, seed, notes in R.VENDOR_COLUMNS])
    + ",\n"
    + I.values_cte("canonical", I.CANONICAL_FIELDS, [(R.key_of(seed), *[x.replace("'", "''") for x in rest]) for seed, *rest in R.CANONICAL_COLUMNS])
)


@query(
    "domain_mapping",
    f"""WITH cells AS (
{I.union_of_cells('orders', "CASE WHEN o_orderkey % 2 = 0 THEN 'vendor_a' ELSE 'vendor_b' END AS vendor_id", _SAMPLES)}
), {_DOMAIN_SQL}
SELECT l.vendor_id, l.lab_provided_attribute, c.canonical_column_name, c.data_type, count(*) AS record_count,
       sum(TRY_CAST(CASE WHEN c.data_type = 'numeric' THEN l.lab_provided_value END AS BIGINT))::BIGINT AS total
FROM cells l LEFT JOIN mapping m ON l.lab_provided_attribute = m.vendor_column_name AND l.vendor_id = m.vendor_id
LEFT JOIN canonical c ON m.canonical_column_id = c.canonical_column_id GROUP BY ALL""",
)
def domain_mapping(spark, sf_dir):
    """Orders as two vendors' samples, standardised by the domain's tables after these went through CSV files."""
    loaded = []
    for name, df in (("mapping", R.vendor_column_mapping(spark)), ("canonical", R.canonical_column_definitions(spark))):
        path = scratch_path(spark, f"domain-{name}")
        S.write_csv(df, path, single_file=True)
        loaded.append(S.read_csv_text(spark, path))
    orders = table(spark, sf_dir, "orders")
    vendor = F.when(F.col("o_orderkey") % 2 == 0, "vendor_a").otherwise("vendor_b")
    texts = {name: F.expr(sql.replace("VARCHAR", "STRING")) for name, sql in _SAMPLES}
    samples = orders.select(vendor.alias("vendor_id"), *[c.alias(name) for name, c in texts.items()])
    cells = unpivot_columns(samples, ["vendor_id"], [name for name, _ in _SAMPLES])
    silver = Z.with_numeric_value(Z.standardize(cells, *loaded))
    return silver.groupBy("vendor_id", "lab_provided_attribute", "canonical_column_name", "data_type").agg(
        F.count("*").alias("record_count"), F.sum(F.col("numeric_value").cast("long")).alias("total")
    )


# -- widening, and names alike -------------------------------------------------------


@query(
    "append_widened",
    """SELECT CAST(c_custkey AS BIGINT) AS key, CAST(c_nationkey AS DOUBLE) AS score, CAST(c_nationkey AS VARCHAR) AS nation,
       CAST(NULL AS BIGINT) AS cents, NULL AS label FROM customer
UNION ALL SELECT s_suppkey + 10000000000, s_nationkey / 4, 'n' || s_nationkey, CAST(round(s_acctbal * 100) AS BIGINT), s_name FROM supplier""",
)
def append_widened(spark, sf_dir):
    """Suppliers bring wider types, a new field of a struct and a new column; customers' files stay and are read through casts."""
    grown = GrowingTable(spark, scratch_path(spark, "growing"))
    grown.append(I.customers(spark, sf_dir).selectExpr("CAST(c_custkey AS INT) key", "CAST(c_nationkey AS INT) score", "struct(CAST(c_nationkey AS INT) AS nation) info"))
    grown.append(
        I.suppliers(spark, sf_dir).selectExpr(
            "s_suppkey + 10000000000 AS key", "CAST(s_nationkey AS DOUBLE) / 4 AS score", "struct(concat('n', s_nationkey) AS nation, s_acctbal_cents AS cents) AS info", "s_name AS label"
        )
    )
    name = f"longform_grown_{uuid.uuid4().hex}"
    grown.register(name)
    return spark.sql(f"SELECT key, score, info.nation, info.cents, label FROM {name}")


@query(
    "similar_names",
    """WITH names AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS name FROM part
  UNION SELECT DISTINCT lower(split_part(p_type, ' ', 1)) FROM part UNION SELECT lower(n_name) FROM nation UNION SELECT lower(r_name) FROM region)
SELECT a.name, b.name AS other, levenshtein(a.name, b.name)::INT AS distance FROM names a, names b
WHERE a.name <> b.name AND levenshtein(a.name, b.name) <= 2""",
)
def similar_names(spark, sf_dir):
    """Different names of parts, types, nations and regions at most two edits apart."""
    part = table(spark, sf_dir, "part")
    first = lambda c: F.lower(F.split_part(F.col(c), F.lit(" "), F.lit(1))).alias("name")
    names = part.select(first("p_name")).union(part.select(first("p_type")))
    names = names.union(table(spark, sf_dir, "nation").select(F.lower("n_name"))).union(table(spark, sf_dir, "region").select(F.lower("r_name")))
    return near_names(names, names).where("name <> other")


# -- history ---------------------------------------------------------------------------

_LOADS = 4
_DRIFT_SQL = f"""WITH cells AS (
  SELECT o_orderstatus AS vendor_id, 'attribute ' || (o_custkey % 11) AS lab_provided_attribute, o_orderkey % {_LOADS} AS load
  FROM orders WHERE (o_custkey % 11 * 5 + o_orderkey % {_LOADS} * 3) % 4 <> 0
), counted AS (
  SELECT vendor_id, lab_provided_attribute, load, count(*) AS n FROM cells GROUP BY ALL
), seen AS (
  SELECT *, lag(load) OVER (PARTITION BY vendor_id, lab_provided_attribute ORDER BY load) AS before FROM counted
)"""


@query(
    "drift_history",
    f"""{_DRIFT_SQL}
SELECT vendor_id, lab_provided_attribute, min(load) AS first_seen, max(load) AS last_seen, count(*) AS load_count,
       count(*) FILTER (before IS NULL OR before < load - 1) AS spells, sum(n)::BIGINT AS record_count
FROM seen GROUP BY ALL""",
)
def drift_history(spark, sf_dir):
    """Orders arrive in four loads, with attributes that come and go; the state after the last one."""
    cells = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("vendor_id"),
        F.concat(F.lit("attribute "), F.col("o_custkey") % 11).alias("lab_provided_attribute"),
        (F.col("o_orderkey") % _LOADS).alias("load"),
        (F.col("o_custkey") % 11 * 5).alias("shift"),
    )
    cells = cells.where((F.col("shift") + F.col("load") * 3) % 4 != 0)
    history = DriftHistory(spark, scratch_path(spark, "drift"))
    for load in range(_LOADS):
        history.record(cells.where(F.col("load") == load), load)
    return history.state()


@query(
    "dense_ids",
    """WITH a AS (SELECT DISTINCT c_name AS name FROM customer WHERE c_custkey % 3 = 0),
b AS (SELECT c_name AS name FROM customer UNION SELECT s_name FROM supplier)
SELECT name, row_number() OVER (ORDER BY name) - 1 AS id FROM a
UNION ALL SELECT name, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY name) - 1 FROM b WHERE name NOT IN (SELECT name FROM a)""",
)
def dense_ids(spark, sf_dir):
    """Some customers' names are numbered first, then all customers' and suppliers'; the first numbers stay."""
    dictionary = Dictionary(spark, scratch_path(spark, "dictionary"))
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    dictionary.extend(customer.where("c_custkey % 3 = 0").select("c_name"))
    return dictionary.extend(customer.select("c_name").union(supplier.select("s_name")))


# -- layout ------------------------------------------------------------------------------

_NAMES = sorted(name for name, _ in [*I.A_COLUMNS, *I.B_COLUMNS])


def _records_sql() -> str:
    parts = []
    for columns, vendor, source, key in ((I.A_COLUMNS, "vendor_a", "customer", "c_custkey"), (I.B_COLUMNS, "vendor_b", "supplier", "s_suppkey")):
        known = dict(columns)
        values = ", ".join(f"{known.get(n, 'CAST(NULL AS VARCHAR)')} AS {n}" for n in _NAMES)
        parts.append(f"SELECT '{vendor}' AS vendor_id, {key} AS row_index, {values} FROM {source}")
    return " UNION ALL ".join(parts)


@query("pivot_records", _records_sql())
def records_of_cells(spark, sf_dir):
    """Both vendors' cells as one record per row; the columns are those that the records turn out to have."""
    return pivot_records(I.long_cells(spark, sf_dir), ["vendor_id", "row_index"]).columns()


@query("unpivot_records", f"WITH {I.LONG_SQL} SELECT vendor_id, row_index, lab_provided_attribute, lab_provided_value FROM long")
def cells_of_records(spark, sf_dir):
    """Cells to records and back."""
    return unpivot_records(pivot_records(I.long_cells(spark, sf_dir), ["vendor_id", "row_index"]).df)


_CLUSTERED = ("vendor_id", "lab_provided_attribute", "file_name")


def _clustered(spark: SparkSession, sf_dir: str) -> ClusteredTable:
    """Orders as cells, laid out along the curve in 64 files or so."""
    cells = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("vendor "), "o_orderstatus").alias("vendor_id"),
        F.concat(F.lit("attribute "), (F.col("o_custkey") % 23).cast("string")).alias("lab_provided_attribute"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit(".csv")).alias("file_name"),
        F.col("o_orderkey").alias("row_index"),
        F.col("o_orderpriority").alias("lab_provided_value"),
    )
    made = ClusteredTable(spark, scratch_path(spark, "clustered"), _CLUSTERED)
    made.write(cells, rows_per_file=max(1, cells.count() // 64))
    return made


_CELLS_OF_ORDERS = """SELECT 'vendor ' || o_orderstatus AS vendor_id, 'attribute ' || (o_custkey % 23) AS lab_provided_attribute,
  strftime(o_orderdate, '%Y-%m') || '.csv' AS file_name, o_orderkey AS row_index, o_orderpriority AS lab_provided_value FROM orders"""


@query("clustered_read", f"WITH cells AS ({_CELLS_OF_ORDERS}) SELECT * FROM cells WHERE lab_provided_attribute IN ('attribute 3', 'attribute 17') AND vendor_id = 'vendor F'")
def clustered_read(spark, sf_dir):
    """Cells of two attributes of one vendor, from the files whose zones hold them."""
    return _clustered(spark, sf_dir).read({"lab_provided_attribute": ["attribute 3", "attribute 17"], "vendor_id": ["vendor F"]})


_ASKED = [("vendor_id", "vendor P"), ("lab_provided_attribute", "attribute 8"), ("file_name", "1997-03.csv")]


@query(
    "clustered_zones",
    f"WITH cells AS ({_CELLS_OF_ORDERS}) "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS row_count, true AS skips_files FROM cells WHERE {c} = '{v}'" for c, v in _ASKED),
)
def clustered_zones(spark, sf_dir):
    """For a filter on each of the columns: the rows it finds, and whether a third of the files at least stay closed."""
    made = _clustered(spark, sf_dir)
    whole = made.zones().agg(F.count("*").alias("files"))
    found = None
    for column, value in _ASKED:
        opened = made.files_for({column: [value]}).agg(F.count("*").alias("opened"))
        rows = made.read({column: [value]}).agg(F.count("*").alias("row_count"))
        one = rows.join(opened).join(whole).select(F.lit(column).alias("column_name"), "row_count", (F.col("opened") * 3 <= F.col("files") * 2).alias("skips_files"))
        found = one if found is None else found.unionByName(one)
    return found
