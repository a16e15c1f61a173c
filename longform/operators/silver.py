"""Standardising long cells through mapping tables, and typing wide rows.

``mapping``: vendor_id, vendor_column_name, canonical_column_id, notes.
``canonical``: canonical_column_id, canonical_column_name, column_category, data_type, description.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.functions.values import numeric_value, to_day, to_number
from longform.sources.storage import deal_hot, fits_broadcast, join_small

CANONICAL_COLUMNS = ["canonical_column_id", "canonical_column_name", "column_category", "data_type"]


def _spread(cells: DataFrame) -> list[str]:
    """Columns that tell cells of one attribute apart; a salt is taken from them."""
    return [c for c in ("file_id", "file_name", "row_index") if c in cells.columns] or cells.columns


def resolved_mapping(mapping: DataFrame, canonical: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The mapping with its canonical columns looked up: both sides are small.

    An id that the canonical table lacks yields nulls, as two chained left joins would.
    """
    ids = mapping.select(*keep, F.col("canonical_column_id").alias("_mapped_id"))
    known = canonical.select(*CANONICAL_COLUMNS, F.col("canonical_column_id").alias("_mapped_id"))
    return ids.join(known, "_mapped_id", "left").drop("_mapped_id")


def standardize(cells: DataFrame, mapping: DataFrame, canonical: DataFrame) -> DataFrame:
    """Left-join cells to their canonical column by exact attribute and vendor.

    Unmapped cells stay, with nulls. The two dimension tables are joined with each
    other first, so the cells pass through one join. A mapping row that occurs twice
    repeats cells; ``mapping_integrity`` finds such rows.
    """
    lookup = resolved_mapping(mapping, canonical, ["vendor_id", "vendor_column_name"]).withColumnRenamed(
        "vendor_column_name", "lab_provided_attribute"
    )
    joined = join_small(cells, lookup, ["lab_provided_attribute", "vendor_id"], "left", _spread(cells))
    return joined.select(*cells.columns, *CANONICAL_COLUMNS)


RESOLVE_SQL = """
SELECT mapping.vendor_id,
       mapping.vendor_column_name AS lab_provided_attribute,
       canonical.canonical_column_id,
       canonical.canonical_column_name,
       canonical.column_category,
       canonical.data_type
FROM {mapping} AS mapping
LEFT JOIN {canonical} AS canonical
  ON mapping.canonical_column_id = canonical.canonical_column_id
"""

STANDARDIZE_SQL = """
SELECT cells.* EXCEPT (_salt),
       known.canonical_column_id,
       known.canonical_column_name,
       known.column_category,
       known.data_type
FROM {cells} AS cells
LEFT JOIN {known} AS known
  ON cells.lab_provided_attribute = known.lab_provided_attribute
 AND cells.vendor_id = known.vendor_id
 AND cells._salt = known._salt
"""


def standardize_sql(spark: SparkSession, cells: DataFrame, mapping: DataFrame, canonical: DataFrame) -> DataFrame:
    """``standardize`` as SQL text. The mapping with its canonical columns is broadcast after a check of its size; beyond it hot keys are dealt."""
    known = spark.sql(RESOLVE_SQL, mapping=mapping, canonical=canonical)
    keys = ["lab_provided_attribute", "vendor_id"]
    if fits_broadcast(known):
        cells, known = cells.withColumn("_salt", F.lit(0)), F.broadcast(known.withColumn("_salt", F.lit(0)))
    else:
        cells, known = deal_hot(cells, known, keys, _spread(cells))
    return spark.sql(STANDARDIZE_SQL, cells=cells, known=known)


def standardize_by_attribute(cells: DataFrame, mapping: DataFrame, canonical: DataFrame) -> DataFrame:
    """``standardize`` without the vendor: a name two vendors use repeats its cells."""
    lookup = resolved_mapping(mapping, canonical, ["vendor_column_name"]).withColumnRenamed(
        "vendor_column_name", "lab_provided_attribute"
    )
    joined = join_small(cells, lookup, ["lab_provided_attribute"], "left", _spread(cells))
    return joined.select(*cells.columns, *CANONICAL_COLUMNS)


def map_one_step(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left-join cells to the mapping alone, by attribute."""
    lookup = mapping.select(
        F.col("vendor_column_name").alias("lab_provided_attribute"),
        F.col("vendor_id").alias("mapping_vendor_id"),
        "canonical_column_id",
    )
    joined = join_small(cells, lookup, ["lab_provided_attribute"], "left", _spread(cells))
    return joined.select(*cells.columns, "mapping_vendor_id", "canonical_column_id")


def mapped_only(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("canonical_column_id").isNotNull())


def with_numeric_value(silver: DataFrame) -> DataFrame:
    """Adds the number a cell holds where its canonical type is numeric."""
    return silver.withColumn("numeric_value", numeric_value("lab_provided_value", "data_type"))


def mapping_integrity(mapping: DataFrame, canonical: DataFrame) -> DataFrame:
    """What is wrong with a pair of mapping tables: problem, key, occurrences.

    ``duplicate_canonical``: a canonical id defined more than once;
    ``duplicate_mapping``: a vendor column mapped more than once;
    ``dangling_mapping``: a mapping to an id that is not defined.
    """
    twice = (
        canonical.groupBy(F.col("canonical_column_id").alias("key"))
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
        .select(F.lit("duplicate_canonical").alias("problem"), "key", "occurrences")
    )
    again = (
        mapping.groupBy("vendor_id", "vendor_column_name")
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
        .select(F.lit("duplicate_mapping").alias("problem"), F.concat_ws("|", "vendor_id", "vendor_column_name").alias("key"), "occurrences")
    )
    # counting per id first leaves one row per id to compare, whatever id is hot
    used = mapping.groupBy("canonical_column_id").agg(F.count("*").alias("occurrences"))
    dangling = used.join(canonical.select("canonical_column_id"), "canonical_column_id", "left_anti").select(
        F.lit("dangling_mapping").alias("problem"), F.col("canonical_column_id").alias("key"), "occurrences"
    )
    return twice.unionByName(again).unionByName(dangling)


def mapping_synonyms(mapping: DataFrame) -> DataFrame:
    """Canonical ids reached from more than one vendor column, with the distinct counts."""
    return (
        mapping.groupBy("canonical_column_id")
        .agg(
            F.count_distinct("vendor_id").alias("vendor_count"),
            F.count_distinct("vendor_column_name").alias("name_count"),
            F.min("vendor_column_name").alias("first_name"),
            F.max("vendor_column_name").alias("last_name"),
        )
        .filter(F.col("name_count") > 1)
    )


def typed(
    bronze: DataFrame,
    dates: Sequence[str] = (),
    numbers: Sequence[str] = (),
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """A wide all-text table with real types. Text that is no date or number gives null."""
    out = bronze.withColumnsRenamed(dict(renames)) if renames else bronze
    changes = {c: to_day(c) for c in dates} | {c: to_number(c) for c in numbers}
    return out.withColumns({**changes, "silver_processed_at": F.current_timestamp()})
