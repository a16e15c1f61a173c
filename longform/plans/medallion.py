"""The two pipelines over named tables: typed wide files, and standardised long cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from longform.functions.dialect import CsvDialect
from longform.operators.cells import conform_bronze, number_across_files
from longform.operators.provenance import with_provenance, with_row_id
from longform.operators.reports import monthly_summary
from longform.operators.silver import standardize, typed
from longform.plans.bronze import Landing, land_long
from longform.sources.tables import ensure_layers, overwrite_table, read_csv_text

# The layers' column names for clean soil files.
DATES = ("date_received", "date_processed")
MEASURES = ("ph", "copper_ppm", "zinc_ppm")
SILVER_RENAMES = {"_metadata": "databricks_ingestion_metadata", "data_source": "vendor_name"}


def clean_medallion(
    spark: SparkSession,
    path: str,
    vendor: str,
    bronze: str = "bronze.vendor_a_samples_raw",
    silver: str = "silver.vendor_a_samples_cleaned",
    gold: str = "gold.monthly_vendor_a_summary",
    format: str = "parquet",
    layers: Sequence[str] = ("bronze", "silver", "gold"),
) -> DataFrame:
    """Clean CSV files to raw, typed and monthly tables. Returns the gold table."""
    ensure_layers(spark, *layers)
    raw = with_row_id(with_provenance(read_csv_text(spark, path), vendor))
    overwrite_table(raw, bronze, format)
    overwrite_table(typed(spark.table(bronze), DATES, MEASURES, SILVER_RENAMES), silver, format)
    summary = monthly_summary(
        spark.table(silver), "date_received", "vendor_name", "sample_barcode", "ph", ("copper_ppm", "zinc_ppm")
    )
    overwrite_table(summary, gold, format)
    return spark.table(gold).orderBy("month_start")


def long_medallion(
    spark: SparkSession,
    path: str,
    mapping: DataFrame,
    canonical: DataFrame,
    bronze: str = "bronze.lab_samples_unpivoted",
    silver: str = "silver.lab_samples_standardized",
    dialect: CsvDialect = CsvDialect(),
    threshold: int = 5,
    format: str = "parquet",
    layers: Sequence[str] = ("bronze", "silver"),
) -> Landing:
    """Messy CSV files to the long bronze table and the standardised silver table.

    Both tables are laid out by vendor, so a report on one vendor reads only its
    files. Rows of part files of one name are numbered on, as the fixed schema has no other key. Returns the landing, whose ``errors`` list the files that failed.
    """
    ensure_layers(spark, *layers)
    landing = land_long(spark, path, dialect, threshold=threshold)
    overwrite_table(conform_bronze(number_across_files(landing.cells, landing.headers)), bronze, format, ("vendor_id",))
    overwrite_table(standardize(spark.table(bronze), mapping, canonical), silver, format, ("vendor_id",))
    return landing
