"""The two mapping tables for soil-laboratory files.

They are inline relations: Spark knows their exact size and plans with it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

# Key seed, canonical name, category, data type, description.
CANONICAL_COLUMNS = [
    ("col_ph", "ph", "measurement", "numeric", "Soil pH level"),
    ("col_copper", "copper_ppm", "measurement", "numeric", "Copper concentration in ppm"),
    ("col_zinc", "zinc_ppm", "measurement", "numeric", "Zinc concentration in ppm"),
    ("col_lead", "lead_ppm", "measurement", "numeric", "Lead concentration in ppm"),
    ("col_iron", "iron_ppm", "measurement", "numeric", "Iron concentration in ppm"),
    ("col_manganese", "manganese_ppm", "measurement", "numeric", "Manganese concentration in ppm"),
    ("col_boron", "boron_ppm", "measurement", "numeric", "Boron concentration in ppm"),
    ("col_molybdenum", "molybdenum_ppm", "measurement", "numeric", "Molybdenum concentration in ppm"),
    ("col_sulfur", "sulfur_ppm", "measurement", "numeric", "Sulfur concentration in ppm"),
    ("col_organic_matter", "organic_matter_pct", "measurement", "numeric", "Organic matter percentage"),
    ("col_ec", "electrical_conductivity", "measurement", "numeric", "Electrical conductivity in mS/cm"),
    ("col_sample_barcode", "sample_barcode", "sample_identifier", "string", "Unique sample barcode/ID"),
    ("col_lab_id", "lab_id", "lab_metadata", "string", "Laboratory identifier"),
    ("col_date_received", "date_received", "date", "date", "Sample receipt date"),
    ("col_date_analyzed", "date_analyzed", "date", "date", "Analysis date"),
]

# Vendor, vendor's column name, key seed of its canonical column, notes.
VENDOR_COLUMNS = [
    ("vendor_a", "ph", "col_ph", "Direct pH measurement"),
    ("vendor_a", "copper_ppm", "col_copper", "Copper in ppm"),
    ("vendor_a", "zinc_ppm", "col_zinc", "Zinc in ppm"),
    ("vendor_a", "lead_ppm", "col_lead", "Lead in ppm"),
    ("vendor_a", "iron_ppm", "col_iron", "Iron in ppm"),
    ("vendor_a", "manganese_ppm", "col_manganese", "Manganese in ppm"),
    ("vendor_a", "boron_ppm", "col_boron", "Boron in ppm"),
    ("vendor_a", "molybdenum_ppm", "col_molybdenum", "Molybdenum in ppm"),
    ("vendor_a", "sulfur_ppm", "col_sulfur", "Sulfur in ppm"),
    ("vendor_a", "organic_matter_pct", "col_organic_matter", "Organic matter percentage"),
    ("vendor_a", "sample_barcode", "col_sample_barcode", "Sample identifier"),
    ("vendor_a", "lab_id", "col_lab_id", "Lab identifier"),
    ("vendor_a", "received_date", "col_date_received", "Date sample received"),
    ("vendor_b", "acidity", "col_ph", "Vendor B calls pH 'acidity'"),
    ("vendor_b", "cu_total", "col_copper", "Chemical symbol notation"),
    ("vendor_b", "zn_total", "col_zinc", "Chemical symbol notation"),
    ("vendor_b", "pb_total", "col_lead", "Chemical symbol notation"),
    ("vendor_b", "fe_total", "col_iron", "Chemical symbol notation"),
    ("vendor_b", "mn_total", "col_manganese", "Chemical symbol notation"),
    ("vendor_b", "b_total", "col_boron", "Chemical symbol notation"),
    ("vendor_b", "mo_total", "col_molybdenum", "Chemical symbol notation"),
    ("vendor_b", "ec_ms_cm", "col_ec", "Electrical conductivity"),
    ("vendor_b", "organic_carbon_pct", "col_organic_matter", "Organic carbon as proxy for organic matter"),
    ("vendor_b", "sample_id", "col_sample_barcode", "Vendor B uses 'sample_id' instead of 'sample_barcode'"),
    ("vendor_b", "sample_barcod", "col_sample_barcode", "Typo preserved in bronze, mapped here"),
    ("vendor_b", "laboratory", "col_lab_id", "Vendor B uses 'laboratory' instead of 'lab_id'"),
    ("vendor_b", "analysis_date", "col_date_analyzed", "Analysis date"),
]

# The measures each vendor's package holds.
PACKAGES = {
    "vendor_a basic": ("ph", "copper_ppm", "zinc_ppm"),
    "vendor_a metals": ("lead_ppm", "iron_ppm", "manganese_ppm"),
    "vendor_a micronutrient": ("boron_ppm", "molybdenum_ppm", "sulfur_ppm", "organic_matter_pct"),
    "vendor_b standard": ("acidity", "cu_total", "zn_total"),
    "vendor_b heavy_metals": ("pb_total", "fe_total", "mn_total"),
    "vendor_b trace_elements": ("b_total", "mo_total", "ec_ms_cm", "organic_carbon_pct"),
}

# Vendor B's names and the wide superset's.
VENDOR_B_RENAMES = {
    "sample_barcode": "sample_barcode",
    "lab_id": "lab_id",
    "date_received": "date_received",
    "date_processed": "date_processed",
    "acidity": "ph",
    "cu_total": "copper_ppm",
    "zn_total": "zinc_ppm",
}


def key_of(*values: str) -> str:
    """``values.surrogate_key`` for known values."""
    return hashlib.sha256("|".join(values).encode()).hexdigest()[:8]


def inline(spark: SparkSession, columns: list[str], rows: list[tuple[str, ...]]) -> DataFrame:
    """A few text rows as an inline relation."""
    literal = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def canonical_column_definitions(spark: SparkSession) -> DataFrame:
    return inline(
        spark,
        ["canonical_column_id", "canonical_column_name", "column_category", "data_type", "description"],
        [(key_of(seed), *rest) for seed, *rest in CANONICAL_COLUMNS],
    )


def vendor_column_mapping(spark: SparkSession) -> DataFrame:
    return inline(
        spark,
        ["vendor_id", "vendor_column_name", "canonical_column_id", "notes"],
        [(vendor, name, key_of(seed), notes) for vendor, name, seed, notes in VENDOR_COLUMNS],
    )
