"""Aggregates over bronze, silver and gold. All combine map-side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def monthly_summary(
    df: DataFrame,
    day: str,
    vendor: str,
    counted: str,
    spread_of: str,
    averaged: Sequence[str] = (),
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per month and vendor: count, and mean/deviation/least/greatest of a measure.

    ``names`` renames measures in the output, e.g. ``{"l_quantity": "ph"}``.
    """
    short = lambda c: (names or {}).get(c, c)
    return (
        df.groupBy(F.date_trunc("month", F.col(day)).alias("month_start"), F.col(vendor).alias("vendor_name"))
        .agg(
            F.count(counted).alias("sample_count"),
            F.avg(spread_of).alias(f"avg_{short(spread_of)}"),
            F.stddev(spread_of).alias(f"stddev_{short(spread_of)}"),
            F.min(spread_of).alias(f"min_{short(spread_of)}"),
            F.max(spread_of).alias(f"max_{short(spread_of)}"),
            *[F.avg(c).alias(f"avg_{short(c)}") for c in averaged],
        )
        .withColumn("gold_processed_at", F.current_timestamp())
    )


def cells_by_file(cells: DataFrame) -> DataFrame:
    return cells.groupBy("vendor_id", "file_name").count().orderBy("vendor_id", "file_name")


def mapping_coverage(silver: DataFrame) -> DataFrame:
    mapped = F.col("canonical_column_id").isNotNull()
    return (
        silver.groupBy("vendor_id")
        .agg(
            F.count("*").alias("total_records"),
            F.count_if(mapped).alias("mapped_records"),
            F.count_if(~mapped).alias("unmapped_records"),
        )
        .orderBy("vendor_id")
    )


def unmapped_attributes(silver: DataFrame) -> DataFrame:
    return (
        silver.filter(F.col("canonical_column_id").isNull())
        .select("vendor_id", "lab_provided_attribute")
        .distinct()
        .orderBy("vendor_id", "lab_provided_attribute")
    )


def canonical_usage(silver: DataFrame) -> DataFrame:
    """Vendors and cells per canonical column.

    Counting per vendor first and then over vendors needs one pass and gives the
    distinct count without expanding rows.
    """
    return (
        silver.filter(F.col("canonical_column_name").isNotNull())
        .groupBy("canonical_column_name", "column_category", "vendor_id")
        .agg(F.count("*").alias("n"))
        .groupBy("canonical_column_name", "column_category")
        .agg(F.count("vendor_id").alias("vendor_count"), F.sum("n").alias("record_count"))
        .orderBy("column_category", "canonical_column_name")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count; each table is only counted, no column is read."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no tables given")
    return out


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of an order, so the result is defined."""
    if not order:
        raise ValueError("a preview needs an order")
    return df.orderBy(*order).limit(n)


def cross_vendor(silver: DataFrame, value: str = "numeric_value") -> DataFrame:
    """Statistics of each numeric canonical column per vendor."""
    return (
        silver.filter(F.col(value).isNotNull())
        .groupBy("canonical_column_name", "vendor_id")
        .agg(
            F.count("*").alias("value_count"),
            F.avg(value).alias("avg_value"),
            F.stddev(value).alias("stddev_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
    )


def attribute_presence(cells: DataFrame, load: str) -> DataFrame:
    """First and last load in which each vendor attribute was seen."""
    return cells.groupBy("vendor_id", "lab_provided_attribute").agg(
        F.min(load).alias("first_seen"), F.max(load).alias("last_seen"), F.count("*").alias("record_count")
    )


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """Attributes that are new, gone or kept between two loads, with their cells in each."""
    keys = ["vendor_id", "lab_provided_attribute"]
    old = before.groupBy(*keys).agg(F.count("*").alias("records_before"))
    new = after.groupBy(*keys).agg(F.count("*").alias("records_after"))
    change = (
        F.when(F.col("records_before").isNull(), "new")
        .when(F.col("records_after").isNull(), "gone")
        .otherwise("kept")
    )
    return old.join(new, keys, "full").select(
        *keys,
        change.alias("change"),
        F.coalesce("records_before", F.lit(0)).alias("records_before"),
        F.coalesce("records_after", F.lit(0)).alias("records_after"),
    )
