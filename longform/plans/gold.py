"""A star schema from standardised cells."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from longform.functions.values import surrogate_key
from longform.operators.provenance import file_key_of
from longform.sources.storage import store


@dataclass(frozen=True)
class Star:
    samples: DataFrame
    analytes: DataFrame
    measurements: DataFrame


def long_key(*values) -> Column:
    """A whole-digest key for tables too large for the eight-digit one."""
    parts = [F.coalesce(F.col(v).cast("string"), F.lit("")) for v in values]
    return F.sha2(F.concat_ws("|", *parts), 256)


def star_schema(silver: DataFrame, sample_attributes: Sequence[str], category: str = "measurement") -> Star:
    """Sample dimension, analyte dimension and measurement fact.

    Keys are hashes of what identifies a row (file and row index for a sample, the
    canonical name for an analyte), so the fact needs no join to learn them. Files are told apart by
    ``file_id`` where the cells have it: a name may repeat across folders and part files.
    ``sample_attributes`` are canonical names that describe the sample.
    """
    sample = [file_key_of(silver), "row_index"]
    known = silver.filter(F.col("canonical_column_id").isNotNull())
    value = F.col("lab_provided_value")
    samples = (
        known.filter(F.col("canonical_column_name").isin(list(sample_attributes)))
        .groupBy("vendor_id", *sample)
        .agg(*[F.max(F.when(F.col("canonical_column_name") == a, value)).alias(a) for a in sample_attributes])
        .withColumn("sample_key", long_key(*sample))
    )
    analytes = (
        known.filter(F.col("column_category") == category)
        .groupBy("canonical_column_name", "data_type")
        .agg(F.count("*").alias("measurement_count"))
        .withColumn("analyte_key", surrogate_key("canonical_column_name"))
    )
    measurements = known.filter(F.col("column_category") == category).select(
        long_key(*sample).alias("sample_key"),
        surrogate_key("canonical_column_name").alias("analyte_key"),
        "vendor_id",
        value.try_cast("double").alias("value"),
    )
    # one row per analyte; stored, so that measuring and joining it do not read silver again
    return Star(samples, store(analytes, "analytes"), measurements)
