"""The queries registered with the driver and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from longform.catalog import ingest, standard, wide, gold, changes  # noqa: F401  (importing registers)
from longform.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["file_mapping_coverage"](spark, sf_dir)
