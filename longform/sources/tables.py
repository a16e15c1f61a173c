"""Tables and CSV files as sources and sinks.

The table format is a parameter: ``parquet`` everywhere, ``delta`` where it is installed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Folders that a task keeps open at once; rows of any further ones are sorted by Spark, which spills.
OPEN_FOLDERS = 8


def read_csv_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header, every column text."""
    return spark.read.option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with a header and inferred types; for small reference files, it scans twice."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """CSV files below ``path``. ``single_file`` sends all rows through one task."""
    (df.repartition(1) if single_file else df).write.mode("overwrite").option("header", header).csv(path)


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Rows of a partitioned table go to the files of their folders as they come.

    By default Spark sorts all rows of a task by folder first, so that the task's memory grows with its input. An
    option that the session has set stays.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.unset(key)


def overwrite_table(
    df: DataFrame, table: str, format: str = "parquet", partition_by: tuple[str, ...] = (), path: str | None = None
) -> None:
    """Replace a table. With ``path`` its files live there, not in the warehouse."""
    writer = df.write.format(format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    with unsorted_writes(df.sparkSession):
        writer.saveAsTable(table)


def append_table(df: DataFrame, table: str, format: str = "parquet", merge_schema: bool = False) -> None:
    """Append rows to a table.

    Rows must have the table's columns and types, in any order; anything else is refused. With
    ``merge_schema`` new columns are added to the table first (null in its old rows),
    and columns that the rows lack are null in them.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format(format).saveAsTable(table)
        return
    have, bring = dict(spark.table(table).dtypes), dict(df.dtypes)
    new = [c for c in bring if c not in have]
    other = [c for c in bring if c in have and bring[c] != have[c]]
    if other or (not merge_schema and bring.keys() != have.keys()):
        raise ValueError(f"rows do not fit table {table}: {sorted(set(other) | (bring.keys() ^ have.keys()))}")
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {bring[c]}' for c in new)})")
        have |= {c: bring[c] for c in new}
    aligned = [F.col(f"`{c}`") if c in bring else F.lit(None).cast(t).alias(c) for c, t in have.items()]
    df.select(*aligned).write.format(format).mode("append").saveAsTable(table)


def append_path(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Append files whose schema may differ from the earlier ones."""
    writer = df.write.format(format).mode("append")
    (writer.option("mergeSchema", True) if format == "delta" else writer).save(path)


def read_merged(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """All files of a path under the union of their schemas."""
    return spark.read.format(format).option("mergeSchema", True).load(path)


def ensure_layers(spark: SparkSession, *names: str) -> None:
    """Create the databases of the layers, e.g. bronze, silver and gold."""
    for name in names or ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
