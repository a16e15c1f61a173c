"""Rows to long cells and back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from longform.operators.header import after_header, with_columns
from longform.sources.storage import join_small, settle

# The fixed long schema. Parsed cells carry wider positions (bigint) and two more
# columns, which ``conform_bronze`` narrows to this.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("row_index", T.IntegerType(), False),
        T.StructField("column_index", T.IntegerType(), False),
        T.StructField("lab_provided_attribute", T.StringType(), False),
        T.StructField("lab_provided_value", T.StringType(), True),
        T.StructField("vendor_id", T.StringType(), False),
        T.StructField("file_name", T.StringType(), False),
        T.StructField("ingestion_timestamp", T.TimestampType(), False),
    ]
)

_LITERALS = {
    T.IntegerType(): (0, 1),
    T.StringType(): ("", " "),
    T.TimestampType(): (dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2)),
}


def explode_cells(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per cell of rows that carry ``line_no, header_line_no, cells, columns``.

    A short row gives fewer cells, cells without a column give none, and an empty
    cell inside the row gives a null value.
    """
    each = rows.select(*keep, "line_no", "header_line_no", "cells", F.explode("columns").alias("c"))
    return each.filter(F.col("c.source_column_index") <= F.size("cells")).select(
        *keep,
        (F.col("line_no") - F.col("header_line_no")).alias("row_index"),
        F.col("c.column_index").alias("column_index"),
        F.col("c.name").alias("lab_provided_attribute"),
        F.nullif(F.get("cells", F.col("c.source_column_index") - 1), F.lit("")).alias("lab_provided_value"),
        F.col("line_no").alias("source_line_no"),
        F.col("c.source_column_index").alias("source_column_index"),
    )


def unpivot_cells(grid: DataFrame, header: DataFrame, keep: Sequence[str] = ("file_id",)) -> DataFrame:
    """Grid rows below their header as long cells."""
    return explode_cells(after_header(grid, with_columns(header)), keep)


def unpivot_columns(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Unpivot a DataFrame whose columns are known; nulls are kept, one scan, no shuffle.

    ``column_index`` is the column's place in ``columns``, from 1.
    """
    names = list(columns) if columns is not None else [c for c in df.columns if c not in set(keys)]
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("column_index"),
                F.lit(name).alias("lab_provided_attribute"),
                F.col(f"`{name}`").cast("string").alias("lab_provided_value"),
            )
            for i, name in enumerate(names, start=1)
        ]
    )
    return df.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*")


def number_across_files(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Cells whose ``row_index`` runs on over all files of one name, so that name and row index tell rows apart without ``file_id``.

    The part files of a folder are one file to whoever reads the fixed schema. Rows are counted from the headers (one row per file), by path; the first
    file of a name keeps its numbers, and where no name has several files nothing is joined.
    """
    before = Window.partitionBy("file_name").orderBy("file_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = F.col("line_count") - F.col("header_line_no") - 1
    offsets = headers.select("file_id", F.sum(rows).over(before).alias("_before")).filter(F.col("_before") > 0)
    offsets = settle(offsets, "file-offsets", files=F.count("*"))
    if not offsets.metrics["files"]:
        return cells
    placed = join_small(cells, offsets.df, ["file_id"], "left", spread=["row_index"], fits=offsets.fits)
    placed = placed.withColumn("row_index", F.col("row_index") + F.coalesce("_before", F.lit(0)))
    return placed.select(*cells.columns)


def conform_bronze(cells: DataFrame) -> DataFrame:
    """Exactly the fixed long schema, in its order; a null where it allows none is an error."""
    fixed = []
    for field in BRONZE_SCHEMA.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            # two unlike literals: the result counts as not null, and the error is not optimised away
            refusal = F.raise_error(F.lit(f"{field.name} must not be null")).isNull()
            one, other = _LITERALS[field.dataType]
            value = F.coalesce(value, F.when(refusal, F.lit(one)).otherwise(F.lit(other)))
        fixed.append(value.alias(field.name))
    return cells.select(*fixed)


def pivot_back(cells: DataFrame, keys: Sequence[str], names: Sequence[str], name_column: str) -> DataFrame:
    """Long cells to one row per ``keys``, one column per name.

    The names are given, so no extra pass looks for them, and the aggregate combines
    map-side; a row's cells are the only group.
    """
    value = F.col("lab_provided_value")
    columns = [
        F.max(F.when(F.col(name_column) == name, value)).alias(name) for name in names
    ]
    return cells.groupBy(*keys).agg(*columns)
