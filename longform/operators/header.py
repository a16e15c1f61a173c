"""Finding and cleaning the header of a raw grid.

A grid is any DataFrame with ``file_id, line_no, cells array<string>``; it need not
come from CSV. An empty cell may be null or ``''``. A header table has one row per
file: ``file_id, header_line_no, header_cells``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from longform.sources.csv_lines import NO_HEADER, empty_set, filled
from longform.sources.storage import join_small, settle


def null_cells(grid: DataFrame) -> DataFrame:
    """Empty cells become null; a cell of blanks is kept."""
    return grid.withColumn("cells", F.transform("cells", lambda c: F.nullif(c, F.lit(""))))


def _header_of(grid: DataFrame, ordering: Column) -> DataFrame:
    """Per file, the row with the least non-null ordering."""
    return (
        grid.withColumn("_by", ordering)
        .groupBy("file_id")
        .agg(
            F.min_by(F.struct("line_no", "cells"), "_by").alias("h"),
            empty_set(F.col("line_no")).alias("_hash"),
        )
        .filter(F.col("h").isNotNull() & (F.size("_hash") == 0))
        .select("file_id", F.col("h.line_no").alias("header_line_no"), F.col("h.cells").alias("header_cells"))
    )


def detect_header(grid: DataFrame, threshold: int | Column = 10, peek: int | None = None) -> DataFrame:
    """The first row of each file with at least ``threshold`` filled cells.

    ``peek`` looks at that many leading rows only. Files without such a row are
    absent from the result; see ``files_without_header``.
    """
    rows = grid if peek is None else grid.filter(F.col("line_no") < peek)
    return _header_of(rows, F.when(filled(F.col("cells")) >= threshold, F.col("line_no")))


def detect_header_argmax(grid: DataFrame, peek: int = 10) -> DataFrame:
    """The row with the most filled cells among the first ``peek``; the first wins a tie."""
    n = filled(F.col("cells"))
    rows = grid.filter(F.col("line_no") < peek)
    return _header_of(rows, F.when(n > 0, F.struct((-n).alias("n"), F.col("line_no"))))


def threshold_by_vendor(vendor: Column, thresholds: Mapping[str, int], default: int = 10) -> Column:
    """A header threshold that depends on the vendor, from a small fixed dictionary."""
    out = F.lit(default)
    for name, value in thresholds.items():
        out = F.when(vendor == name, F.lit(value)).otherwise(out)
    return out


def files_without_header(grid: DataFrame, header: DataFrame) -> DataFrame:
    """One row per file in which no header was found."""
    files = grid.select("file_id").distinct()
    return join_small(files, header.select("file_id"), ["file_id"], "left_anti").withColumn(
        "error", F.lit(NO_HEADER)
    )


def after_header(grid: DataFrame, header: DataFrame) -> DataFrame:
    """Rows below the header, with ``row_index`` counted from 1 after it.

    The header is found once: it is stored, measured as it is written, and joined from there.
    """
    stored = settle(header, "headers")
    return (
        join_small(grid, stored.df, ["file_id"], "inner", ["line_no"], stored.fits)
        .filter(F.col("line_no") > F.col("header_line_no"))
        .withColumn("row_index", F.col("line_no") - F.col("header_line_no"))
    )


def deduplicated(names: Column) -> Column:
    """The k-th repeat of a name becomes ``name_k``; nothing checks for collisions."""

    def with_suffix(name, i):
        seen = F.size(F.filter(F.slice(names, F.lit(1), i), lambda other: other == name))
        return F.when(seen == 0, name).otherwise(F.concat(name, F.lit("_"), seen.cast("string")))

    return F.transform(names, with_suffix)


def named_columns(cells: Column) -> Column:
    """The named columns of a header as ``array<struct<column_index, source_column_index, name>>``.

    Only the header cell decides: a column without a name is dropped whatever lies
    below it. ``column_index`` counts named columns, ``source_column_index`` all.
    """
    everything = F.transform(cells, lambda c, i: F.struct((i + 1).alias("at"), c.alias("name")))
    named = F.filter(everything, lambda e: e["name"].isNotNull() & (e["name"] != ""))
    names = deduplicated(F.transform(named, lambda e: e["name"]))
    return F.transform(
        F.arrays_zip(named.alias("source"), names.alias("name")),
        lambda e, i: F.struct(
            (i + 1).alias("column_index"), e["source"]["at"].alias("source_column_index"), e["name"].alias("name")
        ),
    )


def with_columns(header: DataFrame) -> DataFrame:
    """A header table with its cleaned ``columns`` in place of ``header_cells``."""
    return header.select("file_id", "header_line_no", named_columns(F.col("header_cells")).alias("columns"))


def drop_unnamed_columns(grid: DataFrame, header: DataFrame) -> DataFrame:
    """Rows below the header without the cells of unnamed columns.

    Cells beyond the header's width have no column and stay; a short row stays short.
    """
    width = header.select("file_id", "header_line_no", named_columns(F.col("header_cells")).alias("columns"), F.size("header_cells").alias("_width"))
    body = after_header(grid, width)
    inside = F.filter("columns", lambda c: c["source_column_index"] <= F.size("cells"))
    kept = F.transform(inside, lambda c: F.get(F.col("cells"), c["source_column_index"] - 1))
    beyond = F.slice("cells", F.col("_width") + 1, F.greatest(F.size("cells") - F.col("_width"), F.lit(0)))
    return body.withColumn("cells", F.concat(kept, beyond)).drop("columns", "_width")
