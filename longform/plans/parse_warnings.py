"""What is odd about the rows of messy files, told while they are scanned.

Every record below its file's header gets a set of bits from the cells that the scan has split it into; files are
summed from these map-side, so the report costs the landing's own passes and one small row per file and task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from longform.functions.dialect import CsvDialect
from longform.functions.names import VENDOR_PREFIXES
from longform.plans.bronze import body_rows, header_table, threshold_of
from longform.sources.csv_lines import scan_lines, scan_records
from longform.sources.storage import join_small, settle

#: Bit k of a row's warnings.
WARNINGS = ("short_row", "long_row", "blank_line", "unclosed_quote", "invalid_bytes")


def row_warnings(record: Column, cells: Column, width: Column, dialect: CsvDialect) -> Column:
    """The bits of one record: fewer or more cells than the header (a blank line has none, and is not called short), open at its end, undecodable."""
    blank = record == ""
    found = (~blank & (F.size(cells) < width), F.size(cells) > width, blank, dialect.leaves_open(record), dialect.is_broken(record))
    bits = [F.when(there, 1 << k).otherwise(0) for k, there in enumerate(found)]
    return sum(bits[1:], bits[0])


def parse_warnings(
    spark: SparkSession,
    path: str | list[str],
    dialect: CsvDialect = CsvDialect(),
    threshold: int | Mapping[str, int] = 10,
    default_threshold: int = 10,
    prefixes: Mapping[str, str] = VENDOR_PREFIXES,
) -> DataFrame:
    """One row per file: file_id, file_name, row_count (below the header), a count for each of ``WARNINGS``, their bits, and the file's error.

    A file without a header has no rows to judge: null counts, and its error.
    """
    scan = scan_records(scan_lines(spark, path, dialect), dialect, threshold_of(threshold, default_threshold, prefixes))
    headers = settle(header_table(scan, dialect, prefixes).select("file_id", "header_line_no", F.size("header_cells").alias("width")), "header-widths")
    rows = body_rows(scan, headers.df, dialect, headers.fits)
    rows = rows.select("file_id", row_warnings(F.col("record"), F.col("cells"), F.col("width"), dialect).alias("bits"))
    counts = [F.count_if(F.col("bits").bitwiseAND(F.lit(1 << k)) > 0).alias(f"{name}s") for k, name in enumerate(WARNINGS[:4])]
    counts.append(F.count_if(F.col("bits").bitwiseAND(F.lit(1 << 4)) > 0).alias(WARNINGS[4]))
    summed = settle(rows.groupBy("file_id").agg(F.count("*").alias("row_count"), *counts, F.bit_or("bits").alias("warnings")), "file-warnings")
    files = scan.files.select("file_id", "file_name", "error", F.col("header_line_no").isNotNull().alias("headed"))
    placed = join_small(files, summed.df, ["file_id"], "left", fits=summed.fits)
    numbers = [c for c in summed.df.columns if c != "file_id"]
    known = [F.when(F.col("headed"), F.coalesce(c, F.lit(0))).alias(c) for c in numbers]
    return placed.select("file_id", "file_name", *known, "error")
