"""Landing files as long bronze cells, or as wide bronze rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from longform.functions.dialect import CsvDialect
from longform.functions.names import (
    VENDOR_PREFIXES,
    logical_file_name,
    renamed,
    repair_typos,
    sanitize,
    vendor_of,
)
from longform.operators.cells import explode_cells
from longform.operators.header import detect_header_argmax, named_columns, threshold_by_vendor
from longform.sources.csv_lines import NO_HEADER, RecordScan, empty_files, scan_lines, scan_records
from longform.sources.storage import settle
from longform.sources.tables import append_table


@dataclass(frozen=True)
class Landing:
    """Cells of every readable file, the header of each, and the files that failed."""

    cells: DataFrame
    headers: DataFrame
    errors: DataFrame


@dataclass(frozen=True)
class WideLanding:
    """Wide rows of every readable file, and the files that failed, both from one scan's summaries."""

    rows: DataFrame
    errors: DataFrame


def threshold_of(threshold: int | Mapping[str, int], default: int, prefixes: Mapping[str, str]) -> Column | int:
    """The threshold as it is, or as a column over ``file_id`` if it differs by vendor."""
    if isinstance(threshold, int):
        return threshold
    vendor = vendor_of(logical_file_name(F.col("file_id")), prefixes)
    return threshold_by_vendor(vendor, threshold, default)


def header_table(scan: RecordScan, dialect: CsvDialect, prefixes: Mapping[str, str] = VENDOR_PREFIXES) -> DataFrame:
    """file_id, file_name, vendor_id, line_count, header_line_no, header_cells, columns."""
    cells = dialect.cells(F.col("header"))
    return (
        scan.files.filter(F.col("header_line_no").isNotNull())
        .withColumn("header_cells", cells)
        .select(
            "file_id",
            "file_name",
            vendor_of(F.col("file_name"), prefixes).alias("vendor_id"),
            "line_count",
            "header_line_no",
            "header_cells",
            named_columns(F.col("header_cells")).alias("columns"),
        )
    )


def body_rows(scan: RecordScan, headers: DataFrame, dialect: CsvDialect, fits: bool) -> DataFrame:
    """Records below their file's header, split into cells, with the header's columns."""
    below = scan.with_file_facts(headers, fits).filter(F.col("line_no") > F.col("header_line_no"))
    return below.withColumn("cells", dialect.cells(F.col("record")))


def land_lines(
    lines: DataFrame,
    dialect: CsvDialect = CsvDialect(),
    threshold: int | Mapping[str, int] = 10,
    default_threshold: int = 10,
    prefixes: Mapping[str, str] = VENDOR_PREFIXES,
    ingested_at: dt.datetime | None = None,
) -> Landing:
    """``land_long`` for lines that were already read; see ``csv_lines.lines_of``."""
    scan = scan_records(lines, dialect, threshold_of(threshold, default_threshold, prefixes))
    headers = settle(header_table(scan, dialect, prefixes), "headers")
    stamp = ingested_at or dt.datetime.now()
    needed = headers.df.select("file_id", "file_name", "vendor_id", "header_line_no", "columns")
    cells = explode_cells(body_rows(scan, needed, dialect, headers.fits), ["file_id", "file_name", "vendor_id"])
    errors = scan.files.filter(F.col("error").isNotNull()).select("file_id", "file_name", "error")
    return Landing(cells.withColumn("ingestion_timestamp", F.lit(stamp)), headers.df, errors)


def land_long(spark: SparkSession, path: str | list[str], dialect: CsvDialect = CsvDialect(), **options) -> Landing:
    """Every CSV file below ``path`` as long cells, in two scans and no shuffle of rows.

    A file without a header or without a byte becomes a row of ``errors`` and stops nothing else. So does a
    file whose last quote is never closed or whose text is not valid in its encoding; its cells land all the same.
    ``threshold`` may be one number or one per vendor. ``ingested_at`` is one
    timestamp for the whole run.
    """
    landing = land_lines(scan_lines(spark, path, dialect), dialect, **options)
    empty = empty_files(spark, path, landing.headers, landing.errors)
    return replace(landing, errors=landing.errors.unionByName(empty))


def wide_rows(rows: DataFrame, superset: Sequence[str]) -> DataFrame:
    """Body rows as wide rows: each superset column takes its cell by position."""
    values = [
        F.nullif(F.get("cells", F.get("positions", F.lit(i)) - 1), F.lit("")).alias(column)
        for i, column in enumerate(superset)
    ]
    return rows.select("file_name", "vendor_id", (F.col("line_no") - F.col("header_line_no")).alias("row_index"), *values)


def wide_positions(
    headers: DataFrame, superset: Sequence[str], renames: Mapping[str, Mapping[str, str]]
) -> DataFrame:
    """Header table with ``positions``: for each superset column, where the file has it.

    Header names are repaired, sanitised and renamed per vendor first. Where two
    columns of a file end up with one name, the left one is taken. All of this is
    per file; rows need no pivot and no shuffle.
    """

    def repaired(name: Column) -> Column:
        name = sanitize(repair_typos(name))
        out = name
        for vendor, table in renames.items():
            out = F.when(F.col("vendor_id") == vendor, renamed(name, table)).otherwise(out)
        return out

    clean = F.transform("columns", lambda c: F.struct(repaired(c["name"]).alias("name"), c["source_column_index"].alias("at")))
    places = [F.get(F.filter("clean", lambda c: c["name"] == F.lit(s)), F.lit(0))["at"] for s in superset]
    return headers.withColumn("clean", clean).withColumn("positions", F.array(*places)).drop("clean", "columns")


def land_wide_files(
    spark: SparkSession,
    path: str | list[str],
    superset: Sequence[str],
    renames: Mapping[str, Mapping[str, str]],
    dialect: CsvDialect = CsvDialect(),
    peek: int = 10,
    threshold: int | None = None,
    prefixes: Mapping[str, str] = VENDOR_PREFIXES,
) -> WideLanding:
    """Every CSV file below ``path`` as wide rows over a declared superset of columns, and the files that do not land.

    The header is the row with the most filled cells among the first ``peek``, which
    takes a scan of its own; with ``threshold`` it is the first row with that many,
    found in the scan that numbers the lines. A column that is empty throughout needs
    no removal: it is null either way. Headers are stored once, for the rows and for ``errors``.
    """
    scan, headers = _wide_headers(spark, path, dialect, peek, threshold, prefixes)
    placed = settle(wide_positions(headers, superset, renames), "wide-positions")
    rows = wide_rows(body_rows(scan, placed.df, dialect, placed.fits), superset)
    return WideLanding(rows, _wide_errors(spark, path, scan, placed.df))


def land_wide(spark: SparkSession, path: str | list[str], superset: Sequence[str], renames: Mapping[str, Mapping[str, str]], **options) -> DataFrame:
    """The rows of ``land_wide_files``."""
    return land_wide_files(spark, path, superset, renames, **options).rows


def append_wide(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    superset: Sequence[str],
    renames: Mapping[str, Mapping[str, str]],
    **options,
) -> DataFrame:
    """Land the files and append their rows to a named table, in one job; returns the files that did not land.

    Columns that the table lacks are added to it, null in its old rows, and columns of the table that this superset lacks
    are null in the new ones. A column of another type is refused before anything is written.
    """
    landing = land_wide_files(spark, path, superset, renames, **options)
    append_table(landing.rows, table, merge_schema=True)
    return landing.errors


def wide_errors(
    spark: SparkSession,
    path: str | list[str],
    dialect: CsvDialect = CsvDialect(),
    peek: int = 10,
    threshold: int | None = None,
    prefixes: Mapping[str, str] = VENDOR_PREFIXES,
) -> DataFrame:
    """file_id, file_name, error of the files that cannot be landed wide, or not as they should be; without their rows."""
    scan, headers = _wide_headers(spark, path, dialect, peek, threshold, prefixes)
    return _wide_errors(spark, path, scan, settle(headers, "wide-headers").df)


def _wide_errors(spark: SparkSession, path: str | list[str], scan: RecordScan, headers: DataFrame) -> DataFrame:
    found = headers.select("file_id", F.lit(True).alias("found"))
    files = scan.files.join(found, "file_id", "left")
    error = F.when(F.col("found").isNull(), F.lit(NO_HEADER)).otherwise(F.col("error"))
    errors = files.select("file_id", "file_name", error.alias("error")).filter(F.col("error").isNotNull())
    return errors.unionByName(empty_files(spark, path, headers, errors))


def _wide_headers(
    spark: SparkSession,
    path: str | list[str],
    dialect: CsvDialect,
    peek: int,
    threshold: int | None,
    prefixes: Mapping[str, str],
) -> tuple[RecordScan, DataFrame]:
    """The scan, and the header of each file that has one."""
    scan = scan_records(scan_lines(spark, path, dialect), dialect, threshold or 1)
    if threshold:
        return scan, header_table(scan, dialect, prefixes).drop("line_count", "header_cells")
    grid = scan.records.filter(F.col("line_no") < peek).withColumn("cells", dialect.cells(F.col("record")))
    headers = (
        detect_header_argmax(grid, peek)
        .join(scan.files.select("file_id", "file_name"), "file_id")
        .withColumn("vendor_id", vendor_of(F.col("file_name"), prefixes))
        .withColumn("columns", named_columns(F.col("header_cells")))
        .drop("header_cells")
    )
    return scan, headers
