"""Profiles, defect flags and validation rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from longform.functions.names import defects, id_pattern
from longform.functions.values import turnaround_days
from longform.sources.storage import join_small


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, row_count, null_count, null_share of each column, in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    each = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), (F.col("n") - F.col(f"c{i}")).alias("null_count"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.col("n").alias("row_count"), F.explode(each).alias("e")).select(
        "e.column_name", "row_count", "e.null_count", F.try_divide("e.null_count", "row_count").alias("null_share")
    )


def turnaround(df: DataFrame, received: str, processed: str) -> DataFrame:
    """Adds the days between two dates and a flag for less than the minimum of one."""
    days = turnaround_days(received, processed)
    return df.withColumns({"turnaround_days": days, "below_minimum": days < 1})


def id_format_check(
    df: DataFrame, column: str, prefix: str, total_length: int, separator_at: int | None = None, separator: str = "-"
) -> DataFrame:
    """Counts of identifiers that follow a format, do not, or are null."""
    ok = F.rlike(F.col(column), F.lit(id_pattern(prefix, total_length, separator_at, separator)))
    return df.agg(
        F.count_if(ok).alias("valid"),
        F.count_if(~ok).alias("invalid"),
        F.count_if(F.col(column).isNull()).alias("missing"),
    )


def header_defects(cells: DataFrame) -> DataFrame:
    """Defect flags per distinct attribute, with the cells below it."""
    distinct = cells.groupBy("lab_provided_attribute").agg(F.count("*").alias("record_count"))
    return distinct.withColumns(defects(F.col("lab_provided_attribute")))


def file_defects(headers: DataFrame) -> DataFrame:
    """Per file: rows above its header, and header cells without a name.

    ``headers`` has ``file_id, header_line_no, header_cells``.
    """
    named = F.size(F.array_remove(F.array_compact("header_cells"), ""))
    return headers.select(
        "file_id",
        F.col("header_line_no").alias("metadata_rows"),
        (F.size("header_cells") - named).alias("unnamed_columns"),
        named.alias("named_columns"),
    )


def package_detection(cells: DataFrame, packages: Mapping[str, Sequence[str]]) -> DataFrame:
    """Which packages (sets of attributes) each file holds in full.

    The packages are a small fixed dictionary, so each is one flag per attribute in a
    single aggregate; no join and no distinct of the cells.
    """
    per_attribute = cells.groupBy("file_name", "lab_provided_attribute").agg(F.count("*").alias("n"))
    names = F.col("lab_provided_attribute")
    found = per_attribute.groupBy("file_name").agg(
        *[F.count_if(names.isin(list(members))).alias(package) for package, members in packages.items()]
    )
    whole = [
        F.struct(F.lit(package).alias("package"), (F.col(package) == len(set(members))).alias("whole"))
        for package, members in packages.items()
    ]
    return (
        found.select("file_name", F.explode(F.array(*whole)).alias("p"))
        .filter("p.whole")
        .select("file_name", "p.package")
    )


def package_detection_from_table(cells: DataFrame, packages: DataFrame) -> DataFrame:
    """``package_detection`` with packages in a table ``package, lab_provided_attribute``."""
    per_attribute = cells.select("file_name", "lab_provided_attribute").distinct()
    sizes = packages.distinct().groupBy("package").agg(F.count("*").alias("size"))
    members = packages.distinct().join(sizes, "package")
    hits = join_small(per_attribute, members, ["lab_provided_attribute"], "inner", ["file_name"])
    return (
        hits.groupBy("file_name", "package", "size").agg(F.count("*").alias("n")).filter("n = size")
        .select("file_name", "package")
    )


def rule_summary(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """rule, passed, failed, unknown for named boolean conditions, in one pass."""
    aggs = []
    for i, condition in enumerate(rules.values()):
        aggs += [
            F.count_if(condition).alias(f"p{i}"),
            F.count_if(~condition).alias(f"f{i}"),
            F.count_if(condition.isNull()).alias(f"u{i}"),
        ]
    each = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"p{i}").alias("passed"),
            F.col(f"f{i}").alias("failed"),
            F.col(f"u{i}").alias("unknown"),
        )
        for i, name in enumerate(rules)
    ]
    return df.agg(*aggs).select(F.explode(F.array(*each)).alias("e")).select("e.*")


def in_range(column: str, low: float, high: float) -> Column:
    return F.col(column).between(low, high)


def non_negative(column: str) -> Column:
    return F.col(column) >= 0


def not_before(later: str, earlier: str) -> Column:
    return F.col(later) >= F.col(earlier)


def with_quality_flags(silver: DataFrame) -> DataFrame:
    """``is_mapped``, and ``is_parsed``: does the text follow its canonical type?

    Null where there is nothing to parse; text of an unknown or string type parses.
    """
    value, kind = F.col("lab_provided_value"), F.col("data_type")
    parsed = (
        F.when(value.isNull(), F.lit(None).cast("boolean"))
        .when(kind == "numeric", value.try_cast("double").isNotNull())
        .when(kind == "date", F.try_to_date(value, "yyyy-MM-dd").isNotNull())
        .otherwise(F.lit(True))
    )
    return silver.withColumns({"is_mapped": F.col("canonical_column_id").isNotNull(), "is_parsed": parsed})
