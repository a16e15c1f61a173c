"""The wide path: repairing and aligning columns before a table is landed.

Column names are known to the driver here, so renames and alignments are single
projections; only ``remove_empty_columns`` has to look at the data, once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from longform.functions.names import NAME_CHARACTERS, TYPO_CLASSES, require_columns


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def rename_projection(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of ``renames``, in its order, under their new names."""
    require_columns(df.columns, list(renames))
    return df.select([_quoted(old).alias(new) for old, new in renames.items()])


def superset_union(*frames: DataFrame) -> DataFrame:
    """Union of all rows over all columns in name order; a missing column is null."""
    columns = sorted({c for df in frames for c in df.columns})
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return joined.select([_quoted(c) for c in columns])


def align_superset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly ``columns``, in that order: extras dropped, missing ones null text."""
    have = set(df.columns)
    return df.select([_quoted(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])


def repaired_name(name: str) -> str:
    """``names.repair_typos`` for one known name."""
    lower = name.lower()
    for seen, unless, pairs in TYPO_CLASSES:
        if seen in lower and not (unless and unless in lower):
            for old, new in pairs:
                name = name.replace(old, new)
            break
    return name


def sanitized_name(name: str) -> str:
    """``names.sanitize`` for one known name."""
    for old, new in NAME_CHARACTERS:
        name = name.replace(old, new)
    return name


def rename_each(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.select([_quoted(c).alias(rule(c)) for c in df.columns])


def fix_header_typos(df: DataFrame) -> DataFrame:
    return rename_each(df, repaired_name)


def sanitize_names(df: DataFrame) -> DataFrame:
    return rename_each(df, sanitized_name)


def remove_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a name, or with only nulls and empty text, in one job.

    Runs an aggregate of one row; the data stays where it is.
    """
    named = [c for c in df.columns if c.strip()]
    counts = df.agg(
        *[F.count(F.nullif(_quoted(c).cast("string"), F.lit(""))).alias(f"c{i}") for i, c in enumerate(named)]
    ).first()
    return df.select([_quoted(c) for c, n in zip(named, counts or []) if n > 0])


def vendor_dispatch(frames: Mapping[str, DataFrame], renames: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Union of the vendors' rows, each through its own rename projection.

    A vendor without renames passes as it is. Adds ``vendor_id``.
    """
    parts = []
    for vendor, df in frames.items():
        one = rename_projection(df, renames[vendor]) if renames.get(vendor) else df
        parts.append(one.withColumn("vendor_id", F.lit(vendor)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def bulk_rename(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(renames))
