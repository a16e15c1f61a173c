"""Where rows came from: file columns, run columns, row numbers, audit tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from longform.sources.storage import join_small, pin_splits, placed_in_split, settle


def with_provenance(df: DataFrame, data_source: str, ingestion_id: str | None = None) -> DataFrame:
    """Source file columns from ``_metadata``, and one id and time for the run.

    ``df`` comes straight from a file source; the ``_metadata`` struct is kept.
    """
    return df.select("*", "_metadata").withColumns(
        {
            "source_file_path": F.col("_metadata.file_path"),
            "source_file_name": F.col("_metadata.file_name"),
            "file_modified_at": F.col("_metadata.file_modification_time"),
            "ingestion_id": F.lit(ingestion_id or str(uuid.uuid4())),
            "data_source": F.lit(data_source),
            "ingested_at": F.current_timestamp(),
        }
    )


def with_row_id(df: DataFrame) -> DataFrame:
    """``file_row_number`` that grows with file position but has gaps; no shuffle."""
    return df.withColumn("file_row_number", F.monotonically_increasing_id())


def with_file_row_number(df: DataFrame) -> DataFrame:
    """Gapless 1-based ``file_row_number`` per file, in file order, without shuffling rows.

    ``df`` comes straight from a file source. Parquet knows the row's place in its file. Of other
    formats the row ids of a file split are consecutive, so one summary row per split turns
    them into numbers; the number of splits is pinned, and a scan that is cut
    differently all the same fails.
    """
    try:
        return df.withColumn("file_row_number", F.col("_metadata.row_index") + 1)
    except AnalysisException:
        pass  # no such field: the source is not Parquet
    pin_splits(df.sparkSession)
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_part"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    before = Window.partitionBy("_file").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        tagged.groupBy("_file", "_part")
        .agg(F.min("_seq").alias("_start"), F.count("*").alias("_n"))
        .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    )
    splits = settle(splits, "file-splits")
    numbered = join_small(tagged, splits.df, ["_file", "_part"], "left", fits=splits.fits)
    number = F.coalesce("_first", F.lit(0)) + placed_in_split(F.col("_seq"), F.col("_start"), F.col("_n")) + 1
    return numbered.withColumn("file_row_number", number).drop("_file", "_part", "_seq", "_start", "_n", "_first")


def file_key_of(cells: DataFrame, file_key: str | None = None) -> str:
    """The column that tells files apart: ``file_id`` where there is one, as names may repeat across folders and part files."""
    return file_key or ("file_id" if "file_id" in cells.columns else "file_name")


def _batch_id(ingestion_id: str, file_key: str) -> Column:
    """The whole digest: eight digits would collide within a load of many files."""
    return F.sha2(F.concat_ws("|", F.lit(ingestion_id), F.coalesce(F.col(file_key), F.lit(""))), 256)


def ingestion_audit(cells: DataFrame, ingestion_id: str, file_key: str | None = None) -> DataFrame:
    """One row per file of a run: cells, rows, attributes and nulls, keyed by batch. Files are told apart by ``file_key``."""
    key = file_key_of(cells, file_key)
    file = list(dict.fromkeys(["vendor_id", key, "file_name"]))
    per_attribute = cells.groupBy(*file, "lab_provided_attribute").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("lab_provided_value").isNull()).alias("nulls"),
        F.max("row_index").alias("last_row"),
    )
    return (
        per_attribute.groupBy(*file)
        .agg(
            F.sum("n").alias("cell_count"),
            F.sum("nulls").alias("null_cells"),
            F.count("*").alias("attribute_count"),
            F.max("last_row").alias("row_count"),
        )
        .withColumn("batch_id", _batch_id(ingestion_id, key))
    )


def with_batch_id(cells: DataFrame, ingestion_id: str, file_key: str | None = None) -> DataFrame:
    """Cells keyed to their row of the audit table; the key is computed, not joined."""
    return cells.withColumn("batch_id", _batch_id(ingestion_id, file_key_of(cells, file_key)))


def ingestion_link(cells: DataFrame, record_key: list[str]) -> DataFrame:
    """Batch-to-record pairs, many to many: batch_id, record_id, link_id."""
    # the record's id uses the whole digest: eight digits would collide within a large load
    record = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in record_key]), 256)
    pairs = cells.select("batch_id", record.alias("record_id")).distinct()
    return pairs.withColumn("link_id", F.sha2(F.concat_ws("|", "batch_id", "record_id"), 256))
