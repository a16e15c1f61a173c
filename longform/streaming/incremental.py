"""Loading only what is new: a file ledger for batch runs, a file stream for continuous ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from longform.functions.dialect import CsvDialect
from longform.plans.bronze import land_lines
from longform.sources.csv_lines import lines_of


def new_files(files: DataFrame, ledger: DataFrame, key: str = "file_id") -> DataFrame:
    """Files that the ledger does not list. Both have one row per file."""
    return files.join(ledger.select(key).distinct(), key, "left_anti")


def stream_long(
    spark: SparkSession,
    path: str,
    output: str,
    checkpoint: str,
    dialect: CsvDialect = CsvDialect(),
    threshold: int | Mapping[str, int] = 10,
    max_files: int = 1000,
    available_now: bool = True,
    glob: str | None = None,
) -> StreamingQuery:
    """Land files below ``path`` as they arrive; the stream's checkpoint is the ledger.

    Every micro-batch is landed whole by ``land_lines`` into
    ``{output}/cells/batch_id=N`` and ``{output}/errors/batch_id=N``. A batch that is
    run again after a failure overwrites its own folder, so no cell is doubled. A file
    belongs to one batch and must be complete when it appears.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        landing = land_lines(batch, dialect, threshold)
        landing.cells.write.mode("overwrite").parquet(f"{output}/cells/batch_id={batch_id}")
        landing.errors.write.mode("overwrite").parquet(f"{output}/errors/batch_id={batch_id}")

    reader = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = lines_of(reader.format("text").load(path), dialect)
    writer = lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def landed(spark: SparkSession, output: str) -> DataFrame:
    """All cells a stream has landed so far."""
    return spark.read.parquet(f"{output}/cells")
