"""Tables laid out along a space-filling curve, and read by the zones of their files.

Reports filter cells by vendor, by attribute or by file. Sorted by one of them, files serve only filters on that one. Here each column
is cut into ranges, the bits of the ranges' numbers are interleaved to a place on the Z-order curve, and files are ranges of the curve: each then holds a narrow
box of all columns. A zone table keeps least and greatest value of every file, so that a read opens only the files whose box the filter meets; within a
file Parquet's own statistics prune row groups.

Cuts come from at most ``SAMPLE`` distinct values of a column (those with the smallest hashes). They decide only how even the boxes are: every row is
written, and zones are taken from the written rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from longform.sources.storage import settle

#: Bits of a column's range number, and distinct values that the cuts between ranges are taken from.
BITS = 8
SAMPLE = 4096
ROWS_PER_FILE = 20_000_000


def range_cuts(values: DataFrame, column: str) -> list[str]:
    """At most 2^BITS - 1 values that cut a column into ranges, each the least of its range.

    ``values`` holds the column's distinct values, in any number of rows.
    """
    known = values.select(column).where(F.col(column).isNotNull()).distinct()
    sample = known.orderBy(F.xxhash64(column), column).limit(SAMPLE)
    found = sorted((r[0] for r in sample.collect()), key=lambda v: v.encode())  # Spark orders text by its bytes
    ranges = min(len(found), 2**BITS)
    return [found[k * len(found) // ranges] for k in range(1, ranges)]


def range_number(value: Column, cuts: Sequence[str]) -> Column:
    """How many cuts are not above the value, by binary search; 0 for null.

    Numbers are stretched to all ``BITS`` bits, so that a column of few values counts on the curve as much as one of many.
    """
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(BITS))])
    up = lambda at, step: F.when(F.get(table, at + step - 1) <= value, step).otherwise(F.lit(0))
    return F.aggregate(steps, F.lit(0), lambda at, step: at + up(at, step), lambda at: (at * (1 << BITS) / (len(cuts) + 1)).cast("int"))


def z_order(numbers: Sequence[Column]) -> Column:
    """The place on the curve of a cell of the grid: the numbers' bits in turn, the first column's the higher ones."""
    k = len(numbers)
    if not 1 <= k * BITS <= 62:
        raise ValueError(f"between 1 and {62 // BITS} columns, not {k}")
    placed = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        for b in range(BITS):
            bit = F.shiftright(number, b).bitwiseAND(F.lit(1)).cast("long")
            placed = placed.bitwiseOR(F.shiftleft(bit, b * k + (k - 1 - i)))
    return placed


@dataclass(frozen=True)
class ClusteredTable:
    """Rows below ``path/rows``, one row of ``path/zones`` per file of them. ``columns`` are text columns."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...]

    def write(self, df: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> None:
        """Replace the table by the rows of ``df``, all of them, in files of about ``rows_per_file`` rows.

        ``df`` is read twice: for the distinct values, and for the rows. Rows of one place on the curve, however many, are cut further by a
        hash of their other columns. The write is one overwrite; zones follow it.
        """
        values = df.groupBy(*self.columns).agg(F.count("*").alias("_n"))
        values = settle(values, "cluster-values", rows=F.sum("_n"))
        files = max(1, -(-(values.metrics["rows"] or 0) // rows_per_file))
        place = z_order([range_number(F.col(c), range_cuts(values.df, c)) for c in self.columns])
        placed = df.withColumns({"_place": place, "_spread": F.xxhash64(*df.columns)})
        ranged = placed.repartitionByRange(files, "_place", "_spread").sortWithinPartitions("_place", *self.columns)
        # one task is one file
        ranged.drop("_place", "_spread").write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(f"{self.path}/rows")
        written = self.spark.read.schema(df.schema).parquet(f"{self.path}/rows").withColumn("_file", F.col("_metadata.file_path"))
        least = [F.min(c).alias(f"min_{c}") for c in self.columns] + [F.max(c).alias(f"max_{c}") for c in self.columns]
        nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in self.columns]
        zones = written.groupBy("_file").agg(F.count("*").alias("row_count"), *least, *nulls)
        zones.withColumnRenamed("_file", "file").write.mode("overwrite").parquet(f"{self.path}/zones")

    def zones(self) -> DataFrame:
        """One row per file: file, row_count, and min_, max_ and nulls_ of each clustered column."""
        return self.spark.read.parquet(f"{self.path}/zones")

    def files_for(self, wanted: Mapping[str, Sequence[str | None]]) -> DataFrame:
        """The zones whose box holds, in each column of ``wanted``, one of its values."""
        if unknown := sorted(set(wanted) - set(self.columns)):
            raise ValueError(f"not clustered by {unknown}")
        zones = self.zones()
        for column, values in wanted.items():
            meets = F.lit(False)
            for v in values:
                inside = F.lit(v).between(F.col(f"min_{column}"), F.col(f"max_{column}"))
                meets = meets | (F.col(f"nulls_{column}") > 0 if v is None else F.coalesce(inside, F.lit(False)))
            zones = zones.where(meets)
        return zones

    def read(self, wanted: Mapping[str, Sequence[str | None]] | None = None) -> DataFrame:
        """The rows that have, in each column of ``wanted``, one of its values; files whose zone excludes them are not opened."""
        rows = f"{self.path}/rows"
        schema = self.spark.read.parquet(rows).schema
        if not wanted:
            return self.spark.read.schema(schema).parquet(rows)
        files = [r.file for r in self.files_for(wanted).select("file").collect()]  # as many as any scan lists in the driver
        if not files:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).parquet(*files)
        for column, values in wanted.items():
            known = F.col(column).isin([v for v in values if v is not None])
            found = found.where(known | F.col(column).isNull() if None in values else known)
        return found
