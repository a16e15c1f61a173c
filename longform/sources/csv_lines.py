"""Raw-grid scan: directories of CSV text to numbered records, in parallel.

Files are read as lines by Spark's splittable text source, so a file of any size
is spread over many tasks. What a line is worth depends on its place in the file
(its number; whether it continues a quoted field), and that is settled from one
small row per file split:

1. A first pass summarises every split with plain aggregates: where its row ids
   start, how many lines it has, its first line wide enough to be a header, and
   whether any line could leave a quoted field open.
2. Windows over those summaries give each split its first line number and its
   file's header.
3. A second pass joins the lines to their split by ``(file_id, part)``. A split is
   at most ``spark.sql.files.maxPartitionBytes`` of text, so that key is never hot.

Only files in which some line leaves a quoted field open take the longer path
that glues lines together (``_glued_records``).

Row ids come from ``monotonically_increasing_id`` on the bare scan. Both passes
use one DataFrame, hence one file listing, and the number of splits is pinned
(``pin_splits``), so they are cut alike whatever the cluster's size is by then; a retried
task gives the same ids. Should the plan change all the same, the second pass fails
rather than lose a line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from longform.functions.dialect import CsvDialect
from longform.functions.names import logical_file_name
from longform.sources.storage import fits_broadcast, join_small, pin_splits, placed_in_split, settle, store

NO_HEADER = "Could not find header row."
UNCLOSED = "Quoted field is never closed."
EMPTY = "File is empty."
UNDECODABLE = "File is not valid in its encoding."

SPLIT = ["file_id", "part"]


@dataclass(frozen=True)
class RecordScan:
    """Numbered records of a set of files.

    ``records``: file_id, part, line_no (0-based), record.
    ``files``: file_id, file_name, line_count, header_line_no, header, error; one row per file. A file
    with a header may have an error too, which then concerns only a part of it.
    ``splits``: file_id, part; one row per file split.
    """

    records: DataFrame
    files: DataFrame
    splits: DataFrame

    def with_file_facts(self, facts: DataFrame, fits: bool) -> DataFrame:
        """Records joined to a table with one row per file.

        A table too large to broadcast is first repeated per split: rows then shuffle by
        ``(file_id, part)``, evenly even where one file holds most of them.
        """
        if fits:
            return self.records.join(F.broadcast(facts), "file_id")
        return self.records.join(self.splits.join(facts, "file_id"), SPLIT)


def scan_lines(spark: SparkSession, path: str | list[str], dialect: CsvDialect = CsvDialect()) -> DataFrame:
    """One row per physical line: file_id, part, value."""
    reader = spark.read.option("recursiveFileLookup", True)
    if dialect.encoding.lower().startswith("utf-16"):
        reader = reader.option("encoding", dialect.encoding).option("lineSep", "\n")
    return lines_of(reader.text(path), dialect)


def lines_of(text: DataFrame, dialect: CsvDialect = CsvDialect()) -> DataFrame:
    """The line columns of a text-source DataFrame, batch or micro-batch."""
    return text.select(
        F.col("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_block_start").alias("part"),
        dialect.decoded(F.col("value")).alias("value"),
    )


def filled(cells: Column) -> Column:
    """How many cells hold something."""
    return F.size(F.array_remove(F.array_compact(cells), ""))


def empty_set(position: Column) -> Column:
    """An aggregate that is always empty, over a position that is never negative.

    Beside it Spark aggregates by object hash, so that ``min_by`` over text or arrays
    needs no sort of all rows.
    """
    return F.collect_set(F.when(position < 0, F.lit(True)))


def _split_summary(lines: DataFrame, dialect: CsvDialect, threshold: Column | int) -> DataFrame:
    """One row per file split. All aggregates combine map-side."""
    wide = F.size(F.array_remove(dialect.cells(F.col("value")), "")) >= threshold
    marked = lines.select("*", F.when(wide, F.col("seq")).alias("wide_at"))
    return marked.groupBy(*SPLIT).agg(
        F.min("seq").alias("start_seq"),
        F.count("*").alias("line_count"),
        F.min("wide_at").alias("wide_at"),
        F.min_by("value", "wide_at").alias("wide_text"),
        F.max(F.when(dialect.is_broken(F.col("value")), 1).otherwise(0)).alias("undecodable"),
        # a set, not bool_or, for the reason given at empty_set
        F.collect_set(F.when(dialect.leaves_open(F.col("value")), F.lit(True))).alias("opens"),
    )


def _place_splits(summary: DataFrame) -> DataFrame:
    """Give each split its first line number and its file's facts. One small row per split."""
    before = Window.partitionBy("file_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    placed = summary.withColumn("first_line", F.coalesce(F.sum("line_count").over(before), F.lit(0)))
    header = F.when(
        F.col("wide_at").isNotNull(),
        F.struct((F.col("first_line") + F.col("wide_at") - F.col("start_seq")).alias("at"), F.col("wide_text").alias("text")),
    )
    return placed.select(
        *SPLIT,
        "start_seq",
        "line_count",
        "first_line",
        F.sum("line_count").over(whole).alias("file_lines"),
        F.max("undecodable").over(whole).alias("undecodable"),
        F.first(header, ignorenulls=True).over(whole).alias("header"),
        F.max(F.size("opens")).over(whole).alias("opens"),
    )


def number_lines(lines: DataFrame, splits: DataFrame, fits: bool | None = None) -> DataFrame:
    """Lines (with ``seq``) with their 0-based number in the file: file_id, part, line_no, value, and the split's ``opens``."""
    narrow = splits.select(*SPLIT, "start_seq", "line_count", "first_line", "opens")
    placed = join_small(lines, narrow, SPLIT, "left", fits=fits)
    at = placed_in_split(F.col("seq"), F.col("start_seq"), F.col("line_count"))
    return placed.select(*SPLIT, (F.coalesce("first_line", F.lit(0)) + at).alias("line_no"), "value", "opens")


def _entry_state(df: DataFrame, before: WindowSpec) -> DataFrame:
    """How each step of a quote-state sequence is entered, given how the sequence is.

    The state is 1 inside a quoted field, else 0. A step either resets it (``reset`` not
    null) or, if ``flips`` is 1, turns it over. Adds ``in_0`` and ``in_1``: the state on
    entering the step if the sequence is entered outside, or inside.
    """
    parity = F.pmod(F.coalesce(F.sum("flips").over(before), F.lit(0)), F.lit(2)).cast("int")
    # what the state would be now, had no step turned it over before the last reset
    base = F.last(F.when(F.col("reset").isNotNull(), F.pmod(F.col("reset") + F.col("_p"), F.lit(2))), ignorenulls=True)
    entered = lambda e: F.pmod(F.coalesce(F.col("_b"), F.lit(e)) + F.col("_p"), F.lit(2))
    placed = df.withColumn("_p", parity).withColumn("_b", base.over(before))
    return placed.withColumns({"in_0": entered(0), "in_1": entered(1)}).drop("_p", "_b")


def _glued_records(numbered: DataFrame, dialect: CsvDialect) -> tuple[DataFrame, DataFrame]:
    """Logical records of files whose quoted fields span lines.

    ``numbered`` is file_id, part, line_no, value. Every line is a step on the state
    "inside a quoted field". Windows within a split, which is small, work out each line
    for both ways its split may be entered; one summary row per split then settles which
    it is. Lines that are whole records pass through; only the others are grouped.
    Returns the records, and the files in which a quote is never closed: those that end inside a
    quoted field. Their last record runs to the end of the file.
    """
    value = F.col("value")
    steps = numbered.withColumns({"_o": dialect.leaves_open(value), "_i": dialect.stays_open(value)}).select(
        *SPLIT,
        "line_no",
        "value",
        F.when(F.col("_o") == F.col("_i"), F.col("_o").cast("int")).alias("reset"),
        (F.col("_o") & ~F.col("_i")).cast("int").alias("flips"),
    )
    in_split = Window.partitionBy(*SPLIT).orderBy("line_no")
    so_far = in_split.rowsBetween(Window.unboundedPreceding, 0)
    left = lambda e: F.coalesce(F.col("reset"), F.pmod(F.col(f"in_{e}") + F.col("flips"), F.lit(2)))
    lines = _entry_state(steps, in_split.rowsBetween(Window.unboundedPreceding, -1)).select(
        *SPLIT,
        "line_no",
        "value",
        "in_0",
        "in_1",
        left(0).alias("out_0"),
        left(1).alias("out_1"),
        F.sum(1 - F.col("in_0")).over(so_far).alias("starts_0"),
        F.sum(1 - F.col("in_1")).over(so_far).alias("starts_1"),
    )
    # read several times below: store it rather than scan and sort the files again
    lines = store(lines, "quote-steps")

    # one row per split; the state after its last line is packed beside the line's number
    last = F.max(F.col("line_no") * 4 + F.col("out_0") * 2 + F.col("out_1"))
    ends = lines.groupBy(*SPLIT).agg(
        F.pmod(last, F.lit(4)).alias("out"),
        F.max("starts_0").alias("starts_0"),
        F.max("starts_1").alias("starts_1"),
    )
    step = ends.withColumns(
        {
            "reset": F.when(F.col("out").isin(0, 3), (F.col("out") == 3).cast("int")),
            "flips": (F.col("out") == 2).cast("int"),
        }
    )
    before = Window.partitionBy("file_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a file is entered outside a quoted field
    states = _entry_state(step, before).withColumnRenamed("in_0", "entered")
    starts = F.when(F.col("entered") == 1, F.col("starts_1")).otherwise(F.col("starts_0"))
    offset = F.coalesce(F.sum(starts).over(before), F.lit(0))
    left_at_end = F.coalesce(F.col("reset"), F.pmod(F.col("entered") + F.col("flips"), F.lit(2)))
    states = settle(states.select(*SPLIT, "entered", offset.alias("offset"), left_at_end.alias("left")), "quote-states")
    last_split = states.df.groupBy("file_id").agg(F.max_by("left", "part").alias("left"))

    chosen = lambda name: F.when(F.col("entered") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    placed = join_small(lines, states.df.drop("left"), SPLIT, "inner", fits=states.fits).select(
        *SPLIT,
        "line_no",
        "value",
        (F.col("offset") + chosen("starts") - 1).alias("record_no"),
        ((chosen("in") == 0) & (chosen("out") == 0)).alias("whole"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("line_no", "value")))
    several = (
        placed.filter(~F.col("whole"))
        .groupBy("file_id", "record_no")
        .agg(F.min("part").alias("part"), F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("record"))
        .select(*SPLIT, F.col("record_no").alias("line_no"), "record")
    )
    single = placed.filter("whole").select(*SPLIT, F.col("record_no").alias("line_no"), F.col("value").alias("record"))
    # the grouped records are read for the header and again for the cells
    records = single.unionByName(store(several, "records"))
    return records, last_split.filter(F.col("left") == 1).select("file_id")


def scan_records(
    lines: DataFrame, dialect: CsvDialect = CsvDialect(), threshold: Column | int = 10
) -> RecordScan:
    """Numbered records of all files in ``lines``, and one row of facts per file.

    ``lines`` must be the bare scan, ``file_id, part, value``: row ids are given here.
    ``threshold`` is the number of filled cells that makes a record the header; it
    may be a Column over ``file_id``.
    """
    pin_splits(lines.sparkSession)
    lines = lines.withColumn("seq", F.monotonically_increasing_id())
    gluing = F.coalesce(F.max(F.col("opens") > 0), F.lit(False))
    stored = settle(_place_splits(_split_summary(lines, dialect, threshold)), "splits", gluing=gluing)
    splits, is_plain = stored.df, F.col("opens") == 0
    numbered = number_lines(lines, splits, stored.fits)
    # a line whose split is unknown must reach its number, which then fails: no filter may drop it before
    plain_line = F.coalesce("opens", F.lit(0)) == 0
    records = numbered.filter(plain_line).select(*SPLIT, "line_no", F.col("value").alias("record"))
    per_file = splits.groupBy("file_id").agg(
        F.first("file_lines").alias("line_count"),
        F.first("header.at").alias("header_line_no"),
        F.first("header.text").alias("header"),
        F.max("undecodable").alias("undecodable"),
        F.first("opens").alias("opens"),
    )
    files = per_file.filter(is_plain).drop("opens").withColumn("unclosed", F.lit(False))

    if stored.metrics["gluing"]:
        glued, unclosed = _glued_records(numbered.filter(~plain_line).drop("opens"), dialect)
        records = records.unionByName(glued)
        wide = filled(dialect.cells(F.col("record"))) >= threshold
        found = (
            glued.select("*", F.when(wide, F.col("line_no")).alias("at"))
            .groupBy("file_id")
            .agg(
                F.count("*").alias("line_count"),
                F.min("at").alias("header_line_no"),
                F.min_by("record", "at").alias("header"),
                empty_set(F.col("line_no")).alias("_hash"),
            )
            .filter(F.size("_hash") == 0)
            .drop("_hash")
        )
        facts = per_file.select("file_id", "undecodable").join(unclosed.withColumn("open", F.lit(True)), "file_id", "left")
        found = found.join(facts, "file_id").withColumn("unclosed", F.coalesce("open", F.lit(False))).drop("open")
        files = files.unionByName(found)
    error = (
        F.when(F.col("header_line_no").isNull(), F.lit(NO_HEADER))
        .when(F.col("unclosed"), F.lit(UNCLOSED))
        .when(F.col("undecodable") > 0, F.lit(UNDECODABLE))
    )
    files = files.select(
        "file_id",
        logical_file_name(F.col("file_id")).alias("file_name"),
        "line_count",
        "header_line_no",
        "header",
        error.alias("error"),
    )
    return RecordScan(records, files, splits.select(*SPLIT))


def empty_files(spark: SparkSession, path: str | list[str], headers: DataFrame, errors: DataFrame) -> DataFrame:
    """file_id, file_name, error of the files without a byte, which Spark's scans pass over.

    They are the files of the listing (which the driver holds for any scan) that no scan reports. No file is read. Every source of Spark leaves
    out files of length 0, ``binaryFile`` too, so the listing is the only place that names them.
    """
    listed = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    names = spark.createDataFrame([(p,) for p in listed], "file_id string")
    names = names.select(F.regexp_replace("file_id", r"^([a-z0-9]+):///", "$1:/").alias("file_id"))
    seen = headers.select("file_id").unionByName(errors.select("file_id")).distinct()
    seen = seen.select(F.regexp_replace("file_id", r"^([a-z0-9]+):///", "$1:/").alias("file_id"))
    empty = names.join(seen, "file_id", "left_anti")
    return empty.select("file_id", logical_file_name(F.col("file_id")).alias("file_name"), F.lit(EMPTY).alias("error"))


def read_grid(spark: SparkSession, path: str | list[str], dialect: CsvDialect = CsvDialect()) -> DataFrame:
    """Files as a raw grid: file_id, file_name, part, line_no, n_tokens, cells.

    Rows may differ in width; an empty cell is null.
    """
    scan = scan_records(scan_lines(spark, path, dialect), dialect, threshold=1)
    names = scan.files.select("file_id", "file_name")
    named = scan.with_file_facts(names, fits_broadcast(names))
    cells = F.transform(dialect.cells(F.col("record")), lambda c: F.nullif(c, F.lit("")))
    return named.select(*SPLIT, "file_name", "line_no", cells.alias("cells")).select(
        "file_id", "file_name", "part", "line_no", F.size("cells").alias("n_tokens"), "cells"
    )
