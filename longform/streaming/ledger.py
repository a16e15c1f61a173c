"""Batch loads that remember: a ledger of landed files, published together with their cells.

Below ``output`` lie ``cells/run=R``, ``errors/run=R`` and ``files/run=R``, written by run R, and ``manifests/N.json``, one for
each published run in order. What is not named by a manifest does not exist for readers. A run goes in two phases:

1. Prepare: the files that no published run lists are landed into the run's folders, and a note ``prepared/R.json`` says that
   they are whole and which manifest they follow.
2. Publish: the note becomes the next manifest, by one atomic rename. Cells and file list appear together.

A run that fails before its note leaves folders that nobody reads, and its files are landed anew. One that fails
between the phases is published by the next run, without landing its files again, provided
that nothing was published in the meantime. If two runs publish at once, the rename of the later one fails and its cells stay invisible.

A file is known by its path. One without a byte, which may still be in the writing, is taken up once it has some. A file that was changed after it was landed is not landed again; ``changed_files`` finds it.
Files that cannot be landed are in the ledger too (with no cells), and their errors beside it. Of a large backlog each run takes ``max_files``, so
that the driver never holds more paths than that; ``land_new`` goes on until none is left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.functions.dialect import CsvDialect
from longform.plans.bronze import land_long
from longform.sources.files import Taken, commit_text, listed_files, names, read_text
from longform.sources.storage import join_small, settle

CELLS = (
    "file_id string, file_name string, vendor_id string, row_index bigint, column_index int, lab_provided_attribute string, "
    "lab_provided_value string, source_line_no bigint, source_column_index int, ingestion_timestamp timestamp, run string"
)
ERRORS = "file_id string, file_name string, error string, run string"
FILES = "file_id string, file_name string, file_size bigint, modified_at timestamp, run string"
SCHEMAS = {"cells": CELLS, "errors": ERRORS, "files": FILES}


def published(spark: SparkSession, output: str) -> list[dict]:
    """The manifests in order: run, files, cells."""
    found = [n for n in names(spark, f"{output}/manifests") if n.endswith(".json") and not n.startswith(".")]
    return [json.loads(read_text(spark, f"{output}/manifests/{n}")) for n in found]


def _read(spark: SparkSession, output: str, kind: str, runs: list[str]) -> DataFrame:
    folders = set(names(spark, f"{output}/{kind}"))
    paths = [f"{output}/{kind}/run={r}" for r in runs if f"run={r}" in folders]
    if not paths:
        return spark.createDataFrame([], SCHEMAS[kind])
    return spark.read.schema(SCHEMAS[kind]).option("basePath", f"{output}/{kind}").parquet(*paths)


def landed_table(spark: SparkSession, output: str, kind: str = "cells") -> DataFrame:
    """``cells``, ``errors`` or ``files`` of all published runs, with ``run``."""
    return _read(spark, output, kind, [m["run"] for m in published(spark, output)])


def changed_files(spark: SparkSession, path: str | list[str], output: str) -> DataFrame:
    """Files whose size or time of change differs from what the ledger holds."""
    ledger = landed_table(spark, output, "files").select("file_id", F.col("file_size").alias("landed_size"), F.col("modified_at").alias("landed_at"))
    now = listed_files(spark, path).join(ledger, "file_id")
    return now.where("file_size <> landed_size OR modified_at <> landed_at")


def publish(spark: SparkSession, output: str, note: dict) -> None:
    """Make a prepared run the next manifest; raises ``Taken`` if another one is."""
    body = {k: note[k] for k in ("run", "files", "cells")}
    commit_text(spark, f"{output}/manifests/{note['follows']:012d}.json", json.dumps(body))


def recover(spark: SparkSession, output: str) -> list[str]:
    """Publish the run that was prepared and not published, if it follows the last manifest; returns its id."""
    done = published(spark, output)
    known = {m["run"] for m in done}
    for name in names(spark, f"{output}/prepared"):
        note = json.loads(read_text(spark, f"{output}/prepared/{name}")) if name.endswith(".json") and not name.startswith(".") else None
        if note and note["run"] not in known and note["follows"] == len(done):
            publish(spark, output, note)
            return [note["run"]]
    return []


def prepare(
    spark: SparkSession,
    path: str | list[str],
    output: str,
    dialect: CsvDialect = CsvDialect(),
    threshold: int | Mapping[str, int] = 10,
    max_files: int = 10_000,
    glob: str | None = None,
    **options,
) -> dict | None:
    """Land the next files that no published run lists into folders of their own; None if there are none."""
    done = published(spark, output)
    ledger = settle(landed_table(spark, output, "files").select("file_id").distinct(), "ledger")
    fresh = join_small(listed_files(spark, path, glob), ledger.df, ["file_id"], "left_anti", fits=ledger.fits)
    chosen = fresh.orderBy("file_id").limit(max_files).collect()
    if not chosen:
        return None
    run = uuid.uuid4().hex
    at = lambda kind: f"{output}/{kind}/run={run}"
    files = spark.createDataFrame(chosen, fresh.schema)
    files.write.parquet(at("files"))
    landing = land_long(spark, [r["file_id"] for r in chosen], dialect, threshold=threshold, **options)
    landing.cells.write.parquet(at("cells"))
    landing.errors.write.parquet(at("errors"))
    cells = _read(spark, output, "cells", [run]).count()  # from the files' footers
    note = {"run": run, "follows": len(done), "files": len(chosen), "cells": cells}
    commit_text(spark, f"{output}/prepared/{run}.json", json.dumps(note))
    return note


def land_new(
    spark: SparkSession,
    path: str | list[str],
    output: str,
    *args,
    before_publish: Callable[[dict], None] | None = None,
    **options,
) -> list[str]:
    """Publish what an earlier run left prepared, then land all files that the ledger lacks; returns the runs published.

    Takes the arguments of ``prepare``. ``before_publish`` is called with the note of each prepared run.
    """
    runs = recover(spark, output)
    while note := prepare(spark, path, output, *args, **options):
        if before_publish:
            before_publish(note)
        try:
            publish(spark, output, note)
        except Taken:
            raise RuntimeError(f"another run was published first; the files of run {note['run']} are taken up by the next one") from None
        runs.append(note["run"])
    return runs
