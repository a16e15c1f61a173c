"""Dense numbers for names, the same in every load: a dictionary that only grows.

New names are the distinct ones that no earlier generation has. They are sorted by range over all tasks; a name's number is its
place in its task plus the names of the tasks before it (one small row per task) plus those of all earlier generations. No task sees
all names, numbers have no gaps, and no two names can share one, as they could under a short digest.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from longform.sources.files import commit_text, names, read_text
from longform.sources.storage import join_small, settle, store

ENTRY = "name string, id long"
_PLACES = 33  # bits of a row id that number the rows of a task


@dataclass(frozen=True)
class Dictionary:
    """Entries below ``path/entries-N``; ``path/generations/N.json`` tells how many there are up to generation N."""

    spark: SparkSession
    path: str

    def _generations(self) -> list[dict]:
        found = [n for n in names(self.spark, f"{self.path}/generations") if n[:1].isdigit()]
        return [json.loads(read_text(self.spark, f"{self.path}/generations/{n}")) for n in found]

    def read(self) -> DataFrame:
        """name and id of all names, from 0."""
        folders = [f"{self.path}/{g['folder']}" for g in self._generations()]
        return self.spark.read.schema(ENTRY).parquet(*folders) if folders else self.spark.createDataFrame([], ENTRY)

    def extend(self, fresh: DataFrame) -> DataFrame:
        """Number the names of the first column that have none yet; null has no number. Two writers at once: the later one fails."""
        past = self._generations()
        start = past[-1]["size"] if past else 0
        new = fresh.select(F.col(fresh.columns[0]).cast("string").alias("name")).where("name IS NOT NULL").distinct()
        new = new.join(self.read().select("name"), "name", "left_anti")
        placed = store(new.repartitionByRange("name").sortWithinPartitions("name").withColumn("_at", F.monotonically_increasing_id()), "new-names")
        task = F.shiftright("_at", _PLACES).alias("_task")
        tasks = placed.groupBy(task).agg(F.count("*").alias("n"))
        before = F.coalesce(F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        offsets = settle(tasks.select("_task", "n", before.alias("_before")), "name-offsets", size=F.sum("n"))
        size = offsets.metrics["size"] or 0
        if size:
            rows = join_small(placed.withColumn("_task", task), offsets.df.drop("n"), ["_task"], "inner", fits=offsets.fits)
            number = F.lit(start) + F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _PLACES) - 1))
            folder = f"entries-{len(past):06d}"
            rows.select("name", number.alias("id")).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            commit_text(self.spark, f"{self.path}/generations/{len(past):06d}.json", json.dumps({"folder": folder, "size": start + size}))
        return self.read()
