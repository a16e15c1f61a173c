"""Schema drift over any number of loads, kept as a state that each load is merged into.

The state has one row per vendor and attribute: when it was first and last seen, in how many loads, in how many spells (runs of
consecutive loads) and with how many cells. A load costs a pass over its own cells and a join of two tables with a row per attribute, however
many loads went before.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.sources.files import commit_text, names, read_text

KEY = ["vendor_id", "lab_provided_attribute"]
STATE = "vendor_id string, lab_provided_attribute string, first_seen long, last_seen long, load_count long, spells long, record_count long"


def merged(state: DataFrame, cells: DataFrame, load: int) -> DataFrame:
    """The state after ``load``, which must be later than all loads in ``state``."""
    seen = cells.groupBy(*KEY).agg(F.count("*").alias("_n"))
    both = state.join(seen, KEY, "full")
    here = F.col("_n").isNotNull()
    starts = here & ~F.coalesce(F.col("last_seen") == load - 1, F.lit(False))
    old = lambda c: F.coalesce(c, F.lit(0))
    return both.select(
        *KEY,
        F.coalesce("first_seen", F.lit(load)).cast("long").alias("first_seen"),
        F.when(here, F.lit(load)).otherwise(F.col("last_seen")).cast("long").alias("last_seen"),
        (old("load_count") + here.cast("long")).alias("load_count"),
        (old("spells") + starts.cast("long")).alias("spells"),
        (old("record_count") + old("_n")).alias("record_count"),
    )


def instability(state: DataFrame, last_load: int) -> DataFrame:
    """Per vendor: attributes seen, how many are there now, how often one came (after the vendor's first load) or went, and that per load."""
    first = state.groupBy("vendor_id").agg(F.min("first_seen").alias("vendor_first"))
    came = F.col("spells") - (F.col("first_seen") == F.col("vendor_first")).cast("long")
    went = F.col("spells") - (F.col("last_seen") == last_load).cast("long")
    rows = state.join(first, "vendor_id").groupBy("vendor_id", "vendor_first").agg(
        F.count("*").alias("attributes"),
        F.count_if(F.col("last_seen") == last_load).alias("present"),
        F.sum(came).alias("came"),
        F.sum(went).alias("went"),
    )
    loads = F.lit(last_load) - F.col("vendor_first")
    return rows.select(*[c for c in rows.columns if c != "vendor_first"], F.when(loads > 0, (F.col("came") + F.col("went")) / loads).alias("changes_per_load"))


@dataclass(frozen=True)
class DriftHistory:
    """The state after each load below ``path``; a load counts once, also if it is recorded again after a failure."""

    spark: SparkSession
    path: str

    def last_load(self) -> int:
        """The newest load recorded, -1 without any."""
        found = [n for n in names(self.spark, f"{self.path}/loads") if n[:1].isdigit()]
        return json.loads(read_text(self.spark, f"{self.path}/loads/{found[-1]}"))["load"] if found else -1

    def state(self) -> DataFrame:
        last = self.last_load()
        return self.spark.createDataFrame([], STATE) if last < 0 else self.spark.read.schema(STATE).parquet(f"{self.path}/state-{last:09d}")

    def record(self, cells: DataFrame, load: int) -> DataFrame:
        """Merge the cells of a load (numbered from 0); an earlier number than the last one is taken to be recorded already."""
        if load > self.last_load():
            merged(self.state(), cells, load).write.mode("overwrite").parquet(f"{self.path}/state-{load:09d}")
            commit_text(self.spark, f"{self.path}/loads/{load:09d}.json", json.dumps({"load": load}))
        return self.state()
