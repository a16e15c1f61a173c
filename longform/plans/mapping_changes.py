"""Change data capture of the mapping tables: a silver table that is mended where its mapping changed.

Mapping and canonical table are kept in versions. Silver is stored by vendor and attribute, the key of the mapping, and notes
which version it was made with. When a newer version exists, the versions are compared key by key, the cells of
changed keys alone are standardised again, and only their folders are written anew; the files of all others stay as
they are. A refresh that fails is run again: it compares the same versions and overwrites the same folders.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.operators.silver import CANONICAL_COLUMNS, resolved_mapping, standardize
from longform.sources.files import commit_text, names, read_text
from longform.sources.storage import join_small, settle

KEY = ["vendor_id", "lab_provided_attribute"]


def _multiset(rows: DataFrame, name: str) -> DataFrame:
    """Per key a fingerprint of its rows, repeated ones included, whatever their order."""
    each = F.xxhash64(*[F.coalesce(F.col(c), F.lit("\0")) for c in CANONICAL_COLUMNS])
    other = F.xxhash64(each, *CANONICAL_COLUMNS)
    print_ = F.struct(F.count("*").alias("n"), F.sum(each.cast("decimal(38,0)")).alias("a"), F.sum(other.cast("decimal(38,0)")).alias("b"))
    return rows.groupBy(*KEY).agg(print_.alias(name))


def mapping_changes(old: tuple[DataFrame, DataFrame], new: tuple[DataFrame, DataFrame]) -> DataFrame:
    """vendor_id, lab_provided_attribute and change (new, gone, changed) between two pairs of (mapping, canonical).

    A key has changed if what its cells are joined to has: other canonical ids, other facts about them, another number of rows.
    """
    sides = []
    for (mapping, canonical), name in ((old, "before"), (new, "after")):
        resolved = resolved_mapping(mapping, canonical, ["vendor_id", "vendor_column_name"])
        sides.append(_multiset(resolved.withColumnRenamed("vendor_column_name", KEY[1]), name))
    both = sides[0].join(sides[1], KEY, "full")
    change = F.when(F.col("before").isNull(), "new").when(F.col("after").isNull(), "gone").when(F.col("before") != F.col("after"), "changed")
    return both.select(*KEY, change.alias("change")).where("change IS NOT NULL")


def save_version(spark: SparkSession, store: str, mapping: DataFrame, canonical: DataFrame) -> int:
    """Keep a pair of mapping tables as the next version; returns its number, from 1. A version appears whole or not at all."""
    version = latest_version(spark, store) + 1
    for kind, df in (("mapping", mapping), ("canonical", canonical)):
        df.write.mode("overwrite").parquet(f"{store}/{kind}-{version:06d}")
    commit_text(spark, f"{store}/versions/{version:06d}.json", json.dumps({"version": version}))
    return version


def latest_version(spark: SparkSession, store: str) -> int:
    """The newest version's number, 0 without any."""
    return max((int(n.split(".")[0]) for n in names(spark, f"{store}/versions") if n[:1].isdigit()), default=0)


def load_version(spark: SparkSession, store: str, version: int) -> tuple[DataFrame, DataFrame]:
    return tuple(spark.read.parquet(f"{store}/{kind}-{version:06d}") for kind in ("mapping", "canonical"))


@dataclass(frozen=True)
class SilverTable:
    """Standardised cells below ``path``, in a folder for each vendor and attribute; ``{path}-notes`` tells the mapping's version."""

    spark: SparkSession
    path: str

    def version(self) -> int:
        found = [n for n in names(self.spark, f"{self.path}-notes") if n[:1].isdigit()]
        return json.loads(read_text(self.spark, f"{self.path}-notes/{found[-1]}"))["version"] if found else 0

    def _note(self, version: int) -> None:
        place = len(names(self.spark, f"{self.path}-notes"))
        commit_text(self.spark, f"{self.path}-notes/{place:06d}.json", json.dumps({"version": version}))

    def _write(self, silver: DataFrame, only: bool) -> None:
        # rebalancing gathers a folder's rows in few files, and splits those of a large one over several tasks
        writer = silver.hint("rebalance", *KEY).write.mode("overwrite").partitionBy(*KEY)
        writer.option("partitionOverwriteMode", "dynamic" if only else "static").parquet(self.path)

    def read(self, cells: DataFrame) -> DataFrame:
        """The stored rows, with the types that ``cells`` have (folder names alone would not tell them)."""
        none = cells.where("false")
        for c in CANONICAL_COLUMNS:
            none = none.withColumn(c, F.lit(None).cast("string"))
        return self.spark.read.schema(none.schema).parquet(self.path)

    def refresh(self, cells: DataFrame, store: str) -> DataFrame | None:
        """Bring the table to the newest mapping; returns the keys that were written anew, None if nothing had to be.

        ``cells`` are those the table was made of: any layout, but one partitioned by the key lets Spark read changed keys only.
        """
        newest, held = latest_version(self.spark, store), self.version()
        if held == newest:
            return None
        new = load_version(self.spark, store, newest)
        if not held:
            self._write(standardize(cells, *new), only=False)
            self._note(newest)
            return cells.select(*KEY).distinct()
        changed = settle(mapping_changes(load_version(self.spark, store, held), new), "mapping-changes", n=F.count("*"))
        if changed.metrics["n"]:
            mine = join_small(cells, changed.df.select(*KEY), KEY, "left_semi", fits=changed.fits)
            self._write(standardize(mine, *new), only=True)
        self._note(newest)
        return changed.df
