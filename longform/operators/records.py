"""Long cells as one record per row, for files whose names are not known beforehand.

A record is a map from name to value, formed by one aggregate over the cells of a row. It keeps what columns cannot tell apart: a name
whose value is null, and a name that the row does not have. What names there are is found while the records are stored, as the
schema of their variants; no list of names is gathered beforehand, and no row is read twice for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from longform.sources.storage import settle


@dataclass(frozen=True)
class Records:
    """``df``: the keys and ``record``, a variant object. ``schema``: the type of all records together, ``OBJECT<a: STRING, ...>``; ``VOID`` without rows."""

    df: DataFrame
    schema: str

    def columns(self) -> DataFrame:
        """The keys and one text column per name, in the order of names; a name that a row lacks is null.

        Names that differ only in case stay two columns. A name that is also a key is refused.
        """
        keys = [c for c in self.df.columns if c != "record"]
        names = self.names()
        if taken := sorted(set(names) & set(keys)):
            raise ValueError(f"names that are also keys: {taken}")
        entries = self.df.select(*keys, F.variant_get("record", "$", "map<string, string>").alias("_record"))
        return entries.select(*keys, *[F.try_element_at("_record", F.lit(n)).alias(n) for n in names])

    def names(self) -> list[str]:
        """All names, read from the schema by Spark's own parser of types."""
        if not self.schema.startswith("OBJECT<"):
            return []
        typed = F.lit(None).cast(self.schema.replace("OBJECT<", "STRUCT<", 1))
        return self.df.sparkSession.range(0).select(typed.alias("s")).schema["s"].dataType.names


def row_maps(
    cells: DataFrame, keys: Sequence[str], name: str = "lab_provided_attribute", value: str = "lab_provided_value"
) -> DataFrame:
    """The keys and ``record``, a map from name to value in the order of names.

    Cells without a name give no entry. Where a row has a name several times the greatest value stays, and a null only
    beside no other. The only group is a row's cells.
    """
    entry = F.struct(F.col(name).alias("key"), F.col(value).cast("string").alias("value"))
    entries = F.sort_array(F.collect_set(F.when(F.col(name).isNotNull(), entry)))
    sets = cells.groupBy(*keys).agg(entries.alias("_entries"))
    following = lambda i: F.get("_entries", i + 1)["key"]
    last = F.filter("_entries", lambda e, i: ~e["key"].eqNullSafe(following(i)))
    return sets.select(*keys, F.map_from_entries(last).alias("record"))


def pivot_records(
    cells: DataFrame, keys: Sequence[str], name: str = "lab_provided_attribute", value: str = "lab_provided_value"
) -> Records:
    """Cells to records (``row_maps``), stored once as variants together with the schema found on the way."""
    variants = row_maps(cells, keys, name, value).withColumn("record", F.to_variant_object("record"))
    stored = settle(variants, "records", schema=F.schema_of_variant_agg("record"))
    return Records(stored.df, stored.metrics["schema"] or "VOID")


def unpivot_records(
    records: DataFrame, name: str = "lab_provided_attribute", value: str = "lab_provided_value"
) -> DataFrame:
    """The keys, name and value of every entry of every record, nulls included; the inverse of ``pivot_records``."""
    keys = [c for c in records.columns if c != "record"]
    entries = F.variant_get("record", "$", "map<string, string>")
    return records.select(*keys, F.explode(entries).alias(name, value))
