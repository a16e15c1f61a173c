"""Shared scratch space and joins against small tables.

Tables that several passes need (one row per file or per file split) are written
once to a folder under ``spark.checkpoint.dir``. That cuts their lineage on
storage every executor sees, and gives a table whose size can be measured before
anything is broadcast.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

BROADCAST_BYTES = 256 * 1024 * 1024
BROADCAST_ROWS = 2_000_000
MAX_SALTS = 256
#: Keys that a sketch of a large side may name as hot, and those it tracks to find them.
HOT_KEYS = 256
TRACKED_KEYS = 8192


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared folder the session names."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="longform-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/longform-{label}-{uuid.uuid4().hex}"


def pin_splits(spark: SparkSession) -> None:
    """Keep the plan of file splits apart from the number of executors.

    Spark aims at as many splits as the cluster has cores unless
    ``spark.sql.files.minPartitionNum`` says how many; the number of the moment is written there
    once, so that scans of the same files planned earlier and later cut them alike.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        cores = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(cores))


def placed_in_split(seq: Column, start: Column, count: Column) -> Column:
    """The place of a row within its split; fails where the scan was cut differently from the one that was summarised."""
    at = seq - start
    changed = F.raise_error(F.lit("The files are split differently than when they were numbered; keep spark.sql.files.* unchanged."))
    return F.when(start.isNotNull() & (at >= 0) & (at < count), at).otherwise(changed.cast("long"))


@dataclass(frozen=True)
class Settled:
    """A stored table, whether it may be broadcast, and what was observed while it was written."""

    df: DataFrame
    fits: bool
    metrics: dict


def _size(df: DataFrame) -> tuple[Column, Column]:
    """Rows, and the length of their text."""
    return F.count("*"), F.coalesce(F.sum(F.length(F.to_json(F.struct(*df.columns)))), F.lit(0))


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder once and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str, **metrics: Column) -> Settled:
    """``store`` for a table that is to be joined to a larger one.

    The write observes the table's size, and any ``metrics`` (aggregates), so no
    further job is needed to decide on a broadcast.
    """
    seen = Observation()
    rows, chars = _size(df)
    observed = df.observe(seen, rows.alias("_rows"), chars.alias("_chars"), *[m.alias(n) for n, m in metrics.items()])
    stored = store(observed, label)
    # nothing is observed where the planner finds the table empty beforehand
    found = {"_rows": 0, "_chars": 0, **dict.fromkeys(metrics), **seen.get}
    fits = found.pop("_rows") <= BROADCAST_ROWS and found.pop("_chars") <= BROADCAST_BYTES
    return Settled(stored, fits, found)


def fits_broadcast(df: DataFrame) -> bool:
    """Measure a side before it is broadcast. For small sides: this runs a job over it."""
    rows, chars = df.agg(*_size(df)).first()
    return rows <= BROADCAST_ROWS and chars <= BROADCAST_BYTES


def hot_keys(df: DataFrame, keys: Sequence[str], tasks: int) -> dict[int, int]:
    """Hashes of the keys that hold more than a task's share of the rows, and over how many tasks to deal each.

    One pass counts with a sketch of frequent items, which combines map-side and holds ``TRACKED_KEYS`` keys: any
    key with more than a few thousandths of the rows is in it. Nulls count as a key.
    """
    top = F.expr(f"approx_top_k(_key, {HOT_KEYS}, {TRACKED_KEYS})")
    seen = df.select(F.xxhash64(*keys).alias("_key")).agg(F.count("*").alias("n"), top.alias("top")).first()
    share = max(1, seen["n"] // max(1, tasks))
    return {t["item"]: min(MAX_SALTS, -(-t["count"] // share)) for t in seen["top"] or () if t["count"] > share}


def deal_hot(big: DataFrame, small: DataFrame, keys: Sequence[str], spread: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column ``_salt`` to join on beside the keys.

    Rows of a hot key of ``big`` get a salt from the ``spread`` columns, and the rows of ``small`` that have this key are repeated once
    for each of its salts. All others have salt 0 and are there once.
    """
    hot = hot_keys(big, keys, int(big.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not hot:
        return big.withColumn("_salt", F.lit(0)), small.withColumn("_salt", F.lit(0))
    table = F.from_json(F.lit(json.dumps({str(k): n for k, n in hot.items()})), "map<string, int>")
    salts = F.coalesce(F.try_element_at(table, F.xxhash64(*keys).cast("string")), F.lit(1))
    dealt = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
    return dealt, small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))


def join_small(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    spread: Sequence[str] = (),
    fits: bool | None = None,
) -> DataFrame:
    """Join ``big`` to a side that is usually small, on the columns both name ``keys``.

    The small side is broadcast if it measures within the limit; ``fits`` passes on a
    measurement already made (of the side or of a table it is part of). Otherwise hot keys of the big
    side are salted by the ``spread`` columns and their rows of the small side repeated once per
    salt (``deal_hot``), so that one hot key is shared by many tasks. ``how`` is ``left``,
    ``inner``, ``left_semi`` or ``left_anti``; all are unaffected by the repetition.
    """
    keys = list(keys)
    if fits if fits is not None else fits_broadcast(small):
        return big.join(F.broadcast(small), keys, how)
    if not spread:
        return big.join(small, keys, how)
    dealt, repeated = deal_hot(big, small, keys, spread)
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")
