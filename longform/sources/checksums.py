"""Sizes and checksums of files, formed split by split.

A file's checksum is a polynomial over its lines: the sum of h(line j) * BASE**j modulo PRIME, for two hashes h and
two bases (62 bits in all), with j from 0. A split knows its lines' places only up to a shift, so it sums with the places
it has, and the sum is multiplied by the power of the shift once the splits before it are counted. That is associative: any
cut of a file into splits gives what one pass over it would, no task needs a whole file, and one small row per split is
all that is shuffled. Two lines exchanged, a byte changed, a line more or less change the checksum; so does a missing last line break,
which the file's size tells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from longform.functions.names import logical_file_name
from longform.sources.storage import pin_splits

#: A Mersenne prime, and a generator of large order for each half of the checksum.
PRIME = 2**31 - 1
BASES = (48_271, 69_621)
_LOW, _MID = 1 << 11, 1 << 10


def _powers(base: int, step: int, n: int) -> Column:
    factor, out = pow(base, step, PRIME), [1]
    while len(out) < n:
        out.append(out[-1] * factor % PRIME)
    return F.from_json(F.lit(str(out)), "array<bigint>")  # one constant for the planner, not thousands


def power(base: int, exponent: Column) -> Column:
    """base ** exponent modulo PRIME for any long, negative ones too: three table look-ups and two products."""
    e = F.pmod(exponent, F.lit(PRIME - 1)).cast("long")
    low = F.get(_powers(base, 1, _LOW), (e % _LOW).cast("int"))
    mid = F.get(_powers(base, _LOW, _MID), (F.floor(e / _LOW) % _MID).cast("int"))
    high = F.get(_powers(base, _LOW * _MID, _MID), F.floor(e / (_LOW * _MID)).cast("int"))
    return low * mid % PRIME * high % PRIME


def line_hash(value: Column, half: int) -> Column:
    """Seven hex digits of the line's MD5 as a number, the first or the second seven."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1 + 7 * half, 7), 16, 10).cast("long")


def file_checksums(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """file_id, file_name, file_size, line_count, ends_in_break and checksum (16 hex digits) of every file that has a byte.

    Lines end at a line feed; what stands before it (a carriage return too) belongs to the line. A byte-order mark at the start
    of a file counts in its size alone.
    """
    pin_splits(spark)
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    value = F.col("value")
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file_id"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("part"),
        "value",
        F.monotonically_increasing_id().alias("id"),
    )
    place = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))  # the place within the task, up to a shift that within the split
    term = lambda half: line_hash(value, half) * power(BASES[half], place) % PRIME
    splits = lines.groupBy("file_id", "file_size", "part").agg(
        F.count("*").alias("n"),
        F.min(place).alias("first"),
        F.sum(F.octet_length(value) + 1).alias("bytes"),
        *[(F.sum(term(k)) % PRIME).alias(f"sum_{k}") for k in (0, 1)],
    )
    before = Window.partitionBy("file_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    placed = splits.withColumn("shift", shift).select(
        "file_id", "file_size", "n", "bytes", *[(F.col(f"sum_{k}") * power(BASES[k], F.col("shift")) % PRIME).alias(f"sum_{k}") for k in (0, 1)]
    )
    files = placed.groupBy("file_id", "file_size").agg(
        F.sum("n").alias("line_count"), F.sum("bytes").alias("bytes"), *[(F.sum(f"sum_{k}") % PRIME).alias(f"sum_{k}") for k in (0, 1)]
    )
    # without a last line break the lines account for one byte more than there is; a byte-order mark hides three
    ends = F.pmod(F.col("file_size") - F.col("bytes"), F.lit(3)) == 0
    return files.select(
        "file_id",
        logical_file_name(F.col("file_id")).alias("file_name"),
        "file_size",
        "line_count",
        ends.alias("ends_in_break"),
        F.lower(F.concat(*[F.lpad(F.hex(f"sum_{k}"), 8, "0") for k in (0, 1)])).alias("checksum"),
    )
