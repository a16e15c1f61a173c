"""Names within a few edits of each other, without comparing all with all.

A name of n letters has n + 1 pairs of neighbouring letters (its ends count), and an edit changes at most two of them. So
two names within ``distance`` edits share all but 2 * distance of the longer one's pairs. If each name's pairs are ordered by how
rare they are, the first 2 * distance + 1 of both must have one in common: names meet under these only, which are the rarest
they have. Names too short for that (with 2 * distance pairs at most) meet under what is left of them when up to
``distance`` letters are deleted. Whoever meets is held to the difference in length, then to the edit distance itself.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

PAIR = 2


def _pairs(name: Column) -> Column:
    """The pairs of letters, each with the number of its occurrence in the name."""
    padded = F.concat(F.lit("\x01"), name, F.lit("\x02"))
    each = F.transform(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.substring(padded, i, F.lit(PAIR)))
    return F.transform(each, lambda p, i: F.concat(p, F.size(F.filter(F.slice(each, 1, i + 1), lambda q: q == p)).cast("string")))


def _remains(name: Column, distance: int) -> Column:
    """What is left of a short name when up to ``distance`` letters go. Short names have 2 * distance - 1 letters at most."""
    longest = PAIR * distance - 1
    out = []
    for gone in range(distance + 1):
        for places in combinations(range(1, longest + 1), gone):
            kept = [F.substring(name, i, 1) for i in range(1, longest + 1) if i not in places]
            out.append(F.concat(F.lit("\x03"), *kept))
    return F.array_distinct(F.array(*out))


def _meeting_points(names: DataFrame, rarity: DataFrame, distance: int) -> DataFrame:
    """(name, token): the rarest pairs of each name, and what is left of short ones."""
    few = PAIR * distance
    ranked = Window.partitionBy("name").orderBy("n", "token")
    pairs = names.select("name", F.explode(_pairs(F.col("name"))).alias("token")).join(rarity, "token")
    rare = pairs.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= few + 1).select("name", "token")
    short = names.where(F.length("name") + 1 <= few)
    return rare.unionByName(short.select("name", F.explode(_remains(F.col("name"), distance)).alias("token")))


def near_names(left: DataFrame, right: DataFrame, distance: int = 2) -> DataFrame:
    """name, other and distance of all names of ``left`` and ``right`` (first columns) at most ``distance`` edits apart.

    Names are compared as they are; nulls are left out and repeated names count once.
    """
    sides = [df.select(F.col(df.columns[0]).alias("name")).where("name IS NOT NULL").distinct() for df in (left, right)]
    tokens = sides[0].unionByName(sides[1]).select(F.explode(_pairs(F.col("name"))).alias("token"))
    rarity = tokens.groupBy("token").agg(F.count("*").alias("n"))
    a, b = (_meeting_points(side, rarity, distance) for side in sides)
    b = b.withColumnRenamed("name", "other")
    met = a.join(b, "token").where(F.abs(F.length("name") - F.length("other")) <= distance).select("name", "other").distinct()
    return met.withColumn("distance", F.levenshtein("name", "other", distance)).where("distance >= 0")


def mapping_suggestions(cells: DataFrame, mapping: DataFrame, distance: int = 2, most: int = 3) -> DataFrame:
    """For attributes that the mapping lacks, the mapped names of their vendor that are spelled alike, best first.

    vendor_id, lab_provided_attribute, suggestion, canonical_column_id, distance and rank (up to ``most``). Both
    are compared in lower case, without blanks around them and with ``-``, ``.`` and blanks as underscores; ``#`` counts for nothing.
    """
    plain = lambda c: F.translate(F.trim(F.lower(c)), "-. #", "___")
    known = mapping.select("vendor_id", F.col("vendor_column_name").alias("suggestion"), "canonical_column_id", plain(F.col("vendor_column_name")).alias("other"))
    attributes = cells.select("vendor_id", "lab_provided_attribute").distinct()
    on = (attributes["vendor_id"] == known["vendor_id"]) & (attributes["lab_provided_attribute"] == known["suggestion"])
    lacking = attributes.join(known, on, "left_anti").withColumn("name", plain(F.col("lab_provided_attribute")))
    near = near_names(lacking.select("name"), known.select("other"), distance)
    found = lacking.join(near, "name").join(known, ["vendor_id", "other"])
    found = found.select("vendor_id", "lab_provided_attribute", "suggestion", "canonical_column_id", "distance").distinct()
    best = Window.partitionBy("vendor_id", "lab_provided_attribute").orderBy("distance", "suggestion", "canonical_column_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
