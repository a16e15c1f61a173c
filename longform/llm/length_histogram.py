"""Token counts by an exact histogram of encoded lengths.

Documents are encoded once and counted by length; everything else is read from that
table, whose size is the number of different lengths. Suffix sums over it (documents and
tokens at or above a length) give the totals, every quantile, and what any context limit
keeps: ``min(length, limit)`` summed over all documents is the tokens below the limit
plus the limit for each longer document.

The suffix sums take two levels (bands of lengths, then inside a band), so no task sees
more than one band or one row per band.

Null and empty texts have length 0 and count. Repeated rows count each. An empty table
gives an empty histogram and a report of zeros and nulls. Only ``text`` is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from longform.llm.shipping import ship
from longform.llm.word_tokens import encoder
from longform.llm.workers import enter

BAND = 1024


def token_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and n_tokens of every row."""

    def lengths(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("word_tokens", encoder(tokenizer).forget)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": encoder(tokenizer).count(batch["text"].tolist())})

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(lengths, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """length, n_docs; counts combine in each task before they are shuffled."""
    return lengths.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Adds docs_at_least and tokens_at_least: documents of this length or more, and their tokens."""
    rows = histogram.select("length", "n_docs", F.floor(F.col("length") / BAND).alias("_band"))
    sums = [F.sum("n_docs"), F.sum(F.col("n_docs") * F.col("length"))]
    bands = rows.groupBy("_band").agg(sums[0].alias("_docs"), sums[1].alias("_tokens"))
    above = Window.orderBy(F.col("_band").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select(
        "_band",
        F.coalesce(F.sum("_docs").over(above), F.lit(0)).alias("_docs_above"),
        F.coalesce(F.sum("_tokens").over(above), F.lit(0)).alias("_tokens_above"),
    )
    inside = Window.partitionBy("_band").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(bands, "_band").select(
        "length",
        "n_docs",
        (F.col("_docs_above") + sums[0].over(inside)).alias("docs_at_least"),
        (F.col("_tokens_above") + sums[1].over(inside)).alias("tokens_at_least"),
    )


def totals(sums: DataFrame) -> DataFrame:
    """One row: all documents and tokens."""
    return sums.agg(
        F.coalesce(F.max("docs_at_least"), F.lit(0)).alias("all_docs"), F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("all_tokens")
    )


def truncation_curve(sums: DataFrame) -> DataFrame:
    """For every length taken as a context limit: documents cut, tokens kept and lost, and the share of documents up to it."""
    longer_docs = F.col("docs_at_least") - F.col("n_docs")
    longer_tokens = F.col("tokens_at_least") - F.col("n_docs") * F.col("length")
    return sums.crossJoin(F.broadcast(totals(sums))).select(  # the totals are one row
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        longer_docs.alias("docs_cut"),
        (F.col("all_tokens") - longer_tokens + F.col("length") * longer_docs).alias("tokens_kept"),
        (longer_tokens - F.col("length") * longer_docs).alias("tokens_lost"),
        ((F.col("all_docs") - longer_docs) / F.col("all_docs")).alias("share_up_to"),
    )


def context_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """limit, docs_cut, tokens_kept, tokens_lost for any list of limits, whether such a length occurs or not."""
    wanted = sums.sparkSession.createDataFrame([(int(x),) for x in sorted(set(limits))], "limit long")
    below = F.filter(F.array(*[F.lit(int(x)).cast("long") for x in limits]), lambda x: x < F.col("length"))
    first = sums.select("*", F.explode(below).alias("limit")).groupBy("limit").agg(
        F.max("docs_at_least").alias("docs_cut"), F.max("tokens_at_least").alias("_tokens")
    )
    lost = F.coalesce(F.col("_tokens") - F.col("limit") * F.col("docs_cut"), F.lit(0))
    return (
        wanted.join(first, "limit", "left")
        .crossJoin(F.broadcast(totals(sums)))
        .select(
            "limit", F.coalesce("docs_cut", F.lit(0)).alias("docs_cut"), (F.col("all_tokens") - lost).alias("tokens_kept"), lost.alias("tokens_lost")
        )
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """share, length: the smallest length that at least this share of the documents does not exceed."""
    curve = truncation_curve(sums).select("length", "share_up_to")
    reached = F.filter(F.array(*[F.lit(float(x)) for x in shares]), lambda x: x <= F.col("share_up_to"))
    return curve.select("length", F.explode(reached).alias("share")).groupBy("share").agg(F.min("length").alias("length"))
