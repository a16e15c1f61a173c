"""Removal of long repeated byte strings by prefix-free parsing.

Every byte covered by a ``LENGTH``-byte string that also starts earlier in the corpus (a smaller
doc_id, or an earlier start in the same document) goes. Texts are UTF-8 bytes and matches never
cross documents.

1. Parse. A rolling hash marks triggers: of the positions at the head of a window of ``LENGTH``
   bytes the one with the smallest hash. The trigger depends on the window's bytes alone, so equal
   windows have the same trigger at the same place in them. Consecutive windows with one
   trigger form a phrase; the corpus is a sequence of phrases, and equal stretches of
   text are parsed alike wherever they stand.
2. Dictionary. Phrases are named by hash. All windows of a trigger share the bytes that
   follow it; a phrase whose shared bytes occur nowhere else has no repeated window and leaves at once,
   which leaves unique text out of all further work.
3. Repeated entries. A phrase that occurs again is removed wherever it is not the first, without looking
   into it: repetitive text costs its dictionary, not its length.
4. Corpus order. Only suffixes of different entries with the same shared bytes are brought
   together: first by quarters of a phrase, whose windows share 85 bytes, then each window of the first
   occurrences that still have company, named by entry suffix and what follows it. For
   equality to ``LENGTH`` bytes the order inside the names does not matter, so ranks are 64-bit hashes
   within one shared string (64 more bits) rather than lexicographic ranks, and groups of
   equal suffixes are combined in tasks before they are shuffled: no suffix, however frequent,
   meets in one task.

Copies of whole texts are set aside first, by digest. Rows that repeat both doc_id and text are one
document and get equal results; different texts under one doc_id follow each other in order of their
digests. Rows without a doc_id come last, in order of digest. Null texts are empty. Texts shorter than
``LENGTH`` keep all bytes. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window, functions as F

from longform.llm.shipping import ship
from longform.llm.workers import enter
from longform.sources.storage import join_small, settle, store

LAST = 2**63 - 1
LENGTH = 100


def _named(docs: DataFrame) -> DataFrame:
    """doc (its place in order), doc_id, text and name (digest) of every row."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(LAST)).alias("doc"), doc_id.alias("doc_id"), text.alias("text"), F.md5(text.cast("binary")).alias("name"))


def ordered_texts(docs: DataFrame) -> DataFrame:
    """Rows with ``version`` (place among the texts of one doc) and ``copy`` (the text stands in an earlier document)."""
    rows = _named(docs)
    texts = rows.groupBy("name").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    again = settle(texts.where("n > 1").select("name", "first"), "copied-texts")
    rows = join_small(rows, again.df, ["name"], "left", spread=["doc"], fits=again.fits)
    several = rows.groupBy("doc").agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a < b").select("doc")
    several = settle(several, "repeated-ids", n=F.count("*"))
    copy = F.col("first").isNotNull() & (F.col("first") < F.col("doc"))
    if not several.metrics["n"]:
        return rows.select("doc", "doc_id", "text", "name", F.lit(0).cast("long").alias("version"), copy.alias("copy"))
    names = rows.select("doc", "name").join(several.df, "doc").distinct()
    place = F.row_number().over(Window.partitionBy("doc").orderBy("name")) - 1
    versions = settle(names.select("doc", "name", place.cast("long").alias("version")), "versions")
    rows = join_small(rows, versions.df, ["doc", "name"], "left", fits=versions.fits)
    return rows.select("doc", "doc_id", "text", "name", F.coalesce("version", F.lit(0)).cast("long").alias("version"), copy.alias("copy"))


def phrase_table(texts: DataFrame) -> DataFrame:
    """key, unit, doc and ``spot`` (version, trigger and run of starts, packed in order) of every phrase."""
    ship(texts.sparkSession)

    def parse(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        from longform.llm.phrases import phrases
        from longform.llm.wordhash import utf8

        enter("substring_dedup")
        for batch in batches:
            held, size = [], 0
            for doc, version, text in zip(batch["doc"], batch["version"], batch["text"], strict=True):
                key, unit, at, first, last = phrases(utf8(text))
                spot = (((np.int64(version) << 32) + at) << 12) + ((at - first) << 6) + (last - first)
                held.append((key, unit, np.full(len(at), doc, np.int64), spot))
                size += len(at)
                if size > 200_000:
                    yield pd.DataFrame(dict(zip(("key", "unit", "doc", "spot"), map(np.concatenate, zip(*held, strict=True)), strict=True)))
                    held, size = [], 0
            if held:
                yield pd.DataFrame(dict(zip(("key", "unit", "doc", "spot"), map(np.concatenate, zip(*held, strict=True)), strict=True)))

    return texts.select("doc", "version", "text").mapInPandas(parse, "key long, unit long, doc long, spot long")


def _unpacked(rows: DataFrame) -> DataFrame:
    """version, trigger, first and last start of the phrases."""
    at = F.shiftright("spot", 12).bitwiseAND(F.lit(2**32 - 1))
    first = at - F.shiftright("spot", 6).bitwiseAND(F.lit(63))
    last = first + F.col("spot").bitwiseAND(F.lit(63))
    return rows.select("*", F.shiftright("spot", 44).alias("version"), at.alias("trigger"), first.alias("first"), last.alias("last"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """doc, version, start, stop of every repeated stretch of the given (different) texts; stretches may overlap."""
    shared = phrase_table(texts).groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = settle(shared, "shared-strings")
    rows = store(join_small(phrase_table(texts), shared.df, ["key"], "left_semi", spread=["doc", "spot"], fits=shared.fits), "phrases")

    entries = rows.groupBy("key", "unit").agg(F.min(F.struct("doc", "spot")).alias("one"), F.count("*").alias("n"))
    entries = store(entries.select("key", "unit", F.col("one.doc").alias("doc"), F.col("one.spot").alias("spot"), "n"), "dictionary")
    known = entries.where("n > 1").select("key", "unit", F.col("doc").alias("doc_1"), F.col("spot").alias("spot_1"))
    later = rows.join(known, ["key", "unit"]).where("doc <> doc_1 OR spot <> spot_1")
    whole = _unpacked(later).select("doc", "version", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop"))

    several = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    open_ = _unpacked(entries.drop("n").join(several, "key")).select("doc", "version", "first", "last", F.col("trigger").alias("tag"))
    # twice the open phrases are read in their texts: by the quarter, where 85 of 100 bytes are shared, then by the window
    parts = store(_in_texts(texts, open_, quarters=True), "quarters")
    met = parts.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    left = parts.join(met, "name").select("doc", "version", "first", "last", F.col("name").alias("tag"))
    each = store(_in_texts(texts, left, quarters=False), "suffixes").withColumnsRenamed({"first": "start", "tag": "shared"})
    equal = each.groupBy("shared", "name").agg(F.min(F.struct("doc", "version", "start")).alias("one"), F.count("*").alias("n")).where("n > 1")
    again = each.join(equal.select("shared", "name", "one"), ["shared", "name"]).where(F.struct("doc", "version", "start") > F.col("one"))
    return whole.unionByName(again.select("doc", "version", "start", (F.col("start") + LENGTH).alias("stop")))


def _in_texts(texts: DataFrame, runs: DataFrame, quarters: bool) -> DataFrame:
    """Reads runs of starts (doc, version, first, last, tag) in their texts.

    Gives their quarters (tag is the trigger; first, last and a name by what is shared), or their windows
    (first is the start; tag is passed on).
    """
    by_text = runs.groupBy("doc", "version").agg(F.collect_list(F.struct("first", "last", "tag")).alias("runs"))
    by_text = settle(by_text, "open-phrases")
    held = join_small(texts.select("doc", "version", "text"), by_text.df, ["doc", "version"], "inner", fits=by_text.fits)

    other = "last" if quarters else "tag"

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        from longform.llm import phrases
        from longform.llm.wordhash import utf8

        def frame(rows):
            return pd.DataFrame(dict(zip(("doc", "version", "first", other, "name"), map(np.concatenate, zip(*rows, strict=True)), strict=True)))

        for batch in batches:
            rows, held = [], 0
            for doc, version, text, found in zip(batch["doc"], batch["version"], batch["text"], batch["runs"], strict=True):
                first, last, tag = (np.array([r[c] for r in found], np.int64) for c in ("first", "last", "tag"))
                if quarters:
                    each = ((begin, end, name) for _, begin, end, name in phrases.quarters(utf8(text), tag, first, last))
                else:
                    each = ((start, tag[run], name) for run, start, name in phrases.window_hashes(utf8(text), first, last))
                for begin, more, name in each:
                    rows.append((np.full(len(begin), doc), np.full(len(begin), version), begin, more, name))
                    held += len(begin)
                if held > 200_000:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)

    return held.mapInPandas(read, f"doc long, version long, first long, {other} long, name long")


def removed_spans(texts: DataFrame) -> DataFrame:
    """doc, version and ``spans``: the maximal removed stretches of each text that has any, in order."""
    found = repeated_spans(texts)
    up = Window.partitionBy("doc", "version").orderBy("start", "stop")
    before = F.max("stop").over(up.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.when(F.coalesce(before, F.lit(-1)) < F.col("start"), 1).otherwise(0))
    marked = marked.withColumn("run", F.sum("new").over(up.rowsBetween(Window.unboundedPreceding, 0)))
    merged = marked.groupBy("doc", "version", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return merged.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and ``kept`` (the remaining bytes) of every row."""
    rows = ordered_texts(docs)
    texts = rows.where(~F.col("copy"))
    spans = settle(removed_spans(texts), "removed")
    marked = join_small(rows, spans.df, ["doc", "version"], "left", fits=spans.fits)

    def cut(batches: Iterator) -> Iterator:
        import pandas as pd

        from longform.llm.wordhash import utf8

        for batch in batches:
            out = []
            for doc_id, text, copy, found in zip(batch["doc_id"], batch["text"], batch["copy"], batch["spans"], strict=True):
                data = utf8(text)
                gone = [(int(s["start"]), int(s["stop"])) for s in found] if found is not None and not copy else []
                if copy and len(data) >= LENGTH:
                    gone = [(0, len(data))]
                last, parts = 0, []
                for a, b in gone:
                    parts.append(data[last:a])
                    last = b
                kept = b"".join([*parts, data[last:]])
                out.append((doc_id, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return marked.select("doc_id", "text", "copy", "spans").mapInPandas(cut, schema)
