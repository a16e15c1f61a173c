"""Groups of spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

Words are runs of letters of whole texts, counted over all documents. Two are near if one code point inserted,
deleted or replaced turns one into the other. A replaced letter is one letter more and one fewer, an inserted one is one
more, so near words lie within an L1 distance of two in their letter counts, and of one if their lengths differ.

For each length a k-d tree cuts the words into cells of about ``CELL``. Its cuts are learned from ``SAMPLE`` words at most (those
with the smallest hashes, of up to ``LONGEST`` letters); they decide how even cells are, never what is found. Each word is stored in the cell
of its letter counts, and asks all cells of its own length and of the next whose box its budget reaches: near words of a
shorter length are found from the shorter side. A task gets one cell with the questions put to it, builds a k-d tree
of its words, searches, holds what is left against the letter counts' outlines, and verifies the order of the letters. A
cell or its questions above ``BLOCK`` (words longer than ``LONGEST``, or more words than the sample told) are cut into
blocks, each block of words meeting each block of questions. A task returns one row for each word, not its pairs.

A word's form is its near word of largest count (ties: the smallest), if that has at least ``FACTOR`` times the word's. Counts
grow along forms, so following them ends; pointers are doubled until all have reached their root.

Null and empty texts have no words. Rows without a doc_id take part (their checksum is that of an empty id). Repeated rows
count each. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from longform.llm.kd_tree import KdTree, outlines, vectors
from longform.llm.shipping import ship
from longform.llm.text import lower_ascii
from longform.llm.workers import enter
from longform.sources.storage import join_small, settle, store

RUN = r"[A-Za-zÀ-ÿ]++"
SHORTEST = 5
LEAST = 3
FACTOR = 2
SAMPLE = 65_536
LONGEST = 64
CELL = 8192
BLOCK = 4 * CELL
LEAF = 16
#: Bytes of words compared at a time.
COMPARED = 8_000_000
ROUTED = "length int, cell int, asks boolean, word string, n long"
NEAREST = "word string, n_near long, best_n long, best string"


def dented(doc_id: Column, word: Column) -> Column:
    """The lower-cased run, without the code point h % length where 97 divides h, the checksum of ``doc_id:word``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    without = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % 97 == 0, without).otherwise(word)


def vocabulary(docs: DataFrame, dent: bool = False, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word and n of the words with at least ``shortest`` letters that occur at least ``least`` times; ``dent`` deletes letters first."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= shortest)
    words = runs.select("doc_id", lower_ascii(F.col("run")).alias("word"))
    if dent:
        words = words.select(dented(F.col("doc_id"), F.col("word")).alias("word")).where(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# -- searches within tasks ------------------------------------------------------------


def _latin(words) -> list[bytes]:
    return [w.encode("latin-1") for w in words]


def _letters(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether taking one letter out of ``long`` gives ``short``: they agree up to some place, and shifted by one from there on."""
    differs, differs_shifted = short != long[:, :-1], short != long[:, 1:]
    n = short.shape[1]
    agree_until = np.where(differs.any(1), differs.argmax(1), n)
    agree_from = np.where(differs_shifted.any(1), n - differs_shifted[:, ::-1].argmax(1), 0)
    return agree_from <= agree_until


def range_search(tree: KdTree, stored: tuple, asking: tuple, up: int, down: int, verify) -> tuple[np.ndarray, np.ndarray]:
    """(asking, stored) pairs that are near. Both sides: letter counts, outlines, letters."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for leaf, rows in tree.reach(asking[0], up, down):
        cell = tree.cells[leaf]
        close = np.bitwise_count(asking[1][rows, 0][:, None] ^ stored[1][cell, 0][None, :]) <= up + down
        i, j = np.nonzero(close)
        i, j = rows[i], cell[j]
        close = np.bitwise_count(asking[1][i] ^ stored[1][j]).sum(1) <= up + down
        found.append((i[close], j[close]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = (np.concatenate(side) for side in zip(*found, strict=True))
    step = max(1, COMPARED // max(1, stored[2].shape[1]))
    good = [verify(asking[2][i[a : a + step]], stored[2][j[a : a + step]]) for a in range(0, len(i), step)]
    good = np.concatenate(good) if good else np.zeros(0, bool)
    return i[good], j[good]


def _side(words: list[bytes], length: int) -> tuple:
    counts = vectors(words)
    return counts, outlines(counts), _letters(words, length)


def _nearest(own: np.ndarray, other: np.ndarray, names: np.ndarray, n: np.ndarray):
    """For each different ``own``: how many ``other`` it has, and the one of largest n (ties: smallest name)."""
    order = np.lexsort((other, -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    return names[own[first]], np.diff(np.append(first, len(own))), n[other[first]], names[other[first]]


def search_cell(group):
    """One row for each word of a cell's group (``ROUTED``) that has near words in it."""
    import pandas as pd

    enter("spelling_variants")
    length = int(group["length"].iloc[0])
    asks, words, n = group["asks"].to_numpy(bool), group["word"].to_numpy(object), group["n"].to_numpy(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    # places by order of the names, so that ties can be told by place
    order = np.argsort(words, kind="stable")
    asks, words, n, sizes = asks[order], words[order], n[order], sizes[order]
    kept = np.flatnonzero(~asks)
    own, other = [], []
    if len(kept):
        stored = _side(_latin(words[kept]), length)
        tree = KdTree(stored[0], LEAF)
        for size, down, verify in ((length, 1, one_replaced), (length - 1, 0, one_inserted)):
            asking = np.flatnonzero(asks & (sizes == size))
            if len(asking):
                i, j = range_search(tree, stored, _side(_latin(words[asking]), size), 1, down, verify)
                own.append(asking[i])
                other.append(kept[j])
                if size < length:  # seen from the longer word too
                    own.append(kept[j])
                    other.append(asking[i])
    if not own or not sum(map(len, own)):
        return pd.DataFrame({"word": [], "n_near": [], "best_n": [], "best": []}).astype({"word": object, "n_near": np.int64, "best_n": np.int64, "best": object})
    named = _nearest(np.concatenate(own), np.concatenate(other), words, n)
    return pd.DataFrame(dict(zip(("word", "n_near", "best_n", "best"), named, strict=True)))


# -- cells ----------------------------------------------------------------------------


def cell_trees(words: DataFrame) -> dict[int, KdTree]:
    """For each length of up to ``LONGEST`` letters a tree whose leaves are cells of about ``CELL`` words."""
    short = words.where(F.length("word") <= LONGEST)
    sizes = {r["length"]: r["n"] for r in short.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    sample = short.orderBy(F.xxhash64("word"), "word").limit(SAMPLE).select("word").collect()
    by_length: dict[int, list[bytes]] = {}
    for r in sample:
        by_length.setdefault(len(r["word"]), []).append(r["word"].encode("latin-1"))
    trees = {}
    for length, seen in by_length.items():
        tree = KdTree(vectors(seen), max(LEAF, round(CELL * len(seen) / sizes[length])))
        tree.cells = [np.zeros(0, np.int64)] * len(tree.cells)  # only its cuts are needed
        trees[length] = tree
    return trees


def routed(words: DataFrame, trees: dict[int, KdTree]) -> DataFrame:
    """Each word where it is stored, and where it asks (``ROUTED``)."""
    spark = words.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(trees)  # at most SAMPLE / LEAF cuts

    def route(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("spelling_variants")
        for batch in batches:
            lengths = batch["word"].str.len().to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch[lengths == length]
                names, n = part["word"].to_numpy(object), part["n"].to_numpy()
                counts = vectors(_latin(names))
                for target, asks, up, down in ((length, False, 0, 0), (length, True, 1, 1), (length + 1, True, 1, 0)):
                    tree = shared.value.get(target)
                    reached = tree.reach(counts, up, down) if tree else [(0, np.arange(len(names)))]
                    for cell, rows in reached:
                        yield pd.DataFrame({"length": target, "cell": cell, "asks": asks, "word": names[rows], "n": n[rows]})

    def packed(batches: Iterator) -> Iterator:
        import pandas as pd

        held, size = [], 0
        for frame in route(batches):
            held.append(frame)
            size += len(frame)
            if size >= 50_000:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)

    return words.select("word", "n").mapInPandas(packed, ROUTED)


def nearest(words: DataFrame) -> DataFrame:
    """word, n_near, best_n and best (the near word of largest n) of the words that have near words."""
    at = store(routed(words, cell_trees(words)), "word-cells")
    blocks = lambda asks: F.greatest(F.lit(1), F.ceil(F.count_if(F.col("asks") == asks) / BLOCK)).cast("int")
    held = at.groupBy("length", "cell").agg(F.count_if(~F.col("asks")).alias("n_stored"), blocks(False).alias("of_words"), blocks(True).alias("of_questions"))
    sizes = settle(held.where("n_stored > 0").drop("n_stored"), "word-cell-sizes")
    dealt = join_small(at, sizes.df, ["length", "cell"], "inner", spread=["word"], fits=sizes.fits)
    mine = lambda of: F.pmod(F.xxhash64("word"), F.col(of)).cast("int")
    every = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    dealt = dealt.withColumn("i", F.explode(F.when(F.col("asks"), every("of_words")).otherwise(F.array(mine("of_words")))))
    dealt = dealt.withColumn("j", F.explode(F.when(F.col("asks"), F.array(mine("of_questions"))).otherwise(every("of_questions"))))
    found = dealt.select("length", "cell", "i", "j", "asks", "word", "n").groupBy("length", "cell", "i", "j").applyInPandas(search_cell, NEAREST)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.m")).alias("best_n"), "b.best")


def roots(forms: DataFrame) -> DataFrame:
    """word and root from (word, form): the last word that following forms leads to."""
    at = settle(forms.select("word", F.col("form").alias("root")), "roots", moved=F.count("*"))
    while at.metrics["moved"]:
        on = at.df.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = at.df.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moves"))
        at = settle(step, "roots", moved=F.count_if("moves"))
        at = type(at)(at.df.drop("moves"), at.fits, at.metrics)
    return at.df


def variant_groups(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of a vocabulary (word, n)."""
    words = store(words.select("word", "n"), "vocabulary")
    near = words.join(nearest(words), "word", "left")
    is_form = F.col("best_n") >= FACTOR * F.col("n")
    formed = near.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    formed = store(formed, "word-forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
