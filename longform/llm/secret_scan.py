"""Secret scans whose false positives a random forest removes.

Candidates are values of any length and characters that are assigned (by ``=`` or ``:``, quoted or not) to a name with a word such as ``token``,
what follows ``Bearer``, keys of known formats, and bare runs of at least ``SHORTEST`` key characters that hold a digit or stand in quotes after a name.
Where two overlap the earlier kind stays.
Each is described by its length, its characters and the changes between their classes, how likely its
letter pairs are in the corpus, how much of it dictionary words cover, the path of its
document, and the words beside it. ``train`` fits a forest on labelled findings, ``scan`` scores every
candidate of every text.

The corpus statistics are counted over all documents: letter pairs in a table of 28 x 28 classes, and the
dictionary, which holds the words that make up at least the share ``WORD_SHARE`` of all words, so at most
1 / WORD_SHARE of them. Both are small by construction and go to all tasks.

``weak_labels`` labels findings where nobody has, by evidence that is no feature: the name a value is assigned to, ``Bearer``, the fixed
prefix of a key format; against it a word such as ``sha1`` as that name or right before the value, the form of a UUID, digits alone. Where neither or both
speak the label is null. The neighbouring words among the features leave that name and that word out. Only the given rows
are labelled, and at most ``SAMPLE`` findings (smallest hashes) are learned from.

Null and empty texts have no candidates; a null path is empty. Repeated rows repeat their findings. Empty
tables, and labels of one class alone, give a score of 0 or of that class for all.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from longform.llm.shipping import ship
from longform.llm.workers import enter
from longform.sources.storage import scratch_path, store

SHORTEST = 16
WORD_SHARE = 1e-4
SAMPLE = 20_000
TREES = 30
DEPTH = 6
#: Share of the features that a node of a tree chooses from.
CHOICE = "0.5"
#: Words that go with secrets and words that go with other long values.
SECRET_WORDS = ("access", "api", "apikey", "auth", "bearer", "credential", "key", "passwd", "password", "private", "pw", "pwd", "secret", "token")
OTHER_WORDS = ("card", "checksum", "commit", "digest", "hash", "isbn", "md5", "phone", "sha", "sha1", "sha256", "uuid")
SAFE_PATHS = ("doc", "example", "fixture", "lock", "mock", "sample", "spec", "test")
#: Prefixes of public key formats, and what follows them.
FORMATS = {"AKIA": r"[0-9A-Z]{16}", "ghp_": r"[A-Za-z0-9]{36}", "glpat-": r"[A-Za-z0-9_-]{20}", "xoxb-": r"[0-9A-Za-z-]{20,}", "AIza": r"[0-9A-Za-z_-]{35}"}
BARE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST)
VALUE = re.compile(r"[=:]\s*(?:\"([^\"\n]+)\"|'([^'\n]+)'|([^\s\"',;]+))")
NAME = re.compile(r"([A-Za-z0-9_-]+)[\"']?\s*$")
ASSIGNED = re.compile(r"([A-Za-z0-9_-]+)[\"']?\s*[=:]\s*[\"']?$")
BEARER = re.compile(r"(?<![A-Za-z])[Bb]earer\s+([A-Za-z0-9._~+/=-]+)")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
LAST_WORD = re.compile(r"([A-Za-z0-9_-]+)[^A-Za-z0-9_]*$")
FEATURES = (
    "length", "digits", "upper", "lower", "marks", "distinct", "entropy", "changes", "transitions", "covered",
    "secret_word", "other_word", "quoted", "safe_path", "path_depth",
)
SCHEMA = "doc_id long, start long, stop long, name string, kind string, assigned_to string, beside string, features array<double>"
PAIRS = 28


def _letter(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else (27 if c.isdigit() else 0)


def letter_pairs(docs: DataFrame) -> list[float]:
    """Log-probability of each class of letter after another, over all documents; counts are summed per batch and task."""
    ship(docs.sparkSession)

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        to = np.zeros(256, np.int64)
        to[97:123] = to[65:91] = np.arange(1, 27)
        to[48:58] = 27
        total = np.zeros(PAIRS * PAIRS, np.int64)
        for batch in batches:
            for text in batch["text"]:
                if text:
                    codes = to[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
                    total += np.bincount(codes[:-1] * PAIRS + codes[1:], minlength=PAIRS * PAIRS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at, "n": total[at]})

    counts = docs.select("text").mapInPandas(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = {r["pair"]: r["n"] for r in counts.collect()}  # PAIRS * PAIRS rows at most
    out = []
    for a in range(PAIRS):
        total = sum(found.get(a * PAIRS + b, 0) for b in range(PAIRS)) + PAIRS
        out += [math.log((found.get(a * PAIRS + b, 0) + 1) / total) for b in range(PAIRS)]
    return out


def dictionary(docs: DataFrame, share: float = WORD_SHARE) -> list[str]:
    """Words of three to twelve letters, in lower case, that make up at least ``share`` of all such words."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?<![a-z])[a-z]{3,12}+(?![a-z])"), F.lit(0))).alias("word"))
    counts = store(words.groupBy("word").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return sorted(r["word"] for r in counts.where(F.col("n") >= share * total).select("word").collect())  # 1 / share rows at most


def means_secret(name: str | None) -> bool:
    """Whether a word of the name, which case and marks part, goes with secrets."""
    words = [w.lower() for w in NAME_WORDS.findall(name or "")]
    return any(w in SECRET_WORDS or w.removesuffix("s") in SECRET_WORDS for w in words)


def candidates(text: str) -> list[tuple[int, int, str, str | None]]:
    """(start, stop, kind, name assigned to) of all candidates of a text, in their order; none overlap."""
    found = []
    if "=" in text or ":" in text:
        at, m = 0, VALUE.search(text)
        while m:
            name = NAME.search(text[max(0, m.start() - 80) : m.start()])
            at = m.start() + 1
            if name and means_secret(name[1]):
                k = m.lastindex
                stop = m.end(k) if k < 3 else m.start(3) + len(m[3].rstrip(".:!?)]}>"))
                if stop > m.start(k):
                    found.append((m.start(k), stop, "assigned", name[1]))
                    at = stop
            m = VALUE.search(text, at)
    if "earer" in text:
        found += [(m.start(1), m.end(1), "bearer", None) for m in BEARER.finditer(text)]
    for prefix, rest in FORMATS.items():
        if prefix in text:
            found += [(m.start(), m.end(), "format", None) for m in re.finditer(rf"(?<![A-Za-z0-9]){prefix}{rest}(?![A-Za-z0-9])", text)]
    for m in BARE.finditer(text):
        name = ASSIGNED.search(text, max(0, m.start() - 80), m.start())
        if any(c.isdigit() for c in m[0]) or (name and text[m.start() - 1] in "\"'"):
            found.append((m.start(), m.end(), "bare", name[1] if name else None))
    out, taken = [], []
    for start, stop, kind, name in found:  # earlier kinds first
        at = bisect_left(taken, (start, stop))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= stop):
            taken.insert(at, (start, stop))
            out.append((start, stop, kind, name))
    return sorted(out)


def features_of(value: str, before: str, after: str, path: str, pairs: list[float], words: set[str]) -> list[float]:
    n, low = len(value), value.lower()
    counts = [value.count(c) / n for c in set(value)]
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in value]
    codes = [_letter(c) for c in low]
    likely = sum(pairs[a * PAIRS + b] for a, b in zip(codes, codes[1:])) / max(n - 1, 1)
    covered = at = 0
    while at < n:  # the longest dictionary word at each place
        size = next((k for k in range(min(12, n - at), 2, -1) if low[at : at + k] in words), 0)
        covered += size
        at += size or 1
    beside = LAST_WORD.search(before[-60:])
    near = re.findall(r"[a-z0-9]+", (before[-60:][: beside.start() if beside else 0] + " " + after[:30]).lower())
    return [
        n, kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, kinds.count("m") / n, len(counts) / n,
        -sum(p * math.log2(p) for p in counts), sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1), likely, covered / n,
        float(any(w in SECRET_WORDS for w in near)), float(any(w in OTHER_WORDS for w in near)),
        float(before[-1:] in "\"'" and bool(before) and after[:1] in "\"'" and bool(after)),
        float(any(s in path.lower() for s in SAFE_PATHS)), float(path.count("/")),
    ]


def findings(docs: DataFrame, pairs: list[float], words: list[str], path: str | None = "source") -> DataFrame:
    """Every candidate with its place (code points), kind, the name it is assigned to and the word before it (if any), and its features."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((pairs, frozenset(words)))

    def find(batches: Iterator) -> Iterator:
        import pandas as pd

        enter("secret_scan")
        pair, word = shared.value
        for batch in batches:
            rows = []
            for doc_id, text, where in zip(batch["doc_id"], batch["text"], batch["path"], strict=True):
                text = text or ""
                for start, stop, kind, name in candidates(text):
                    value, before, after = text[start:stop], text[max(0, start - 80) : start], text[stop : stop + 40]
                    beside = LAST_WORD.search(before)
                    described = features_of(value, before, after, where or "", pair, word)
                    rows.append((doc_id, start, stop, value, kind, name, beside[1] if beside else None, [float(x) for x in described]))
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "stop", "name", "kind", "assigned_to", "beside", "features"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    where = F.col(path).cast("string") if path and path in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", where.alias("path")).mapInPandas(find, SCHEMA)


def weak_labels(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1 or 0 where evidence that is no feature speaks for or against a secret, else null."""
    other = lambda c: F.lower(F.coalesce(c, F.lit(""))).rlike(f"(?:^|[_-])(?:{'|'.join(OTHER_WORDS)})$")
    digits, letters = F.col("name").rlike("^[0-9]+$"), F.col("name").rlike(r"^\p{L}+$")
    uuid = F.col("name").rlike("^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")
    speaks = (F.col("kind") == "format") | (F.col("kind").isin("assigned", "bearer") & ~letters)
    against = other(F.col("assigned_to")) | other(F.col("beside")) | uuid | (digits & (F.length("name") >= SHORTEST - 3))
    return found.withColumn("label", F.when(speaks & ~against, 1.0).when(against & ~speaks, 0.0))


def train(labelled: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | float:
    """A forest on ``features`` and ``label``, from at most ``sample`` findings; a number where there is one class or none."""
    bounded = labelled.where("label IS NOT NULL").orderBy(F.xxhash64("doc_id", "start", "name"), "doc_id", "start").limit(sample)
    bounded = store(bounded.select("features", "label"), "labelled-findings")
    classes = [r["label"] for r in bounded.select("label").distinct().collect()]
    if len(classes) < 2:
        return float(classes[0]) if classes else 0.0
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy=CHOICE, seed=7, featuresCol="vector", labelCol="label")
    fitted = forest.fit(bounded.select(array_to_vector("features").alias("vector"), "label"))
    # a fitted model holds its training summary, and with it the session; a loaded one can be sent to tasks
    path = scratch_path(labelled.sparkSession, "forest")
    fitted.save(path)
    return RandomForestClassificationModel.load(path)


def scan(found: DataFrame, model: RandomForestClassificationModel | float, least: float = 0.5) -> DataFrame:
    """The findings with ``score`` (probability of a secret) and ``secret``."""
    if isinstance(model, float):
        scored = found.withColumn("score", F.lit(model))
    else:
        scored = model.transform(found.withColumn("vector", array_to_vector("features")))
        scored = scored.withColumn("score", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")
    return scored.withColumn("secret", F.col("score") >= least)
