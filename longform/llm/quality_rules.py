"""Quality rules as a bitmask ledger, in built-in functions only.

``rule_ledger`` evaluates every rule once per document and stores the measurements and
one bit per failed rule. ``apply_policy`` decides by a bitwise AND with the mask of a
policy version, so a new policy reads the ledger and no text. ``ablations`` counts what
each rule removes, and what it alone removes, from one aggregate over the distinct masks.

Nothing is shuffled but the ledger's masks, which combine before they leave a task; a
document's n-grams are counted inside its own row.

Null, empty and blank texts measure 0 everywhere and fail ``few_words``. Repeated rows
give one ledger row each; an empty table gives an empty ledger. Only ``doc_id`` and
``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from longform.llm.text import WORD, words_of

#: Rules by bit. Each is (name, failure test over the measurements).
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 10 * word_chars"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("long_words", "word_chars > 20 * n_words"),
    ("shouting", "100 * n_upper > 60 * word_chars"),
    ("short_words", "word_chars < 2 * n_words"),
)
BASE = ("few_words", "repeated_words")
#: Policy versions: the rules that remove a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "duplicate_lines"),
    "v3": (*BASE, "symbols", "duplicate_lines", "long_words", "shouting", "short_words"),
}
CURRENT = "v3"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


def mask_of(names: tuple[str, ...]) -> int:
    order = [name for name, _ in RULES]
    return sum(1 << order.index(name) for name in names)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and every measurement, each computed once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("_text"), words_of(text).alias("_words"))
    grams = F.when(
        F.size("_words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("_words") - 3),
            lambda i: F.xxhash64(F.col("_words")[i], F.col("_words")[i + 1], F.col("_words")[i + 2]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))
    base = base.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count(F.col("_text"), "[#*$%&|<>]").alias("n_symbols"),
        _count(F.col("_text"), r"\p{Lu}").alias("n_upper"),
        lines.alias("_lines"),
        grams.alias("_grams"),
    )
    # only documents in which some gram occurs twice sort their grams
    ordered = F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))),
    )
    base = base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_upper",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        ordered.alias("_ordered"),
    )
    gram, last = F.col("_ordered"), F.size("_ordered") - 1
    twice = F.filter(
        "_ordered",
        lambda x, k: ((k > 0) & (gram[F.greatest(k - 1, F.lit(0))].gram == x.gram))
        | ((k < last) & (gram[F.least(k + 1, last)].gram == x.gram)),
    )
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2))))
    repeats = F.when(F.col("_ordered").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")
    return base.withColumn("n_repeat_words", repeats).select("doc_id", *MEASURES)


def rule_ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed`` (bit k set: rule k of ``RULES`` fails)."""
    bits = [F.when(F.expr(test), F.lit(1 << k)).otherwise(F.lit(0)) for k, (_, test) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed", failed.cast("int"))


def apply_policy(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy version (which includes the base rules)."""
    hit = lambda names: F.col("failed").bitwiseAND(F.lit(mask_of(names))) != 0
    return ledger.withColumn("base_failed", hit(BASE)).withColumn("kept", ~hit(BASE) & ~hit(POLICIES[version]))


def ablations(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    Documents are first counted by their mask: at most one row per mask and task is shuffled.
    """
    mask = mask_of(POLICIES[version])
    order = [name for name, _ in RULES]
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << order.index(n)).alias("bit")) for n in POLICIES[version]])
    counts = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("hit")).agg(F.count("*").alias("n"))
    each = counts.select("hit", "n", F.explode(rules).alias("r"))
    alone = F.col("hit") == F.col("r.bit")
    without = F.col("hit").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("hit").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(without, F.col("n")).otherwise(0)).alias("n_kept_without"),
        F.sum("n").alias("n_docs"),
    )
