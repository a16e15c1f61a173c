"""The registered queries: thin, over the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from longform.catalog.registry import table
from longform.llm import byte_cnn, conversation_repair, decontamination, length_histogram, near_dedup, nbest, pii, quality_rules as rules, repair_files, secret_scan, simhash, spelling_variants, substring_dedup
from longform.llm.registry import ORACLE, QUERIES, query
from longform.sources.storage import scratch_path, store

__all__ = ["ORACLE", "QUERIES"]


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file, the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)

SPACE_SQL = r"[^\x20\x09-\x0D]"

QUALITY_RULES_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACE_SQL}+') AS ws FROM documents
), grams AS (
  SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS place FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{SPACE_SQL}')) AS ls FROM w
), m AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * coalesce(word_chars, 0)
    OR 100 * n_dup_lines > 30 * n_lines OR coalesce(word_chars, 0) > 20 * n_words
    OR 100 * n_upper > 60 * coalesce(word_chars, 0) OR coalesce(word_chars, 0) < 2 * n_words) AS kept
FROM m
"""


@query("op10_quality_rules", QUALITY_RULES_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = rules.rule_ledger(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rules.apply_policy(ledger).select(*columns)


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = length_histogram.token_lengths(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    # the histogram is written, as several passes read it and none should encode again
    histogram = store(length_histogram.length_histogram(lengths), "lengths")
    return length_histogram.truncation_curve(length_histogram.suffix_sums(histogram))


@query("op9_token_files")
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    repair_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return repair_files.read_documents(spark, path)


@query("op1_near_duplicates")
def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = byte_cnn.score(docs, byte_cnn.train(docs, table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scores.select("doc_id", byte_cnn.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


@query("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select(
        "doc_id",
        *[count(k) for k in range(4)],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.concat("base", "terms")).alias("spans"),
    )


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_nbest_segmentation")
def op7_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.segmentations(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), n=4)


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op3_secret_scan")
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.findings(docs, secret_scan.letter_pairs(docs), secret_scan.dictionary(docs))
    found = secret_scan.weak_labels(store(found, "findings"))
    held_out = byte_cnn.held_out(F.col("doc_id"))
    scored = secret_scan.scan(found, secret_scan.train(found.where(~held_out)))
    return scored.select("doc_id", "start", "stop", held_out.alias("held_out"), F.col("label").cast("int").alias("label"), "score", "secret")


@query("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversations, conversation_repair.damage(conversations))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variant_groups(spelling_variants.vocabulary(table(spark, sf_dir, "documents"), dent=True))
