"""A corpus pipeline over the table ``documents``: five stages, each one operator of ``longform.llm``.

quality          byte-level convolutional classifier, trained on ``labels.quality``; documents it rejects go
near_duplicates  MinHash with Bayesian verification (five words, similarity of 0.8 or more); one document of each group stays
decontaminate    documents that hold an item of ``benchmark``, verbatim or re-parameterised, go
pii              personal data and the terms that disclose it are masked in ``text``
encode           the four best segmentations into pieces of a SentencePiece vocabulary, with the ids of the best

Each stage works on all that its predecessor kept. All but the last return the columns of ``documents``.
SQL can express neither the network nor the segmentation, so there is no SQL for the whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from longform.catalog.registry import table
from longform.llm import byte_cnn, decontamination, near_dedup, nbest, pii
from longform.llm.queries import tokenizer_file
from longform.sources.storage import store

ORACLE_SQL: str | None = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_cnn.keep_good(docs, byte_cnn.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nbest.segmentations(docs, tokenizer_file("piece_bpe_32k.model"), n=4, with_ids=True)


#: Stages in order: name, function(spark, docs, sf_dir) -> DataFrame.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", mask_pii),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to the table ``documents``; each result is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
