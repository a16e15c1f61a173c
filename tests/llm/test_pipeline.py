"""The stages on supplied tables and on awkward rows, and the operators' queries on the smallest tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from longform.llm import nbest
from longform.llm.queries import QUERIES, tokenizer_file

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no supplied tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.store(stage(spark, docs, SF), f"test-{name}")
        now = docs.count()
        assert docs.columns == columns and 0.7 * seen < now <= seen, name
        seen = now
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert not any(item in text for item in benchmark for text in kept.values())
    assert not any("@mail" in text for text in kept.values())
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert got.keys() == kept.keys() and all(r.round_trip for r in got.values())


def test_stages_on_awkward_rows(spark, awkward, nothing):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (awkward.select(*columns), nothing.select(*columns)):
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.store(stage(spark, docs, SF), f"awkward-{name}")


def test_encode_searches_alternatives(spark, documents):
    """The last stage gives four segmentations, of which the best is that of one alone."""
    docs = documents([(1, "unbelievable segmentation of words"), (2, "a"), (3, "the cat sat\non the mat"), (4, ""), (5, None)])
    name, encode = corpus_pipeline.STAGES[-1]
    rows = {r.doc_id: r for r in encode(spark, docs, SF).collect()}
    assert name == "encode" and len(rows) == 5
    assert [len(rows[i].nbest_scores) for i in (1, 3, 4, 5)] == [4, 4, 1, 1]
    alone = nbest.segmentations(docs, tokenizer_file("piece_bpe_32k.model"), n=1, with_ids=True).collect()
    assert {i: (r.ids, r.score, r.ids_crc32) for i, r in rows.items()} == {r.doc_id: (r.ids, r.score, r.ids_crc32) for r in alone}
    for row in rows.values():
        assert row.nbest_scores == sorted(row.nbest_scores, reverse=True) and len(set(row.nbest_crc32)) == len(row.nbest_crc32)


def test_registered():
    names = sorted(QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())


def test_the_rest_does_not_need_this_package():
    code = "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['longform.llm'] = None\nimport __spark_entry__ as e\nprint(len(e.queries()), len(e.oracle_sql()))"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert len(set(out.stdout.split())) == 1
