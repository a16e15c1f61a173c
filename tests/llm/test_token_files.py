import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from longform.llm import repair_files as files
from longform.llm.length_histogram import context_limits, length_histogram, quantiles, suffix_sums, token_lengths, totals, truncation_curve
from longform.llm.queries import tokenizer_file
from longform.llm.word_tokens import WordEncoder
from longform.sources.storage import scratch_path

PATH = tokenizer_file("word_bpe_49k.json")
ODD = ["", None, "it's 5% don't İSTANBUL ǅ é a b c ́x <|endoftext|> a<|startoftext|>b\x1c\x85 Σας ΑΣ \x0b\x0cq", "x" * 300, "  ", "ÀÉß ñandú, été. o'k a.b Ünï"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_encode_as_whole_texts(tokenizer, monkeypatch):
    want = [plain(tokenizer, t) for t in ODD]
    assert [x.tolist() for x in WordEncoder(PATH).encode_each(ODD)] == want
    from longform.llm import word_tokens

    monkeypatch.setattr(word_tokens, "CACHED_WORDS", 5)
    small = WordEncoder(PATH)
    assert [x.tolist() for t in ODD * 2 for x in small.encode_each([t])] == want * 2


@pytest.mark.parametrize("n, k", [(0, 5), (1, 5), (2, 1), (5000, 3), (20_000, 50), (3000, 1)])
def test_blocks_round_trip_with_random_access(n, k):
    rng = np.random.default_rng(n + k)
    ids = rng.integers(0, k, n).astype(np.uint32)
    block = files.Block(files.pack([1, 2], [n // 2, n], ids, 60))
    assert (block.read_ids(0, n) == ids).all()
    for _ in range(30):
        a, b = sorted(rng.integers(0, n + 1, 2))
        assert (block.read_ids(a, b) == ids[a:b]).all()
    if n >= 3000 and k <= 3:
        assert len(block.symbols) < n / 3


def pair_counts(symbols):
    keys = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
    return np.unique(keys, return_counts=True)[1] if len(keys) else np.zeros(0, int)


@pytest.mark.parametrize("kind", ["few ids", "copies", "near copies", "one id", "runs"])
def test_grammar_is_complete_and_each_rule_pays(kind):
    rng = np.random.default_rng(3)
    few = rng.integers(0, 40, 30_000)
    copies = np.tile(rng.integers(0, 40_000, 500), 200)
    changed = np.where(rng.random(len(copies)) < 0.005, rng.integers(0, 40_000, len(copies)), copies)
    runs = np.repeat(rng.integers(0, 5, 8_000), rng.integers(1, 9, 8_000))
    ids = {"few ids": few, "copies": copies, "near copies": changed, "one id": np.zeros(100_001), "runs": runs}[kind].astype(np.uint32)
    symbols, rules = files.compress(ids, 49408)
    assert (files.expand(symbols, rules, 49408) == ids).all()
    assert pair_counts(symbols).max(initial=0) < files.MIN_COUNT
    assert len(np.unique(rules, axis=0)) == len(rules) and (rules < 49408 + np.arange(len(rules))[:, None]).all()
    if kind == "copies":
        # a rule of twice the length would occur less often than the least count
        assert len(symbols) <= 40 and files.expansion_lengths(rules, 49408).max() > len(ids) / (2 * files.MIN_COUNT)


def test_first_nonterminal(spark, documents, tokenizer):
    assert files.encoder(PATH).n_ids == tokenizer.get_vocab_size()
    with pytest.raises(Exception, match="first nonterminal"):
        files.write_token_files(documents([(1, "hello world")]), scratch_path(spark, "test-tokens"), PATH, first=5)


def test_files(spark, documents, tokenizer):
    rows = [(5, "hello world"), (3, None), (9, "a b c " * 500), (4, ""), (5, "again the same id"), (None, "no id")] + [(100 + i, f"text number {i}, é") for i in range(50)]
    path = scratch_path(spark, "test-tokens")
    files.write_token_files(documents(rows), path, PATH, block_ids=300)
    got = [tuple(r) for r in files.read_documents(spark, path, with_ids=True).orderBy("start").collect()]
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = plain(tokenizer, t) + [1]
        want.append((i, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert got == want
    assert files.read_blocks(spark, path).count() > 1


def test_awkward_and_empty_files(spark, awkward, nothing):
    for docs in (awkward, nothing):
        path = scratch_path(spark, "test-tokens")
        files.write_token_files(docs, path, PATH)
        assert files.read_documents(spark, path).count() == docs.count()


def test_length_histogram_matches_brute_force(documents, tokenizer, monkeypatch):
    from longform.llm import length_histogram as module

    monkeypatch.setattr(module, "BAND", 4)
    rows = [(i, "word " * (i * i % 37)) for i in range(80)] + [(90, None), (91, "")]
    lengths = sorted(len(plain(tokenizer, t)) for _, t in rows)
    sums = suffix_sums(length_histogram(token_lengths(documents(rows), PATH))).cache()
    for r in truncation_curve(sums).collect():
        assert r.n_docs == lengths.count(r.length)
        assert r.docs_at_least == sum(x >= r.length for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= r.length)
        assert r.tokens_kept == sum(min(x, r.length) for x in lengths)
        assert r.tokens_lost == sum(lengths) - r.tokens_kept and r.docs_cut == sum(x > r.length for x in lengths)
    assert tuple(totals(sums).first()) == (len(lengths), sum(lengths))
    for r in context_limits(sums, [0, 1, 7, 20, 1000]).collect():
        assert (r.tokens_kept, r.docs_cut) == (sum(min(x, r.limit) for x in lengths), sum(x > r.limit for x in lengths))
    got = {r.share: r.length for r in quantiles(sums, [0.1, 0.5, 1.0]).collect()}
    assert got == {q: next(x for x in lengths if sum(y <= x for y in lengths) / len(lengths) >= q) for q in (0.1, 0.5, 1.0)}


def test_awkward_and_empty_histogram(awkward, nothing):
    sums = suffix_sums(length_histogram(token_lengths(awkward, PATH)))
    assert totals(sums).first()["all_docs"] == awkward.count()
    empty = suffix_sums(length_histogram(token_lengths(nothing, PATH)))
    assert empty.count() == 0 and tuple(totals(empty).first()) == (0, 0)
    assert [tuple(r) for r in context_limits(empty, [5]).collect()] == [(5, 0, 0, 0)]
