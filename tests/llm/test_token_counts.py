"""Token counts against the library's unigram model with the same pieces."""

import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from logrisk.llm import token_counts as tc


def library(pieces, byte_fallback=True):
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def pieces():
    return tc.read_pieces()


TEXTS = [" ", "  a  b ", "a\nb\n\nc", "▁▁x", "漢字 漢\U0001f600\U0001f600é\x00", "<s> <0x41> <unk>", "\n", "\r\n x\n ", "a" * 5000]


def test_edge_texts(pieces):
    counter, expected = tc.UnigramCounter(pieces), library(pieces)
    assert counter.count(None) == counter.count("") == 0
    for text in TEXTS:
        assert counter.count(text) == expected(text), text


def test_ties_and_unknown_runs():
    rng = random.Random(8)
    for fallback in (False, True):
        for _ in range(60):
            pieces = [("<unk>", 0.0), ("▁", -2.0)]
            names = {"".join(rng.choice("abc\n") for _ in range(rng.randint(1, 4))) for _ in range(12)}
            pieces += [(name, float(rng.choice([-1, -2, -3, -4]))) for name in sorted(names)]
            counter, expected = tc.UnigramCounter(pieces, fallback), library(pieces, fallback)
            for _ in range(15):
                text = "".join(rng.choice("aabbccd \n") for _ in range(rng.randint(1, 30)))
                assert counter.count(text) == expected(text), (pieces, text)


def test_documents(spark, sf_dir, pieces):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = library(pieces)
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in tc.count_tokens(docs).collect():
        assert (row.n_chars, row.n_tokens) == (len(texts[row.doc_id]), expected(texts[row.doc_id]))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 5), (1, "a", 5), (1, "a", 5)], "doc_id long, text string, n_tokens int")
    assert sorted(r.n_tokens for r in tc.count_tokens(docs).collect()) == [0, 1, 1]
    assert tc.count_tokens(docs.limit(0)).collect() == []


def test_very_long_text(spark, pieces):
    text = "some words, einige Wörter \n" * 20_000
    found = tc.count_tokens(spark.createDataFrame([(1, text), (2, "a")], "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {1: library(pieces)(text), 2: library(pieces)("a")}
