"""BPE by tree concatenation against the library."""

import random

import pytest
from tokenizers import Tokenizer

from logrisk.llm import bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.TOKENIZER)


@pytest.fixture(scope="module")
def encoder():
    return bpe.WordBpe(leaf=8)


def ids_of(found):
    return [int.from_bytes(found[i : i + 4], "little") for i in range(0, len(found), 4)]


TEXTS = [
    None,
    "",
    " \t\n ",
    "It's the THEN they'll've",
    "a<|endoftext|>b <|startoftext|><|endoftext|>",
    "naïve Σοφός ΟΔΟΣ İstanbul ß ﬁ é 12345 ½ ٣ ",
    "漢字かなカナ 한국어 ​ x\x1cy ՘ Ɤ \U0001f600🇩🇪",
    "x" * 5000,
    "!?" * 3000,
    "é" * 2000 + "漢" * 999,
]


@pytest.mark.parametrize("text", TEXTS)
def test_edge_texts(encoder, library, text):
    ids, decoded = encoder.encode(text)
    expected = library.encode(text or "", add_special_tokens=False).ids
    assert ids_of(ids) == expected
    assert decoded == library.decode(expected, skip_special_tokens=False)
    assert encoder.decode(ids) == decoded


def test_every_ascii_character(encoder, library):
    """Alone, between letters, between signs and doubled; U+001C to U+001F are no white space."""
    for code in range(128):
        c = chr(code)
        for text in (c, f"a{c}b", f"!{c}?", f"1{c}{c}2", f"a {c} b"):
            expected = library.encode(text, add_special_tokens=False).ids
            assert ids_of(encoder.encode(text)[0]) == expected, repr(text)
            assert encoder.encode(text)[1] == library.decode(expected, skip_special_tokens=False), repr(text)


def test_long_words_of_many_shapes(encoder, library):
    rng = random.Random(5)
    parts = [token.removesuffix("</w>") for token in library.get_vocab() if token.isascii() and token.isalpha()]
    for _ in range(300):
        kind = rng.random()
        if kind < 0.4:
            text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 80)))
        elif kind < 0.7:
            text = "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 400)))
        else:
            text = "".join(rng.choice("!?.,-=*#") for _ in range(rng.randint(1, 300)))
        assert ids_of(encoder.encode(text)[0]) == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in bpe.encode_documents(docs).collect():
        expected = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert ids_of(row.ids) == expected
        assert row.decoded == library.decode(expected, skip_special_tokens=False)


def test_odd_rows(spark):
    rows = [(None, None, 1), (7, "a b", 2), (7, "a b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = sorted((r.doc_id or -1, r.decoded) for r in bpe.encode_documents(docs).collect())
    assert found == [(-1, ""), (7, "a</w> b</w>"), (7, "a</w> b</w>")]
    assert bpe.encode_documents(docs.limit(0)).collect() == []
