"""The pipeline's stages one after the other, each against its own input."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logrisk.llm import bpe, mixing, pii, toxicity
from test_near_dedup import brute_classes


def rows_of(df):
    return sorted(((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()), key=str)


def test_stages(spark, sf_dir):
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "personal-data", "mixing", "encoding"]

    kept = stages["toxicity"](spark, raw, sf_dir).cache()
    scores = {r.doc_id: r.score for r in toxicity.score_documents(raw, labels).collect()}
    assert kept.columns == raw.columns
    assert rows_of(kept) == rows_of(raw.filter(F.col("doc_id").isin([i for i, s in scores.items() if s < 0.5])))

    unique = stages["near-duplicates"](spark, kept, sf_dir).cache()
    docs = sorted((r.doc_id, r.text) for r in kept.collect() if len(r.text.split()) < 150)
    expected = {docs[root][0] for root in brute_classes([text for _, text in docs])}
    found = {r.doc_id for r in unique.collect()}
    assert unique.columns == raw.columns and found <= {r.doc_id for r in kept.collect()}
    # The least id of a class of short texts stays, unless a longer text of a lesser id takes it in.
    assert len(expected ^ {i for i, _ in docs if i in found}) <= 1

    clean = stages["personal-data"](spark, unique, sf_dir).cache()
    spans = {r.doc_id: [*r.base, *r.added] for r in pii.find(unique).collect()}
    before = {r.doc_id: r for r in unique.collect()}
    assert clean.columns == raw.columns and clean.count() == len(before)
    for r in clean.collect():
        assert r.text == pii.redact(before[r.doc_id].text, spans[r.doc_id]) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)

    mixed = stages["mixing"](spark, clean, sf_dir).cache()
    taken = {r.doc_id: r.taken // max(1, r.size) for r in mixing.mix(clean).collect()}
    assert mixed.columns == raw.columns
    assert rows_of(mixed) == sorted((row for row in rows_of(clean) for _ in range(taken[row[0]])), key=str)

    library = Tokenizer.from_file(bpe.TOKENIZER)
    texts = {r.doc_id: r.text for r in mixed.collect()}
    encoded = stages["encoding"](spark, mixed, sf_dir).collect()
    assert len(encoded) == mixed.count()
    for r in encoded:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert b"".join(i.to_bytes(4, "little") for i in ids) == bytes(r.ids) and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run(spark, sf_dir):
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.count() > 0 and df.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_documents(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "x@y.org " * 30, "de", None, 240)]
    docs = spark.createDataFrame(rows, columns)
    out = stage(spark, docs, sf_dir)
    assert out.count() <= 2 * len(rows)
    assert stage(spark, docs.limit(0), sf_dir).collect() == []
