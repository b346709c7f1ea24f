"""Cuts against Python's own, the index against its offsets, and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logrisk.llm import fill_middle

MARKS = ("<P>", "<S>", "<M>")


def plain(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def offsets_of(texts):
    whole = "".join(texts).encode()
    ends = np.cumsum([0, *[len(text.encode()) for text in texts]])
    return fill_middle.boundaries(np.frombuffer(whole, np.uint8), ends), whole, ends


ALPHABET = "ab \n<>PSMéß漢字\U0001f600́"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), min_size=1, max_size=8), st.integers(0, 20))
def test_index_gives_every_offset(texts, most_error):
    (offsets, starts), whole, ends = offsets_of(texts)
    expected = [int(ends[i]) + len(text[:k].encode()) for i, text in enumerate(texts) for k in range(len(text) + 1)]
    assert offsets.tolist() == expected
    index = fill_middle.fit(offsets, starts, most_error)
    assert np.abs(index.residuals).max() <= most_error
    assert index.offsets(np.arange(len(offsets))).tolist() == expected


def test_segments_follow_the_scripts():
    text = "a" * 5000 + "漢" * 5000 + "é" * 5000
    (offsets, starts), _, _ = offsets_of([text, "b" * 9000, ""])
    index = fill_middle.fit(offsets, starts)
    assert len(index.first) < 60 and index.offsets(np.arange(len(offsets))).tolist() == offsets.tolist()
    only = fill_middle.fit(*offsets_of(["plain text " * 1000])[0])
    assert len(only.first) == 1 and not only.residuals.any()


@pytest.mark.parametrize("seed", range(3))
def test_outputs_and_round_trip(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, i, i, i, -i]), rng.choice([None, "", "<P>", "a<M>b", "x", "<S", "P>", "".join(rng.choices(ALPHABET, k=rng.randint(1, 400)))]))
        for i in range(600)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = fill_middle.transform(docs)
    found = found.withColumn("restored", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    key = lambda row: tuple(str(v) for v in row)
    expected = [(doc_id, *plain(doc_id, text), text or "") for doc_id, text in rows]
    assert sorted([tuple(row) for row in found], key=key) == sorted(expected, key=key)
    assert {row.form for row in found} == {"plain", "psm", "spm"}


def test_marks_made_by_a_cut_do_not_mislead(spark):
    """Parts of marks at the ends of the parts."""
    rows = [(i, text) for i in range(400) for text in ("<<<", "S><", "<S<P<M", ">P<S>"[1:4], "M>M>", "<<S")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = fill_middle.transform(docs).withColumn("restored", fill_middle.restored(F.col("output"), F.col("form")))
    pairs = {(row.doc_id, row.restored) for row in found.collect()}
    assert pairs == set(rows)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a" * 3_000_000 + "é漢" * 500_000, "x"), (1, "b", "y"), (1, "b", "y")], "doc_id long, text string, output string")
    wide = docs.withColumns({name: F.lit("z") for name in ("h1", "hash", "n", "form")})
    found = {(row.n, row.output) for row in fill_middle.transform(wide).collect()}
    assert found == {(plain(1, row.text)[0], plain(1, row.text)[-1]) for row in docs.collect()}
    assert fill_middle.transform(docs).count() == 3
    assert fill_middle.transform(docs.limit(0)).collect() == []
    # Ids of another kind draw by their text.
    named = spark.createDataFrame([("seven", "some text")], "doc_id string, text string")
    assert fill_middle.transform(named).first()[1:] == plain("seven", "some text")
