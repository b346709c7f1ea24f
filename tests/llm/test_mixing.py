"""Mixing against a plain computation."""

import random

import pytest
from pyspark.sql import functions as F

from logrisk.llm import mixing


def plain_targets(sizes, weights, share=1.5, most=2.0):
    """Shares by weight; what is above a cap goes to the others until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in capped]
        rest = total - sum(most * sizes[n] for n in capped)
        target = {n: most * sizes[n] if n in capped else rest * weight[n] / sum(weight[f] for f in free) for n in names}
        above = {n for n in free if target[n] > most * sizes[n] * (1 + 1e-12)}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets_and_taken_words(spark, seed):
    rng = random.Random(seed)
    sources = [None, "", "b", "a", "é", "z", "Z", "\U0001f600"][: rng.randint(1, 8)]
    rows = []
    for i in range(300):
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 200])) or None, source, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.mix(docs).collect()
    sizes = {}
    for _, text, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = plain_targets(sizes, mixing.SOURCE_WEIGHTS)
    assert len(found) == 300
    taken = {}
    for r in found:
        assert r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-5) and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    largest = max((r.size for r in found), default=0)
    assert all(abs(taken[s] - expected[s]) <= largest for s in sizes)
    # Whole epochs come first: a source beyond its size takes each document at least once.
    assert all(r.taken >= r.size for r in found if r.target >= r.source_size)
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in found}
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.taken // r.size for r in found if r.size)


def test_heavy_documents_come_first(spark):
    docs = spark.createDataFrame([(i, "word " * 20 if i % 2 else "1234 " * 20, "a") for i in range(2000)], "doc_id long, text string, source string")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs, share=0.5).collect()}
    assert sum(t > 0 for i, t in taken.items() if i % 2) > 3 * sum(t > 0 for i, t in taken.items() if i % 2 == 0)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, None), (None, "a b", None), (1, "a b", "s"), (1, "a b", "s")], "doc_id long, text string, source string")
    found = mixing.mix(docs).collect()
    assert sorted(r.size for r in found) == [0, 2, 2, 2] and all(r.taken <= 2 * r.size for r in found)
    only = mixing.mix(docs.filter("text is null")).collect()
    assert [(r.size, r.target, r.taken) for r in only] == [(0, 0.0, 0)]
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.mix_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("weight", [1.0, 0.2, 0.05, 0.01, 1e-6])
def test_slices_of_a_hot_source_stay_even(spark, weight):
    """Texts of digits have a low quality weight; no slice holds much of their source."""
    docs = spark.range(40_000).withColumnRenamed("id", "doc_id")
    rows = docs.select(F.lit("digits").alias("source"), mixing.draw_key(F.col("doc_id"), F.lit(weight)).alias("draw"))
    keyed = mixing._keyed(rows)
    slices = keyed.groupBy("slice").agg(F.count("*").alias("n"), F.min("draw").alias("a"), F.max("draw").alias("b"))
    slices = slices.orderBy("slice").collect()
    assert max(row.n for row in slices) < 0.002 * 40_000
    assert all(one.b < two.a for one, two in zip(slices, slices[1:]))


def test_mixed_documents_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(i, "a b c " * 5, "s") for i in range(20)], "doc_id long, text string, source string")
    names = ["row", "size", "draw", "slice", "no_source", "source_key", "target", "taken", "copies", "start", "a`b"]
    mixed = mixing.mix_documents(docs.withColumns({name: F.lit("x") for name in names}))
    assert mixed.columns == ["doc_id", "text", "source", *names] and mixed.count() > 0
    assert {r["size"] for r in mixed.collect()} == {"x"}


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 1_000_000, "a"), (2, "one two", "b")], "doc_id long, text string, source string")
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == {1: 1_000_000, 2: 2}
