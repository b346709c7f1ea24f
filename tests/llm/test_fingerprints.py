"""Fingerprints of texts and their edits; SQL on the given tables is in test_queries."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from logrisk.llm import fingerprints

SCHEMA = "doc_id long, text string, fingerprint string, block int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def edited_hash(text, following):
    text, following = text or "", following or ""
    half = len(text) // 2
    return hashlib.sha256((text[: len(text) - half] + following[:half]).encode()).hexdigest()


def order(row):
    return (row[0] is None, -(row[0] or 0), hashlib.md5((row[1] or "").encode()).hexdigest())


def check_edits(spark, rows):
    ordered = sorted(rows, key=order)
    expected = sorted(
        (str(i), len(t or ""), edited_hash(t, ordered[(at + 1) % len(ordered)][1])) for at, (i, t) in enumerate(ordered)
    )
    found = fingerprints.fingerprint_edits(table(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    return found


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(rng.choice([rng.randint(-(2**62), 2**62), rng.randint(0, 50)]), words(rng, rng.randint(0, 60))) for _ in range(150)]
    rows += [(None, words(rng, 5)), (None, None), (None, ""), (3, "é\U0001f600漢 a b"), (2**63 - 1, "x"), (-(2**63), "y")]
    rows += [(77, "same text")] * 3 + [(78, "same text"), (79, "  "), (80, "!!")]
    found = check_edits(spark, rows)
    prints = {}
    for (i, t), fp in [((r.doc_id, r.n_chars), r.fingerprint) for r in found if r.doc_id in (77, 78)]:
        prints[i] = fp
    assert prints[77] == prints[78]


@pytest.mark.parametrize("rows", [[(5, "only one")], [(None, None)], [(1, "a b c"), (1, "a b c")]])
def test_few_rows(spark, rows):
    check_edits(spark, rows)


def test_empty(spark):
    assert fingerprints.fingerprint_edits(table(spark, [])).collect() == []


def test_likeness_follows_the_common_terms(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        base = [f"t{rng.randint(0, 3000)}" for _ in range(120)]
        rows += [(3 * i + 2, " ".join(base)), (3 * i + 1, " ".join(base[:-6] + ["q"] * 6)), (3 * i, words(rng, 100))]
    found = {r.doc_id: r for r in fingerprints.fingerprint_edits(table(spark, rows)).collect()}
    near = sum(found[3 * i + 2].near_next for i in range(60)) / 60
    half = sum(found[3 * i].near_edited for i in range(60)) / 60
    far = sum(found[3 * i + 1].near_next for i in range(60)) / 60
    assert near > 0.7 > half > 0.1 > far


def test_large_lexicons_are_not_broadcast(spark, monkeypatch, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    one = sorted(fingerprints.fingerprint_edits(docs).collect())
    monkeypatch.setattr(fingerprints, "MOST_BROADCAST", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(fingerprints.fingerprint_edits(docs).collect()) == one
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_very_long_text(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 30)) for i in range(40)] + [(90, words(rng, 200_000)), (91, "é" * 1_000_000)]
    check_edits(spark, rows)


def test_columns_of_any_name(spark):
    rng = random.Random(7)
    docs = spark.createDataFrame([(i, words(rng, 20)) for i in range(30)], "doc_id long, text string")
    names = ["block", "place", "order", "hash", "extra", "which", "stand", "both", "variant", "fingerprint", "term"]
    wide = docs.withColumns({name: F.lit("x") for name in names})
    assert sorted(fingerprints.fingerprint_edits(wide).collect()) == sorted(fingerprints.fingerprint_edits(docs).collect())
