"""The manifest against a plain tree, and what a proof says about a changed row."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from logrisk.llm import merkle
from logrisk.llm.queries import op13_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    sized = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha("".join(sized(row[name]) for name in merkle.LEAF_COLUMNS))


def plain_tree(digests):
    """The last node, and for each leaf its siblings by level as (before, after)."""
    proofs, owners = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, above_owners = [], []
        for start in range(0, len(digests), 8):
            run = digests[start : start + 8]
            for j in range(len(run)):
                for leaf in owners[start + j]:
                    proofs[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            above.append(sha("".join(run)))
            above_owners.append([leaf for j in range(len(run)) for leaf in owners[start + j]])
        digests, owners = above, above_owners
    return digests[0], proofs


def plain_manifest(rows):
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of rows as dicts."""
    langs = sorted({row["lang"] for row in rows}, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        own = [row for row in rows if row["lang"] == lang]
        own.sort(key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row)))
        trees[lang] = own, *plain_tree([plain_leaf(row) for row in own])
    root, ways = plain_tree([trees[lang][1] for lang in langs])
    found = []
    for lang, way in zip(langs, ways):
        own, subroot, proofs = trees[lang]
        for row, proof in zip(own, proofs):
            proof = proof + way
            folded = leaf = plain_leaf(row)
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])
                folded = plain_leaf({**row, "text": lowered})
            for before, after in proof:
                folded = sha(before + folded + after)
            siblings = sha("".join(before + after for before, after in proof))
            found.append((row["doc_id"], leaf, subroot, root, siblings, folded, folded == root))
    return found


def query(spark, tmp_path, rows):
    df = spark.createDataFrame([tuple(row[c.split()[0]] for c in SCHEMA.split(", ")) for row in rows], SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(row) for row in op13_manifest(spark, str(tmp_path)).collect()]


def ordered(rows):
    return sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, *row[1:]))


def random_rows(rng, n, langs):
    return [
        {
            "doc_id": rng.choice([None, 7, i, i, i, i, i, i]),
            "text": rng.choice([None, "", "Aé ÄB", "plain", f"Text {rng.randint(0, 9)}"]),
            "lang": langs[0] if rng.random() < 0.5 else rng.choice(langs),
            "source": rng.choice([None, "", "s"]),
            "n_chars": rng.choice([None, -1, 12]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize(
    ("n", "langs"),
    [
        (1, ["en"]),
        (1, [None]),
        (5, ["en"]),
        (8, ["en"]),
        (9, ["en"]),
        (65, ["en"]),
        (700, ["en"]),
        (3, ["b", "a", None]),
        (60, ["en", "de", None, "", "é", "Z", "z", "\U0001f600", "ﬀ"]),
        (400, ["en", None, "de"]),
        (150, ["en", *[f"l{i}" for i in range(90)]]),
    ],
)
def test_equals_a_plain_tree(spark, tmp_path, n, langs):
    rows = random_rows(random.Random(n * 31 + len(langs)), n, langs)
    assert ordered(query(spark, tmp_path, rows)) == ordered(plain_manifest(rows))


def test_shuffled_ancestors_give_the_same(spark, tmp_path, monkeypatch, joins_without_broadcast):
    monkeypatch.setattr(merkle, "MOST_BROADCAST", 0)
    rows = random_rows(random.Random(5), 1500, ["en", "en", "de", None])
    assert ordered(query(spark, tmp_path, rows)) == ordered(plain_manifest(rows))


def test_repeated_rows_are_leaves_of_their_own(spark, tmp_path):
    row = {"doc_id": 3, "text": "A", "lang": "en", "source": "s", "n_chars": 1}
    found = query(spark, tmp_path, [row] * 20)
    assert ordered(found) == ordered(plain_manifest([row] * 20)) and len(found) == 20


def test_ranges_split_equal_rows(spark):
    """No partition holds all rows of one id and text."""
    rows = spark.range(40_000).select(
        F.lit("en").alias("group"), F.lit(1).alias("id"), F.col("id").alias("row_no"), F.lit(b"x" * 32).alias("digest")
    )
    numbered = merkle._numbered(rows, "group", [F.col("id").asc(), F.col("digest").asc(), F.col("row_no").asc()])
    assert numbered.select("idx").distinct().count() == 40_000
    assert numbered.agg(F.min("idx"), F.max("idx"), F.max("size")).first()[:] == (0, 39_999, 40_000)
    dealt = rows.repartitionByRange(8, "group", "id", "digest", "row_no").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < 10_000


def test_only_changed_rows_fail(spark, tmp_path):
    rows = [{"doc_id": i, "text": "Upper" if i % 2 else "lower", "lang": "en", "source": "s", "n_chars": 5} for i in range(200)]
    for doc_id, leaf, _, root, _, folded, verified in query(spark, tmp_path, rows):
        changed = zlib.crc32(str(doc_id).encode()) % 3 == 0 and doc_id % 2 == 1
        assert verified == (not changed) and (folded == root) == verified


def test_empty_table_and_other_columns(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA + ", leaf string, root int, idx long, tree string, size long, digest string")
    assert merkle.verify_documents(empty).collect() == []
    rows = random_rows(random.Random(2), 30, ["en", None])
    df = spark.createDataFrame([tuple(row[c.split()[0]] for c in SCHEMA.split(", ")) for row in rows], SCHEMA)
    names = ["leaf", "root", "idx", "tree", "size", "digest", "place", "altered", "proof", "row_no", "a`b"]
    wide = df.withColumns({name: F.lit("x") for name in names})
    columns = ["doc_id", "leaf", "subroot", "root", "folded_root"]
    kept = lambda found: ordered(tuple(row) for row in found.select(*columns).collect())
    assert kept(merkle.verify_documents(wide)) == kept(merkle.verify_documents(df))


def test_very_long_text(spark):
    long = "Ab é " * 400_000
    df = spark.createDataFrame([(1, long, "en", "s", len(long)), (2, "x", "en", "s", 1)], SCHEMA)
    row = {"doc_id": 1, "text": long, "lang": "en", "source": "s", "n_chars": len(long)}
    assert {r.leaf for r in merkle.verify_documents(df).collect()} >= {plain_leaf(row)}


def test_general_manifest(spark):
    """Other groups, other keys: a stored leaf and its proof give the root."""
    leaves = spark.range(300).select(
        (F.col("id") % 3).alias("shard"), F.col("id").alias("file"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("leaf")
    )
    found = merkle.manifest(leaves, "shard", "file")
    folded = merkle.fold(F.lower(F.hex("leaf")), F.col("proof"))
    assert found.filter(folded == F.lower(F.hex("root"))).count() == 300
    assert found.select("subroot").distinct().count() == 3 and found.select("root").distinct().count() == 1
