"""Decontamination against a plain search of every window in every document."""

import random
import re

import pytest
from pyspark.sql import functions as F

from logrisk.llm import decontamination


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_result(docs, items, window=10):
    windows = set()
    for item, text in items:
        w = plain_words(text)
        size = min(window, len(w))
        if size:
            windows |= {("null" if item is None else str(item), tuple(w[i : i + size])) for i in range(len(w) - size + 1)}
    found = []
    for doc_id, text in docs:
        w, hit, told = plain_words(text), set(), set()
        for item, run in windows:
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i : i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    told.add(item)
        found.append((doc_id, len(w), len(hit), sorted(told, key=str.encode)))
    return found


def run(spark, docs, items, **settings):
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
        **settings,
    )
    return [(r.doc_id, r.n_words, sum(s.stop - s.start for s in r.spans), r["items"]) for r in found.collect()]


def ordered(rows):
    return sorted(rows, key=repr)


def random_case(rng, vocabulary):
    word = lambda: rng.choice(vocabulary)
    items = [(rng.choice([None, 1, i, i]), rng.choice([None, "", "?!", " ".join(word() for _ in range(rng.randint(1, 25)))])) for i in range(25)]
    docs = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            text = (rng.choice(items)[1] or "").split(" ")
            cut = rng.randint(0, len(text))
            parts += [" ".join(text[cut:] if rng.random() < 0.5 else text), " ".join(word() for _ in range(rng.randint(0, 5)))]
        docs.append((rng.choice([None, 5, i, i]), rng.choice([None, "", "-", *[rng.choice([", ", "\n", "...", " "]).join(parts).upper()] * 9])))
    return docs, items


VOCABULARIES = [list("abc"), ["a", "b2", "é", "É", "漢字", "x́", "Ça", "the"], [f"w{i}" for i in range(40)]]


@pytest.mark.parametrize("seed", range(6))
def test_equals_a_plain_search(spark, seed):
    docs, items = random_case(random.Random(seed), VOCABULARIES[seed % 3])
    assert ordered(run(spark, docs, items)) == ordered(plain_result(docs, items))


@pytest.mark.parametrize("seed", range(2))
def test_without_broadcast(spark, seed, monkeypatch, joins_without_broadcast):
    monkeypatch.setattr(decontamination, "MOST_BROADCAST", 0)
    docs, items = random_case(random.Random(40 + seed), VOCABULARIES[seed])
    assert ordered(run(spark, docs, items)) == ordered(plain_result(docs, items))


@pytest.mark.parametrize(("window", "shingle"), [(10, 1), (10, 10), (4, 5), (7, 3), (1, 5)])
def test_other_windows_and_shingles(spark, window, shingle):
    docs, items = random_case(random.Random(window * 10 + shingle), VOCABULARIES[1])
    found = run(spark, docs, items, window=window, shingle=shingle)
    assert ordered(found) == ordered(plain_result(docs, items, window))


def test_spans_are_runs_of_words(spark):
    item = " ".join(f"q{i}" for i in range(12))
    text = f"One, {item}! two three {item} {item} four"
    found = decontamination.contaminated(
        spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([("x", item)], "item_id string, text string")
    ).first()
    assert [tuple(s) for s in found.spans] == [(1, 13), (15, 39)] and found["items"] == ["x"]


def test_rarest_shingle_is_the_prefix(spark):
    """Frequent shingles are not what the candidates come from."""
    common = "a a a a a a a a a"
    docs = spark.createDataFrame([(i, common) for i in range(50)] + [(99, common + " rare b c d e")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a a a a a a a a rare b")], "item_id long, text string")
    members = decontamination.item_windows(items)
    shingles = decontamination.window_shingles(members.select("window").withColumn("wid", F.lit(1))).cache()
    known = shingles.select("shingle").distinct().withColumn("sid", F.hash("shingle"))
    hits = decontamination._hits(docs, known, [5])
    prefix = decontamination.prefixes(shingles.join(known, "shingle"), hits).join(known, "sid").first()
    assert "rare" in prefix.shingle and len(prefix.covers) == 2
    assert hits.filter(F.col("sid") == prefix.sid).count() == 1
    shingles.unpersist()


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (None, None, "x", "y")], "doc_id long, text string, words string, row string")
    items = spark.createDataFrame([(1, "B", "z")], "item_id long, text string, wid string")
    wide = docs.withColumns({name: F.lit(1) for name in ("pos", "sid", "n_words", "items", "spans")})
    found = {(r.doc_id, r.n_words, len(r.spans), tuple(r["items"])) for r in decontamination.contaminated(wide, items).collect()}
    assert found == {(1, 2, 1, ("1",)), (None, 0, 0, ())}
    assert decontamination.contaminated(docs.limit(0), items).collect() == []
    assert all(r["items"] == [] for r in decontamination.contaminated(docs, items.limit(0)).collect())
    nothing = spark.createDataFrame([(1, None), (2, " . ")], "item_id long, text string")
    assert all(r.spans == [] for r in decontamination.contaminated(docs, nothing).collect())


def test_very_long_text_and_repeated_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    text = ("filler " * 150_000) + passage + (" filler" * 50_000) + " " + passage
    docs = [(1, text), (2, passage), (2, passage), (2, passage)]
    assert ordered(run(spark, docs, [(7, passage)])) == ordered([(1, 200_120, 120, ["7"]), *[(2, 60, 60, ["7"])] * 3])


def test_no_python_on_the_way(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    plan = decontamination.contaminated(read("documents"), read("benchmark"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
