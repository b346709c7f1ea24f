"""Segments against brute force, odd rows, and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logrisk.llm import toxicity


def maximal(values):
    """Maximal scoring segments by their recursive definition: the best one, the shortest and
    leftmost of equals, then those of either side."""

    def cut(low, high):
        best = None
        for i in range(low, high):
            for j in range(i, high):
                key = (-sum(values[i : j + 1]), j - i, i)
                if key[0] < 0 and (best is None or key < best[0]):
                    best = (key, i, j)
        if best is None:
            return []
        _, i, j = best
        return cut(low, i) + [(i, j, -best[0][0])] + cut(j + 1, high)

    return cut(0, len(values))


def test_segments_against_their_definition():
    rng = random.Random(4)
    for _ in range(400):
        # Scores in odd 64ths keep sums of different segments apart.
        values = [rng.choice([-0.25, -rng.randint(1, 90) / 64, rng.randint(1, 400) / 64 + 1 / 1024]) for _ in range(rng.randint(0, 14))]
        assert toxicity.segments(np.array(values)) == maximal(values)


def test_many_candidates_take_linear_time():
    scores = np.tile([1.0, -300.0], 200_000)
    assert len(toxicity.segments(scores)) == 200_000
    assert len(toxicity.segments(np.tile([1.0, -0.5], 200_000))) == 1


def model_of(rows):
    """The model of rows of text and label, counted one by one."""
    texts, toxic = (np.zeros(1 << toxicity.TABLE_BITS, np.int32) for _ in range(2))
    words = [0, 0]
    for text, label in rows:
        held = set(re.findall(r"\w+", text.lower()))
        for cell in {cell for word in held for cell in toxicity.cells_of(word)}:
            texts[cell] += 1
            toxic[cell] += label
        words[label] += len(held)
    return toxicity.ToxicityModel(texts, toxic, words[1] / sum(words))


def corpus(n, seed):
    """Texts of invented words, one in five with insults, some of them inflected."""
    rng = random.Random(seed)
    plain, bad = [f"w{i}x" for i in range(300)], ["scum", "moronic", "moronist", "clowns", "loser"]
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.2)
        words = [rng.choice(plain) for _ in range(rng.choice([0, 3, 20, 60]))]
        if label:
            at = rng.randint(0, len(words))
            words[at:at] = [rng.choice(bad) for _ in range(rng.randint(2, 5))]
        rows.append((i, rng.choice([" ", ", "]).join(words), label))
    return rows


def test_every_counted_word_scores(spark):
    rows = corpus(400, 1)
    docs = spark.createDataFrame([row[1:] for row in rows], "text string, toxic int").repartition(5)
    found, expected = toxicity.learn_tokens(docs), model_of([row[1:] for row in rows])
    assert (found.texts == expected.texts).all() and (found.toxic == expected.toxic).all() and found.share == expected.share
    scores = {word: found.word_score(word) for _, text, _ in rows for word in re.findall(r"\w+", text)}
    insults = {word for word in scores if not word.startswith("w")}
    assert min(scores[word] for word in insults) > 1 > 0.2 > max(abs(s) for word, s in scores.items() if word not in insults)
    assert len(set(scores.values())) > 50 and any(s < 0 for s in scores.values()) and 0.0 not in scores.values()
    # A form that was never met is scored by its stem, a word without any by nothing.
    assert found.word_score("moronically") > 1 and found.word_score("unheard") == 0.0


def test_words_of_clean_texts_score_below_zero():
    rows = [("kind words only", 0)] * 60 + [("scum words", 1)] * 20
    model = model_of(rows)
    assert model.word_score("kind") < -0.5 < model.word_score("words") < 0.5 < model.word_score("scum")


@pytest.mark.parametrize("label", [0, 1])
def test_a_text_is_scored_without_itself(label):
    rows = [row[1:] for row in corpus(150, 2)]
    text = "moronic scum w1x w2x unheard words"
    whole, rest = model_of([*rows, (text, label)]), model_of(rows)
    whole.share = rest.share
    for word in text.split():
        assert whole.word_score(word, label) == pytest.approx(rest.word_score(word))
        assert whole.word_score(word) != rest.word_score(word)


def test_evidence_column_is_the_evidence(spark):
    model = toxicity.ToxicityModel(None, None, 0.1, rate=1.3, density=0.02)
    rows = [(1, 0, []), (2, 100, [5.0]), (3, 3000, [1.0, 9.0, 4.0, 4.0]), (4, 7, [0.1, 0.2]), (5, 30_000, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "doc_id int, n_words long, s array<double>")
    df = df.withColumn("passages", F.transform("s", lambda x: F.struct(x.alias("score"))))
    for row in df.withColumn("e", toxicity._evidence_column(model)).collect():
        assert row.e == pytest.approx(toxicity.evidence(row.s, row.n_words, 1.3, 0.02))


def plain_scores(rows, documents):
    """The whole query text by text, but for the fit of the curve to its histogram."""
    model = model_of([row[1:] for row in rows])

    def scanned(text, own=None):
        words, seen, scores = re.findall(r"\w+", (text or "").lower()), set(), []
        for word in words:
            scores.append((0.0 if word in seen else model.word_score(word, own)) - toxicity.DRIFT)
            seen.add(word)
        return [s for _, _, s in maximal(scores)], scores

    steps, many, words = Counter(), 0, 0
    for _, text, label in rows:
        if label == 0:
            found, scores = scanned(text, 0)
            steps.update(round(score * toxicity._STEPS) for score in scores)
            many, words = many + sum(s >= toxicity._COUNTED for s in found), words + len(scores)
    rate = toxicity._rate(list(steps.items()))
    density = (many + 0.5) / (words + 1) * math.exp(rate * toxicity._COUNTED)
    judged = lambda text, own=None: toxicity.evidence(*(lambda f, s: (f, len(s)))(*scanned(text, own)), rate, density)
    bounded = lambda x: min(max(x, toxicity._EVIDENCE[0]), toxicity._EVIDENCE[1])
    histogram = {}
    for _, text, label in rows:
        x = math.floor(abs(bounded(judged(text, label))) * 10 + 0.5) / 10 * math.copysign(1, judged(text, label))
        histogram.setdefault(x, [0, 0])[label] += 1
    a, b = toxicity._logistic([(x, *n) for x, n in histogram.items()])
    return {i: 1 / (1 + math.exp(-(a + b * bounded(judged(text))))) for i, text in documents}


@pytest.mark.parametrize("seed", [3, 4])
def test_whole_query_against_a_plain_one(spark, seed):
    rows = corpus(260, seed)
    docs = spark.createDataFrame([(i, text, "en") for i, text, _ in rows], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    learnable = [row for row in rows if zlib.crc32(str(row[0]).encode()) % 5]
    expected = plain_scores(learnable, [row[:2] for row in rows])
    found = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    assert found.keys() == expected.keys()
    for i, score in found.items():
        assert score == pytest.approx(expected[i], abs=1e-6), i
    toxic = [i for i, _, label in rows if label]
    assert sum(found[i] >= 0.5 for i in toxic) > 0.9 * len(toxic)


def test_passages_are_where_the_insults_are(spark):
    rows = corpus(300, 5)
    text = "w1x w2x " * 30 + "you SCUM, loser and moronic clowns! " + "w3x w4x " * 30
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, text)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, labels).filter("doc_id = 1000").first()
    assert found.score > 0.9 and len(found.passages) == 1
    assert text[found.passages[0].start : found.passages[0].end] in ("SCUM, loser and moronic clowns", "you SCUM, loser and moronic clowns")


def test_very_long_text(spark):
    rows = corpus(200, 6)
    long = "w5x w6x " * 300_000 + "scum loser moronic clowns " + "w7x " * 100_000
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, long)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, labels).filter("doc_id = 1000").first()
    assert found.n_words == 700_004 and len(found.passages) <= 1


def test_accepted_keeps_columns_of_any_name(spark):
    rows = corpus(200, 7)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    docs = docs.withColumns({name: F.lit("x") for name in ("row", "spans", "no_id", "score", "id_key", "text_key", "passages")})
    labels = spark.createDataFrame([(i, label) for i, _, label in rows], "doc_id long, toxic int")
    kept = toxicity.accepted(docs, labels)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, score in scores.items() if score < 0.5}


def test_held_out_rows_are_classified(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    scored = toxicity.score_documents(docs, labels).join(labels, "doc_id").filter(toxicity.held_out(F.col("doc_id")))
    hits = {(r.toxic, r.p): r.n for r in scored.groupBy("toxic", (F.col("score") >= 0.5).alias("p")).agg(F.count("*").alias("n")).collect()}
    right, wrong = hits[1, True] + hits[0, False], hits.get((1, False), 0) + hits.get((0, True), 0)
    assert right / (right + wrong) > 0.98
    assert hits[1, True] / (hits[1, True] + hits.get((1, False), 0)) > 0.9


def test_held_out_labels_are_not_read(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    other = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted((r.doc_id, r.score) for r in toxicity.score_documents(docs, x).collect()) for x in (labels, other))
    assert one == two


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, 0.5), (1, "", 0.5), (2, "scum " * 50, 0.5), (2, "scum " * 50, 0.5), (3, "fine words", None)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    found = toxicity.score_documents(docs, labels).collect()
    assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
    empty = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert [r.score for r in empty] == [0.0] * 5
    assert toxicity.score_documents(docs.limit(0), labels).collect() == []
