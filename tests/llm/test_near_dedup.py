"""Order MinHash classes against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logrisk.llm import near_dedup
from logrisk.llm.components import components


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("wide", [8192, 0])
def test_distance_within_against_the_full_table(monkeypatch, wide):
    monkeypatch.setattr(near_dedup, "_WIDE", wide)
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        b = list(a) if rng.random() < 0.7 else [rng.randint(0, 3) for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 4)):
            if b and rng.random() < 0.6:
                b[rng.randrange(len(b))] = rng.randint(0, 3)
            elif b and rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randint(0, len(b)), rng.randint(0, 3))
        d = edit_distance(a, b)
        a, b = (a, b) if len(a) >= len(b) else (b, a)
        for most in range(0, 8):
            found = near_dedup.distance_within(near_dedup.Places(np.array(a, np.uint32)), b, most)
            assert found == (d <= most), (a, b, most, d)


def test_long_texts_take_bounded_memory():
    words = np.random.default_rng(1).integers(0, 2**32, 30_000).astype(np.uint32)
    other = words.copy()
    other[::100] += 1
    one, two = near_dedup.Member(b"1", words), near_dedup.Member(b"2", other)
    assert near_dedup.near(one, two, 300) and not near_dedup.near(one, two, 299)


def brute_classes(texts, similarity=near_dedup.SIMILARITY):
    words = [(t or "").split() for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(words)):
        for j in range(i):
            n, m = len(words[i]), len(words[j])
            most = near_dedup.most_edits(n, m, similarity)
            if abs(n - m) <= most and (words[i] == words[j] or edit_distance(words[i], words[j]) <= most):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def edited(rng, words, share):
    out = []
    for word in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(f"new{rng.randint(0, 999)}" if x < 2 * share / 3 else word)
        if x > 1 - share / 3:
            out.append(f"more{rng.randint(0, 999)}")
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    passage = [f"p{rng.randint(0, 50)}" for _ in range(30)]
    for i in range(40):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([3, 20, 60, 120]))]
        if i % 3 == 0:
            words = words + passage
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3])):
            texts.append(" ".join(edited(rng, words, rng.choice([0.0, 0.02, 0.05]))))
    texts += [texts[5]] * 6 + ["", None, "  \n", "a", "a", "b"]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 3])
def test_classes_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = corpus(7)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, digest string")
    found = {r.doc_id: (r.class_id, r.class_size) for r in near_dedup.classes(docs).collect()}
    expected = brute_classes(texts)
    assert [found[i][0] for i in range(len(texts))] == expected
    assert all(found[i][1] == expected.count(expected[i]) for i in found)
    kept = near_dedup.representatives(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected))
    assert all(r.text == texts[r.doc_id] and r.digest == "x" for r in kept)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(100)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(100)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.class_size for r in near_dedup.classes(docs).collect()} == {200}


def edited_pair(rng, n, share, kind):
    """A text of ``n`` words and one at a similarity of ``1 - share``, edits spread evenly."""
    words = [rng.getrandbits(62) for _ in range(n)]
    edits = near_dedup.most_edits(n, n, 1 - share)
    if kind == "substitutions":
        places = set(rng.sample(range(n), edits))
        other = [rng.getrandbits(62) if i in places else w for i, w in enumerate(words)]
    elif kind == "deletions":
        places = set(rng.sample(range(n), edits))
        other = [w for i, w in enumerate(words) if i not in places]
    else:
        other = list(words)
        for _ in range(int(n / (1 - share)) - n):
            other.insert(rng.randint(0, len(other)), rng.getrandbits(62))
    return np.array(words, np.uint64), np.array(other, np.uint64)


@pytest.mark.parametrize("kind", ["substitutions", "deletions", "insertions"])
@pytest.mark.parametrize("n", [76, 80, 120, 300, 1000])
def test_recall_of_the_keys(n, kind):
    """Shares of edited copies that meet in some bucket, at the similarities that the docstring names."""
    rng = random.Random(n)
    for share, least in ((0.05, 1.0), (0.1, 0.995), (0.15, 0.97), (0.2, 0.9)):
        pairs = [edited_pair(rng, n, share, kind) for _ in range(250)]
        met = sum(bool(set(near_dedup.sketch(a)) & set(near_dedup.sketch(b))) for a, b in pairs)
        assert met / len(pairs) >= least, share


def short_pair(rng, n, edits):
    words = [rng.randint(0, 10**9) for _ in range(n)]
    other = list(words)
    for place in sorted(rng.sample(range(n), edits), reverse=True):
        kind = rng.random()
        if kind < 0.4:
            other[place] = rng.randint(0, 10**9)
        elif kind < 0.7:
            del other[place]
        else:
            other.insert(place, rng.randint(0, 10**9))
    return words, other


def test_short_texts_always_meet():
    """Every pair of at least ``SIMILARITY`` whose shorter text has 1 to ``SHORT`` words, whatever
    the order of the k-mers."""
    rng, wanted = random.Random(4), near_dedup.prefixes()
    levels = np.random.default_rng(4).integers(0, 9, near_dedup._CELLS).astype(np.uint8)
    for n in range(1, near_dedup.SHORT + 1):
        for _ in range(60):
            pair = short_pair(rng, n, min(n, rng.randint(0, near_dedup.most_edits(n, n, 0.8) + 2)))
            if rng.random() < 0.3:
                pair = [[w % 3 for w in words] for words in pair]
            most = near_dedup.most_edits(len(pair[0]), len(pair[1]), 0.8)
            if pair[0] == pair[1] or edit_distance(*pair) > most or min(map(len, pair)) > near_dedup.SHORT:
                continue
            keys = [set(near_dedup.short_keys(np.array(w, np.uint32), levels, wanted[len(w)])) for w in pair]
            assert keys[0] & keys[1], pair


def test_classes_of_short_texts_against_brute_force(spark):
    rng, texts = random.Random(8), ["a b c d", "a b c d e", "x a b c d"]
    for n in [4, 5, 6, 8, 10, 12, 15, 15, 20, 30, 48, 60] * 6:
        most = near_dedup.most_edits(n, n, 0.8)
        texts += [" ".join(f"w{w}" for w in words) for words in short_pair(rng, n, rng.randint(0, most))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_classes(texts)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (300, 300)]
    edges += [(rng.randint(400, 480), rng.randint(400, 480)) for _ in range(60)]
    label = {}
    for a, b in edges:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(len(label)):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == label and len(found) == len(label)


def test_rows_without_an_id_meet_their_own_text_only(spark):
    texts = [f"text {i} of many that have no id {i * 7}" for i in range(10_000)] + ["the same"] * 3
    docs = spark.createDataFrame([(None, t) for t in texts] + [(5, "a b"), (5, "c d")], "doc_id long, text string")
    rows = near_dedup.sketched(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    needed = rows.groupBy("digest").agg(first)
    assert near_dedup.first_texts(docs, needed).count() == docs.count()


def test_blocks_by_words(spark, monkeypatch):
    """A few long texts are blocks of their own."""
    monkeypatch.setattr(near_dedup, "BLOCK_WORDS", 500)
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(300)]
    texts = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(9)] + ["other words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.class_size for r in near_dedup.classes(docs).collect()) == [1] + [9] * 9


def test_representatives_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d")], "doc_id long, text string")
    names = ["row", "root", "best", "nth", "no_id", "id_key", "hash_key", "key", "class", "digest", "text_hash"]
    kept = near_dedup.representatives(docs.withColumns({name: F.lit("x") for name in names}))
    assert kept.columns == ["doc_id", "text", *names]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (None, "a b"), (None, "a b"), (4, ""), (9, "a b"), (9, "a b"), (9, "c")], "doc_id long, text string")
    found = sorted(((r.doc_id, r.class_id, r.class_size) for r in near_dedup.classes(docs).collect()), key=str)
    assert found == sorted([(None, 4, 2), (4, 4, 2), (None, 9, 4), (None, 9, 4), (9, 9, 4), (9, 9, 4), (9, 9, 1)], key=str)
    assert sorted((r.doc_id, r.text) for r in near_dedup.representatives(docs).collect()) == [(4, ""), (9, "a b"), (9, "c")]
    assert near_dedup.classes(docs.limit(0)).collect() == []
