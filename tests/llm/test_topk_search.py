"""Block-at-a-time search against brute force."""

import random

import numpy as np

from logrisk.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=5, every=50):
    cells = []
    for number, vector, *_ in rows:
        if vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        cells.append((number, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = []
    for number, q in cells:
        if number is None or number % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), other is None, other or 0) for other, v in cells if other != number)
        out += [(number, i + 1, None if none else other, -s) for i, (s, none, other) in enumerate(scored[:k])]
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in topk_search.top_k(df, **options).collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(6)], "x") for i in range(700)]
    rows += [(i, [0.25] * 6, "copy") for i in range(700, 760)]
    monkeypatch.setattr(topk_search, "SHARD_ROWS", 200)
    monkeypatch.setattr(topk_search, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk_search, "CHUNK_ROWS", 5)
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], None),
        (50, None, None),
        (100, [1.0, None], None),
        (150, [float("nan"), 1.0], None),
        (200, [float("inf"), 1.0], None),
        (250, [-1.0, 0.001, 3.0], None),
        (None, [1.0, 1.0], None),
        (3, [], None),
        (4, [1e6, -1e6], None),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == []
    assert run(spark, rows[:0]) == []


def test_blocks_are_pruned():
    rng = np.random.default_rng(1)
    cells = np.sort(rng.integers(0, 1000, (2048, 4)), axis=0)
    starts = np.arange(0, 2048, topk_search.BLOCK_ROWS)
    highs, lows = np.maximum.reduceat(cells, starts), np.minimum.reduceat(cells, starts)
    ids = np.arange(2048)
    best, scored = topk_search.search(np.array([-1]), np.array([[1, 2, 3, 4]]), ids, cells, highs, lows, 5)
    scores = cells @ np.array([1, 2, 3, 4])
    assert best.id[0].tolist() == sorted(ids, key=lambda i: (-scores[i], i))[:5]
    assert scored < len(starts) / 2
