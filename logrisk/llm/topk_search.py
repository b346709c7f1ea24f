"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are sorted by id and cut into blocks of ``BLOCK_ROWS``; a block holds the largest and
smallest value of every component (its term maxima, for weights of either sign) and its rows as
a forward index. ``SHARD_ROWS`` consecutive rows travel as one row, and so do ``CHUNK_ROWS``
queries. Each pair of a chunk and a shard is one unit of work of bounded size: for every query
the bounds of all blocks are summed, blocks are scored in descending order of their bounds, and
a query stops at the first bound below its k-th score. Equal scores go to the smaller id, so a
bound equal to the k-th score is still scored. The best k of each shard are merged per query.

Values are ``floor(256 * x)``, saturated to 64 bits; scores are 64-bit integers (which wrap if
they overflow). A vector that is null or holds null, NaN or infinite values takes no part.
Shorter vectors count as padded with zeros. A query does not meet rows of its own id; repeated
ids are candidates each; a null id is no query and ranks last among equal scores. With fewer
than k candidates all are returned. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.sources.scratch import materialize

BLOCK_ROWS = 128
SHARD_ROWS = 8192
CHUNK_ROWS = 512
SCALE = 256
_NO_ID = np.iinfo(np.int64).max
_PACKED = "ids binary, dims int, rows int, cells binary, highs binary, lows binary"


def quantized(vectors: DataFrame) -> DataFrame:
    """``vec_id, cells`` of the vectors that take part."""
    cell = F.col("embedding")
    finite = F.forall(cell, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    cells = F.transform(cell, lambda x: F.floor(SCALE * x.cast("double")))
    return vectors.filter(cell.isNotNull() & finite).select("vec_id", cells.alias("cells"))


def is_query(every: int) -> Column:
    return F.col("vec_id").isNotNull() & (F.col("vec_id") % every == 0)


def pack(vectors: DataFrame, rows: int) -> DataFrame:
    """Consecutive rows as one, with the block bounds. Needs rows sorted within partitions."""

    def packed(ids: np.ndarray, lists: list[np.ndarray]) -> dict:
        dims = max(1, *map(len, lists))
        cells = np.zeros((len(lists), dims), np.int64)
        for row, values in zip(cells, lists):
            row[: len(values)] = values
        starts = np.arange(0, len(lists), BLOCK_ROWS)
        return {
            "ids": ids.tobytes(),
            "dims": dims,
            "rows": len(lists),
            "cells": _narrow(cells),
            "highs": np.maximum.reduceat(cells, starts).tobytes(),
            "lows": np.minimum.reduceat(cells, starts).tobytes(),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists = [], []
        schema = pa.schema(
            [("ids", pa.binary()), ("dims", pa.int32()), ("rows", pa.int32())]
            + [(name, pa.binary()) for name in ("cells", "highs", "lows")]
        )
        for batch in batches:
            column = batch.column(1)
            flat = column.values.to_numpy(zero_copy_only=False)
            offsets = column.offsets.to_numpy()
            ids.extend(_NO_ID if x is None else x for x in batch.column(0).to_pylist())
            lists.extend(flat[a:b] for a, b in zip(offsets[:-1], offsets[1:]))
            while len(ids) >= rows:
                yield pa.RecordBatch.from_pylist([packed(np.array(ids[:rows]), lists[:rows])], schema)
                ids, lists = ids[rows:], [x.copy() for x in lists[rows:]]
        if ids:
            yield pa.RecordBatch.from_pylist([packed(np.array(ids), lists)], schema)

    return vectors.mapInArrow(run, _PACKED)


def _narrow(cells: np.ndarray) -> bytes:
    small = cells.size == 0 or np.abs(cells).max() < 2**31
    return cells.astype(np.int32).tobytes() if small and cells.min(initial=0) > -(2**31) else cells.tobytes()


def _matrix(data: bytes, rows: int, dims: int) -> np.ndarray:
    wide = len(data) == rows * dims * 8
    return np.frombuffer(data, np.int64 if wide else np.int32).reshape(rows, dims).astype(np.int64)


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` exactly: in doubles where no sum can leave their integers."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    if largest < 2**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def _padded(cells: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(cells, ((0, 0), (0, dims - cells.shape[1])))


class Best:
    """The best k of each query so far: scores descending, ids ascending among equals."""

    def __init__(self, queries: int, k: int):
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), _NO_ID)
        self.found = np.zeros((queries, k), bool)

    def kth(self) -> tuple[np.ndarray, np.ndarray]:
        return self.score[:, -1], self.found[:, -1]

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        k = self.score.shape[1]
        score = np.concatenate([self.score[which], scores], axis=1)
        number = np.concatenate([self.id[which], np.broadcast_to(ids, scores.shape)], axis=1)
        found = np.concatenate([self.found[which], allowed], axis=1)
        order = np.lexsort((number, ~score, ~found), axis=1)[:, :k]
        self.score[which] = np.take_along_axis(score, order, 1)
        self.id[which] = np.take_along_axis(number, order, 1)
        self.found[which] = np.take_along_axis(found, order, 1)


def search(query_ids, queries, ids, cells, highs, lows, k: int) -> tuple[Best, int]:
    """The best k rows of a shard for each query, and how many (query, block) pairs were scored."""
    dims = max(queries.shape[1], cells.shape[1])
    queries, cells, highs, lows = (_padded(x, dims) for x in (queries, cells, highs, lows))
    bounds = _products(np.maximum(queries, 0), highs) + _products(np.minimum(queries, 0), lows)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best, scored = Best(len(queries), k), 0
    live = np.arange(len(queries))
    for step in range(bounds.shape[1]):
        block = order[live, step]
        kth, full = best.kth()
        live = live[~full[live] | (bounds[live, block] >= kth[live])]
        if not len(live):
            break
        block = order[live, step]
        for b in np.unique(block):
            which = live[block == b]
            rows = slice(b * BLOCK_ROWS, (b + 1) * BLOCK_ROWS)
            scores = _products(queries[which], cells[rows])
            allowed = ids[rows][None, :] != query_ids[which][:, None]
            best.add(which, scores, ids[rows][None, :], allowed)
            scored += len(which)
    return best, scored


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score``: rows whose id is divisible by ``every`` against all."""
    cells = materialize(quantized(vectors), "search-cells")
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_id = cells.repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id")
    shards = materialize(pack(by_id, SHARD_ROWS).withColumn("shard_key", F.monotonically_increasing_id()), "search-shards")
    chunks = pack(cells.filter(is_query(every)).coalesce(n), CHUNK_ROWS)
    # One row per shard of thousands of vectors: numbering them takes one small task.
    numbers = shards.select("shard_key", F.row_number().over(Window.orderBy("shard_key")).alias("shard"))
    n_shards = shards.count()
    if not n_shards:
        return cells.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    left = chunks.select(
        F.col("ids").alias("query_ids"),
        F.col("dims").alias("query_dims"),
        F.col("rows").alias("query_rows"),
        F.col("cells").alias("query_cells"),
        F.explode(F.sequence(F.lit(1), F.lit(n_shards))).alias("shard"),
    )
    pairs = left.join(shards.join(numbers, "shard_key"), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1).to_pylist()[0]
                dims, rows = pair["dims"], pair["rows"]
                query_ids = np.frombuffer(pair["query_ids"], np.int64)
                best, _ = search(
                    query_ids,
                    _matrix(pair["query_cells"], pair["query_rows"], pair["query_dims"]),
                    np.frombuffer(pair["ids"], np.int64),
                    _matrix(pair["cells"], rows, dims),
                    np.frombuffer(pair["highs"], np.int64).reshape(-1, dims),
                    np.frombuffer(pair["lows"], np.int64).reshape(-1, dims),
                    k,
                )
                query, place = np.nonzero(best.found)
                found = best.id[query, place]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(query_ids[query]),
                        pa.array(found, mask=found == _NO_ID),
                        pa.array(best.score[query, place]),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
