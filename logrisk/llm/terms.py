"""Words of texts and the number of texts that hold them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logrisk.llm.rows import pieces

WORD = re.compile(r"\w+")
#: Distinct words that a task counts before it passes them on.
_FLUSH = 200_000


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores; null has none."""
    return WORD.findall((text or "").lower())


def texts_per_word(rows: DataFrame) -> DataFrame:
    """``word, texts, marked``: rows of ``text, mark`` that hold the word, and those of them whose
    ``mark`` is 1. Tasks count in bounded memory and pass on partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marked = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(texts)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.string()),
                    pa.array(texts.values(), pa.int64()),
                    pa.array([marked[word] for word in words], pa.int64()),
                ],
                ["word", "texts", "marked"],
            )
            texts.clear()
            marked.clear()
            return batch

        for batch in batches:
            for piece in pieces(batch):
                for text, mark in zip(*[column.to_pylist() for column in piece.columns]):
                    words = set(words_of(text))
                    texts.update(words)
                    if mark == 1:
                        marked.update(words)
                if len(texts) >= _FLUSH:
                    yield flush()
        yield flush()

    partial = rows.select("text", "mark").mapInArrow(run, "word string, texts long, marked long")
    return partial.groupBy("word").agg(F.sum("texts").alias("texts"), F.sum("marked").alias("marked"))
