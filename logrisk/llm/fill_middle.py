"""Fill-in-the-middle transformation, with cuts placed by a learned rank index.

A text is cut in units of code points, but lies in memory as bytes. The index maps a unit's number
to the byte at which it begins: the boundary offsets are covered by straight segments, none of which
is off by more than ``MOST_ERROR`` bytes, and what a segment's prediction misses is stored as a
residual of one byte per boundary. A cut is predicted by its segment and put right by its residual,
so it is exact for every text. Texts of one script take one segment; a text is halved where its
scripts change. All texts of a batch are fitted together.

A document becomes ``<P>prefix<S>suffix<M>middle`` (psm), ``<S>suffix<P>prefix<M>middle`` (spm) or stays
``plain``; its id alone decides where it is cut and in which form. A text that holds one of the marks
stays plain, so the marks of an output are its own and the text can be rebuilt from it.

Nulls and odd rows: a null text is empty, and empty texts are plain; a null id draws like the text
``null``. Repeated rows give equal outputs; an empty table gives an empty result. Texts of any
length are cut as a whole. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logrisk.llm.rows import pieces

# The marks, the seed of the draws, and the shares in hundredths.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Most bytes by which a segment may be off; a residual then fits into one signed byte.
MOST_ERROR = 100


@dataclass
class RankIndex:
    """Byte offsets of the boundaries of many texts: segment ``s`` covers the boundaries from
    ``first[s]`` on and predicts ``at[s] + slope[s] * (k - first[s])``."""

    first: np.ndarray
    at: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    def offsets(self, boundaries: np.ndarray) -> np.ndarray:
        """The exact offsets of boundaries, given by their numbers."""
        segment = np.searchsorted(self.first, boundaries, side="right") - 1
        return _predicted(boundaries, self.first[segment], self.at[segment], self.slope[segment]) + self.residuals[boundaries]


def _predicted(k: np.ndarray, first: np.ndarray, at: np.ndarray, slope: np.ndarray) -> np.ndarray:
    return at + np.floor(slope * (k - first)).astype(np.int64)


def fit(offsets: np.ndarray, starts: np.ndarray, most_error: int = MOST_ERROR) -> RankIndex:
    """The index of ascending ``offsets``, where a new text begins at each of ``starts``.

    Each text begins as one segment through its first and last boundary; segments that are off by
    more than ``most_error`` are halved, all of them at once, until none is. A segment of one or two
    boundaries is exact.
    """
    count = len(offsets)
    residuals = np.zeros(count, np.int8)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    first, last = starts, np.append(starts[1:], count) - 1
    while len(first):
        sizes = last - first + 1
        slope = (offsets[last] - offsets[first]) / np.maximum(sizes - 1, 1)
        ends = np.cumsum(sizes)
        k = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
        missed = offsets[k] - _predicted(k, np.repeat(first, sizes), np.repeat(offsets[first], sizes), np.repeat(slope, sizes))
        good = np.maximum.reduceat(np.abs(missed), ends - sizes) <= most_error
        kept = np.repeat(good, sizes)
        residuals[k[kept]] = missed[kept]
        done.append((first[good], offsets[first[good]], slope[good]))
        low, high = first[~good], last[~good]
        middle = (low + high) // 2
        first, last = np.concatenate([low, middle + 1]), np.concatenate([middle, high])
    columns = [np.concatenate(column) for column in zip(*done)] if done else [np.zeros(0, np.int64)] * 3
    order = np.argsort(columns[0])
    return RankIndex(*[column[order] for column in columns], residuals)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column without nulls, and the ``n + 1`` offsets of its texts in them."""
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64, len(column) + 1, 8 * column.offset)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def boundaries(whole: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all boundaries, each text's end included, and where each text's begin. A unit
    begins at every byte that does not continue a code point."""
    units = np.flatnonzero((whole & 0xC0) != 0x80)
    before = np.searchsorted(units, ends)
    starts = before[:-1] + np.arange(len(ends) - 1)
    return np.insert(units, before[1:], ends[1:]).astype(np.int64), starts


_COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string"


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """``doc_id, text, h1, ..., h4`` to ``doc_id`` and ``_COLUMNS``."""
    doc_id, text, *draws = batch.columns
    h1, h2, h3, h4 = [draw.to_numpy() for draw in draws]
    whole, ends = _texts(text)
    offsets, starts = boundaries(whole, ends)
    n = np.diff(np.append(starts, len(offsets))) - 1
    index = fit(offsets, starts)
    one, other = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(one, other), np.maximum(one, other)
    first_cut, second_cut = index.offsets(starts + low), index.offsets(starts + high)
    data = whole.tobytes()
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    for row in range(batch.num_rows):
        a, b = int(ends[row]), int(ends[row + 1])
        plain = data[a:b]
        if a == b or h3[row] % 100 >= PLAIN_FROM or any(mark in plain for mark in marks):
            forms.append("plain")
            outputs.append(plain)
            continue
        prefix, middle, suffix = data[a : first_cut[row]], data[first_cut[row] : second_cut[row]], data[second_cut[row] : b]
        spm = h4[row] % 100 < SPM_BELOW
        forms.append("spm" if spm else "psm")
        parts = [marks[1], suffix, marks[0], prefix] if spm else [marks[0], prefix, marks[1], suffix]
        outputs.append(b"".join([*parts, marks[2], middle]))
    cut = np.array([form != "plain" for form in forms], bool)
    return pa.RecordBatch.from_arrays(
        [
            doc_id,
            pa.array(n, pa.int64()),
            pa.array(forms, pa.string()),
            pa.array(low, pa.int64(), mask=~cut),
            pa.array(high - low, pa.int64(), mask=~cut),
            pa.array(outputs, pa.binary()).cast(pa.string()),
        ],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def transform(documents: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document: its code points, its
    form, the lengths of its first two parts (null if plain), and the transformed text."""
    named = F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    drawn = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.sha2(named, 256).alias("hash")
    )
    draws = [F.conv(F.substring("hash", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = drawn.select("doc_id", "text", *draws)

    def run(batches):
        for batch in batches:
            yield from map(_cut, pieces(batch))

    kind = rows.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *T.StructType.fromDDL(_COLUMNS).fields])
    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda i: F.get(parts, F.lit(i))
    psm, spm = F.concat(part(1), part(3), part(2)), F.concat(part(2), part(3), part(1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
