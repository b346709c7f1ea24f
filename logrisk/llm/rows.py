"""Run a row function over Arrow batches, within Spark's partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows and bytes of input that are turned into Python objects at a time.
PIECE_ROWS = 256
PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that are small enough to hold as Python objects; a long row is alone."""
    start = 0
    step = max(1, min(PIECE_ROWS, int(batch.num_rows * PIECE_BYTES / max(1, batch.nbytes))))
    while start < batch.num_rows:
        yield batch.slice(start, step)
        start += step


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: StructType) -> DataFrame:
    """``make()`` is called once a task and gives a function from lists of column values, in
    the order of ``df``, to lists of output columns."""
    arrow = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in pieces(batch):
                columns = work(*[column.to_pylist() for column in piece.columns])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, field.type) for values, field in zip(columns, arrow)], schema=arrow
                )

    return df.mapInArrow(run, schema)
