"""The first line of every file, read without reading the files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from logrisk.sources.readers import path_list, read_table
from logrisk.sources.scratch import scratch_path
from logrisk.sources.writers import write_table

#: Larger than any file that is read, so that a file is one task.
_WHOLE_FILE = 1 << 40
_LINES_AT_A_TIME = 64
_FILES_TO_TASKS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_first_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``value, file_path``: the first line of every file that is not blank, as a stored table.

    A task per file reads up to that line and stops; lines are not shuffled. Files without such a line
    are left out.
    """
    # A session of its own, as the settings that make a file one task hold for a session.
    apart = spark.newSession()
    settings = {name: str(_WHOLE_FILE) for name in _FILES_TO_TASKS}
    for name, value in {**settings, _BATCH: str(_LINES_AT_A_TIME)}.items():
        apart.conf.set(name, value)
    # Where the settings are not taken, tasks read on, as they may hold several files.
    alone = all(apart.conf.get(name) == value for name, value in settings.items())
    lines = apart.read.text(path_list(paths)).select(
        "value", "_metadata.file_path", "_metadata.file_block_start"
    )

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[str] = set()
        for batch in batches:
            for place, (value, path, start) in enumerate(zip(*[column.to_pylist() for column in batch.columns])):
                if start == 0 and path not in done and any(char > " " for char in value):
                    done.add(path)
                    yield batch.slice(place, 1).select([0, 1])
                if alone and (start > 0 or path in done):
                    return

    path = scratch_path(spark, "first-lines")
    write_table(lines.mapInArrow(first, "value string, file_path string"), path)
    return read_table(spark, path)
