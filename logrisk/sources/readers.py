"""Readers for raw lines, count text and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_list(paths: str | Sequence[str]) -> list[str]:
    """Accept one path, a comma-separated list of paths, or a sequence of paths."""
    if isinstance(paths, str):
        return [part.strip() for part in paths.split(",") if part.strip()]
    return list(paths)


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines as ``value``. Paths may be files, folders or globs."""
    return spark.read.text(path_list(paths)).select("value")


def read_rows(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines as ``value`` with the ``file_path`` they came from."""
    return spark.read.text(path_list(paths)).select("value", "_metadata.file_path")


def read_placed_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines as ``value`` with the ``file_path`` and ``block_start`` they came from, and ``seq``, which
    ascends with the lines of a block, one by one."""
    return spark.read.text(path_list(paths)).select(
        "value",
        "_metadata.file_path",
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table written by this package."""
    return spark.read.parquet(path)


def first_header(spark: SparkSession, paths: str | Sequence[str]) -> str:
    """The first header line (``LineId...``) of structured CSV files.

    Files start with their header, so this reads one split in the usual case.
    """
    lines = read_lines(spark, paths)
    row = lines.filter(lines.value.startswith("LineId")).head()
    if row is None:
        raise ValueError(f"no header line in {paths!r}")
    return row.value
