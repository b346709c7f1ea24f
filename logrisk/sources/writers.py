"""Writers for records, counts, features and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logrisk.operators.counts import COUNT_KEY, wire_key, wire_text


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Snappy Parquet, replacing what is there; a failed write raises."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def delimited_text(df: DataFrame, separator: str = ",") -> DataFrame:
    """One ``value`` per row: all columns as text, joined without quoting.

    A separator inside a field makes the text ambiguous; prefer ``write_table``.
    """
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in df.columns]
    return df.select(F.concat_ws(separator, *fields).alias("value"))


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    """Records as delimited text, replacing what is there."""
    delimited_text(df, separator).write.mode("overwrite").text(path)


def write_counts(counts: DataFrame, path: str) -> None:
    """Counts as ``date_hour,error_type,source,count`` lines in key order.

    Fails when the path exists. Rows are range-partitioned by the key text, so reading the
    part files in name order gives the whole table in order.
    """
    ordered = counts.orderBy(wire_key())
    ordered.select(*COUNT_KEY, "total_count").select(wire_text()).write.mode("errorifexists").text(path)


def write_classified(classified: DataFrame, path: str) -> None:
    """Parsed and rejected lines in one pass over the input, in one folder per status."""
    write_table(classified, path, "status")
