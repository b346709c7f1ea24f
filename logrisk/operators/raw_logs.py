"""Raw log lines to parsed records, with rejected lines kept aside.

The whole stage is one scan without a shuffle: a line is matched once, its fields are cut
from the match, and the outcome is recorded in ``status``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.functions.text import FIELD_BREAK, evaluate_once, is_blank

PARSED, BLANK, MALFORMED = "parsed", "blank", "malformed"


@dataclass(frozen=True)
class Grammar:
    """A line grammar: one capture group per field, matched against the whole line."""

    name: str
    pattern: str
    fields: tuple[str, ...]


# Field names and line shapes. HDFS: four tokens, a component up to the next
# colon (one blank of the gap when the colon follows it at once), the rest. BGL: two tokens,
# five tokens as one field, two tokens, the rest. No quantifier gives characters back, so
# lines that do not match fail in linear time.
HDFS = Grammar(
    "HDFS",
    r"\A(\S++)\s++(\S++)\s++(\S++)\s++(\S++)"
    r"(?:\s++(?=[^\s:])|(?:\s(?=\s))++(?=\s:))([^:]++):\s*+(.*+)\z",
    ("log_date", "log_time", "pid", "log_level", "component", "message"),
)
BGL = Grammar(
    "BGL",
    r"\A(\S++)\s++(\S++)\s++(\S++\s++\S++\s++\S++\s++\S++\s++\S++)\s++(\S++)\s++(\S++)\s*+(.*+)\z",
    ("alert_flag", "timestamp_raw", "log_date", "node", "component", "message"),
)
GRAMMARS = {grammar.name: grammar for grammar in (HDFS, BGL)}


def _matched_fields(line: Column, grammar: Grammar) -> Column:
    """The captured fields as an array; other lines give an array of another length."""
    groups = FIELD_BREAK.join(f"${i + 1}" for i in range(len(grammar.fields)))
    cut = F.split(F.regexp_replace(line, grammar.pattern, groups), FIELD_BREAK)
    return F.when(~F.contains(line, F.lit(FIELD_BREAK)), cut)


def classify_lines(lines: DataFrame, grammar: Grammar) -> DataFrame:
    """Add ``status`` and the grammar's fields to every line of ``value``.

    Fields are null unless ``status`` is ``parsed``. Other columns are kept.
    """
    matched = F.size("_fields") == len(grammar.fields)
    status = (
        F.when(matched, PARSED).when(is_blank(F.col("value")), BLANK).otherwise(MALFORMED)
    )
    cut = lines.select("*", evaluate_once(_matched_fields(F.col("value"), grammar)).alias("_fields"))
    fields = [
        F.when(matched, F.get("_fields", F.lit(i))).alias(name)
        for i, name in enumerate(grammar.fields)
    ]
    return cut.select(*lines.columns, status.alias("status"), *fields)


@dataclass(frozen=True)
class ParsedLogs:
    """Parsed records, and rejected lines with the reason."""

    records: DataFrame
    rejects: DataFrame


def parsed_records(lines: DataFrame, grammar: Grammar) -> DataFrame:
    """Only the lines that match, as the grammar's fields."""
    cut = lines.select(evaluate_once(_matched_fields(F.col("value"), grammar)).alias("_fields"))
    hits = cut.filter(F.size("_fields") == len(grammar.fields))
    return hits.select(
        *[F.get("_fields", F.lit(i)).alias(name) for i, name in enumerate(grammar.fields)]
    )


def rejected_lines(lines: DataFrame, grammar: Grammar) -> DataFrame:
    """Only the lines that do not match, with ``reason`` blank or malformed."""
    classified = classify_lines(lines, grammar)
    return classified.filter(F.col("status") != PARSED).select(
        "value", F.col("status").alias("reason")
    )


def located_rejects(classified: DataFrame) -> DataFrame:
    """Lines that do not match, with ``reason``, ``file_path`` and ``line_no``, from 1 on.

    ``classified`` is a stored table of all lines of ``read_placed_lines``: how many lines the blocks
    before hold is counted in it. Only a row per block is shuffled; the lines are not.
    """
    block = ["file_path", "block_start"]
    blocks = classified.groupBy(*block).agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*block, "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    rejected = classified.filter(F.col("status") != PARSED).join(blocks, block)
    line_no = F.col("before") + F.col("seq") - F.col("first") + 1
    return rejected.select("value", F.col("status").alias("reason"), "file_path", line_no.alias("line_no"))


def parse_logs(lines: DataFrame, grammar: Grammar) -> ParsedLogs:
    """Records and rejects of raw lines.

    Each of the two is one pass over the input. To store both in a single pass, write
    ``classify_lines`` with ``write_classified``.
    """
    return ParsedLogs(parsed_records(lines, grammar), rejected_lines(lines, grammar))


def with_bgl_details(records: DataFrame) -> DataFrame:
    """Name what the five-token and two-token fields of a BGL record hold.

    The grammar's field names do not say so: ``log_date`` is day, node, time, node and
    kind; ``node`` is the facility and ``component`` the severity.
    """
    tokens = F.split("log_date", r"\s+")
    return records.select(
        "*",
        F.col("component").alias("severity"),
        F.col("node").alias("facility"),
        F.get(tokens, F.lit(1)).alias("node_id"),
        F.get(tokens, F.lit(2)).alias("event_time"),
    )
