"""Structured rows and parsed records to counts per (bucket, error type, source).

Counting combines in every task before the only shuffle, so the shuffled volume depends on
the number of distinct keys per task and not on the number of lines; a hot key arrives as
one partial count per task.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logrisk.functions.buckets import (
    BucketStyle,
    compact_day,
    compact_hour,
    dashed_hour,
    restore_zeros,
)
from logrisk.functions.text import (
    csv_tokens,
    evaluate_once,
    evaluate_struct_once,
    is_blank,
    trim_text,
)

COUNT_KEY = ("date_hour", "error_type", "source")

COUNTED, HEADER, BLANK, SHORT = "counted", "header", "blank", "short"
BAD_COUNT, EMPTY_KEY = "bad_count", "empty_key"

#: Files whose layouts are broadcast at most, a quarter of a kilobyte each.
MOST_LAYOUTS = 200_000
#: Parts into which the lines of a file are dealt where there are more files.
_PARTS_OF_A_FILE = 64


@dataclass(frozen=True)
class CsvLayout:
    """Token positions in the structured rows of both sources.

    ``hdfs_time`` is read for hourly HDFS buckets only. ``pad_hdfs`` restores leading zeros
    that numeric day and time columns have lost.
    """

    hdfs_day: int
    hdfs_time: int
    hdfs_type: int
    bgl_time: int
    bgl_type: int
    pad_hdfs: bool = False


# The positions used unless a header says otherwise.
POSITIONAL = CsvLayout(hdfs_day=1, hdfs_time=2, hdfs_type=5, bgl_time=4, bgl_type=1)

# Markers in the lower-cased path that tell the source, first match wins.
SOURCE_MARKERS = (("hdfs_logs", "HDFS"), ("bgl_logs", "BGL"))
UNKNOWN = "UNKNOWN"


# The columns that are looked for by name, with the layout's field for each.
HDFS_COLUMNS = {"hdfs_day": "Date", "hdfs_time": "Time", "hdfs_type": "Level"}
BGL_COLUMNS = {"bgl_time": "Time", "bgl_type": "Level"}


def header_layout(hdfs_header: str | None = None, bgl_header: str | None = None) -> CsvLayout:
    """Positions by column name: Date, Time, Level for HDFS and Time, Level for BGL.

    A source without a header keeps its ``POSITIONAL`` columns.
    """
    found = {}
    for header, columns in ((hdfs_header, HDFS_COLUMNS), (bgl_header, BGL_COLUMNS)):
        if header is not None:
            names = [name.strip() for name in header.split(",")]
            found.update({field: names.index(name) for field, name in columns.items()})
    return replace(POSITIONAL, **found, pad_hdfs=hdfs_header is not None)


def file_layouts(lines: DataFrame) -> DataFrame:
    """``file_path`` and the positions that each file's own first header (``LineId...``) gives.

    Files without a header, and columns that it does not name, keep their ``POSITIONAL`` place.
    One row per file; only header lines are shuffled. Of stored files, ``read_first_lines`` gives
    the lines that are needed.
    """
    headers = lines.filter(F.col("value").startswith("LineId"))
    headers = headers.select("file_path", "value", F.monotonically_increasing_id().alias("_place"))
    first = headers.groupBy("file_path").agg(F.min_by("value", "_place").alias("header"))
    names = F.transform(F.split("header", ","), lambda name: F.trim(name))
    place = lambda field, name: F.coalesce(
        F.nullif(F.array_position(names, name), F.lit(0)) - 1, F.lit(getattr(POSITIONAL, field))
    )
    wanted = {**HDFS_COLUMNS, **BGL_COLUMNS}
    places = [place(field, name).cast("int").alias(field) for field, name in wanted.items()]
    return first.select("file_path", *places, F.lit(True).alias("pad_hdfs"))


def source_of(path: Column) -> Column:
    """The source a file belongs to, by the marker in its path."""
    lowered = F.lower(path)
    source = F.lit(UNKNOWN)
    for marker, name in reversed(SOURCE_MARKERS):
        source = F.when(lowered.contains(marker), name).otherwise(source)
    return source


def _with_layout(lines: DataFrame, layout: CsvLayout | DataFrame) -> DataFrame:
    """Lines with one ``layout`` for all, or with that of their file.

    The layouts are looked up where the lines are read. Where there are too many files for that, the
    lines of a file are dealt over a fixed number of parts.
    """
    if isinstance(layout, CsvLayout):
        fields = [F.lit(value).alias(name) for name, value in asdict(layout).items()]
        return lines.withColumn("layout", F.struct(*fields))
    known = layout.select(F.col("file_path"), F.struct(*asdict(POSITIONAL)).alias("own"))
    usual = F.struct(*[F.lit(value).alias(name) for name, value in asdict(POSITIONAL).items()])
    if known.count() <= MOST_LAYOUTS:
        joined = lines.join(F.broadcast(known), "file_path", "left")
    else:
        part = F.pmod(F.xxhash64("value"), F.lit(_PARTS_OF_A_FILE)).cast("int")
        copies = known.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS_OF_A_FILE - 1))))
        joined = lines.withColumn("_part", part).join(copies, ["file_path", "_part"], "left").drop("_part")
    return joined.withColumn("layout", F.coalesce("own", usual)).drop("own")


def classify_rows(
    lines: DataFrame, layout: CsvLayout | DataFrame = POSITIONAL, style: BucketStyle = BucketStyle()
) -> DataFrame:
    """Structured CSV lines (``value``, ``file_path``) to count keys and a ``status``.

    ``layout`` holds for all lines, or is a table of ``file_layouts``. Headers are skipped
    wherever they occur. Rows of an unknown source are counted under ``UNKNOWN``; rows with too
    few tokens are ``short``. Keys are null unless ``counted``.
    """
    tokens = _with_layout(lines, layout).select(
        "value",
        "layout",
        source_of(F.col("file_path")).alias("source"),
        evaluate_once(csv_tokens(F.col("value"))).alias("_tokens"),
    )
    is_hdfs, is_bgl = F.col("source") == "HDFS", F.col("source") == "BGL"
    by_source = lambda hdfs, bgl: F.when(is_hdfs, hdfs).when(is_bgl, bgl)
    at = lambda field: F.col("layout").getField(field)
    token = lambda field: F.get("_tokens", at(field))

    hdfs_needs = ["hdfs_day", "hdfs_type"] + ["hdfs_time"] * style.hourly_hdfs
    last_needed = by_source(
        F.greatest(*map(at, hdfs_needs)), F.greatest(at("bgl_time"), at("bgl_type"))
    )
    status = (
        F.when(F.col("value").startswith("LineId"), HEADER)
        # A blank line has no comma, so only one-token lines need the test.
        .when((F.size("_tokens") == 1) & is_blank(F.col("value")), BLANK)
        .when(F.size("_tokens") <= last_needed, SHORT)
        .otherwise(COUNTED)
    )
    picked = evaluate_struct_once(
        status=status,
        _pad=at("pad_hdfs"),
        _time=trim_text(by_source(token("hdfs_day"), token("bgl_time"))),
        _clock=trim_text(F.when(is_hdfs, token("hdfs_time")))
        if style.hourly_hdfs
        else F.lit(None).cast("string"),
        _type=trim_text(by_source(token("hdfs_type"), token("bgl_type"))),
    )
    time = F.col("_time")
    padded = lambda column: F.when(F.col("_pad"), restore_zeros(column)).otherwise(column)
    day = padded(time)
    hdfs_bucket = (
        compact_hour(day, padded(F.col("_clock")), style.separator)
        if style.hourly_hdfs
        else compact_day(day)
    )
    date_hour = by_source(hdfs_bucket, dashed_hour(time, style.separator)).otherwise(UNKNOWN)
    error_type = by_source(F.col("_type"), F.col("_type")).otherwise(UNKNOWN)
    counted = F.col("status") == COUNTED
    return tokens.select("value", "source", picked).select(
        "value",
        "status",
        F.when(counted, date_hour).alias("date_hour"),
        F.when(counted, error_type).alias("error_type"),
        "source",
    )


def count_keys(keyed: DataFrame) -> DataFrame:
    """Rows per (date_hour, error_type, source)."""
    return keyed.groupBy(*COUNT_KEY).agg(F.count("*").alias("total_count"))


def count_errors(
    lines: DataFrame, layout: CsvLayout | DataFrame = POSITIONAL, style: BucketStyle = BucketStyle()
) -> DataFrame:
    """Structured CSV lines (``value``, ``file_path``) to counts."""
    rows = classify_rows(lines, layout, style)
    return count_keys(rows.filter(F.col("status") == COUNTED))


def count_rejects(classified: DataFrame) -> DataFrame:
    """``value, source, reason, total_lines``: the rows that are not counted, equal ones once.

    They meet by a digest, so that the shuffle's key is short however long the lines are.
    """
    rejected = classified.filter(F.col("status") != COUNTED)
    digest = F.md5(F.coalesce("value", F.lit("")))
    groups = rejected.groupBy("source", F.col("status").alias("reason"), digest.alias("digest"))
    found = groups.agg(F.any_value("value").alias("value"), F.count("*").alias("total_lines"))
    return found.select("value", "source", "reason", "total_lines")


def rejected_rows(
    lines: DataFrame, layout: CsvLayout | DataFrame = POSITIONAL, style: BucketStyle = BucketStyle()
) -> DataFrame:
    """Lines that are not counted, with ``reason`` header, blank or short."""
    rows = classify_rows(lines, layout, style)
    return rows.filter(F.col("status") != COUNTED).select(
        "value", "source", F.col("status").alias("reason")
    )


def record_keys(records: DataFrame, source: str, style: BucketStyle = BucketStyle()) -> DataFrame:
    """Count keys straight from parsed records, without a structured file between.

    HDFS needs ``log_date, log_time, log_level``; BGL the columns of ``with_bgl_details``.
    """
    if source == "HDFS":
        day, time, error_type = F.col("log_date"), F.col("log_time"), F.col("log_level")
        bucket = compact_hour(day, time, style.separator) if style.hourly_hdfs else compact_day(day)
    else:
        bucket, error_type = dashed_hour(F.col("event_time"), style.separator), F.col("severity")
    return records.select(
        bucket.alias("date_hour"), error_type.alias("error_type"), F.lit(source).alias("source")
    )


def wire_key() -> Column:
    """The composite key as one text; its byte order is the order of the count files. A null in
    it is ``UNKNOWN``."""
    return F.concat_ws(",", *[F.coalesce(F.col(name), F.lit(UNKNOWN)) for name in COUNT_KEY])


def wire_text() -> Column:
    """A count as ``date_hour,error_type,source,count``."""
    return F.concat_ws(",", wire_key(), F.col("total_count").cast("string")).alias("value")


def first_counts(counts: DataFrame, limit: int = 20) -> DataFrame:
    """The first count lines in key order."""
    return counts.select(*COUNT_KEY, "total_count").orderBy(wire_key()).limit(limit)


def classify_wire(lines: DataFrame) -> DataFrame:
    """Count lines (``value``) to typed columns and a ``status``.

    The bucket ends at the first comma and the count begins after the last; before that stands
    the source, and what is left, commas included, is the error type. Lines with fewer than four
    fields are ``short``; those whose count is not made of digits only, or does not fit into 64 bits, are
    ``bad_count``; those of which bucket, type and source are all empty are ``empty_key``.
    """
    fields = lines.select("value", evaluate_once(F.split("value", ",")).alias("_fields"))
    size = F.size("_fields")
    count = F.get("_fields", size - 1)
    typed = fields.select(
        "value",
        F.get("_fields", F.lit(0)).alias("date_hour"),
        F.array_join(F.slice("_fields", 3, F.greatest(size - 4, F.lit(0))), ",").alias("_tail"),
        F.get("_fields", F.lit(1)).alias("_head"),
        F.get("_fields", size - 2).alias("source"),
        F.when(count.rlike(r"\A[0-9]+\z"), count.try_cast("bigint")).alias("total_count"),
        size.alias("_size"),
    )
    nothing = (F.col("_size") == 4) & (F.concat("date_hour", "_head", "source") == "")
    status = (
        F.when(F.col("_size") < 4, SHORT)
        .when(F.col("total_count").isNull(), BAD_COUNT)
        .when(nothing, EMPTY_KEY)
        .otherwise(COUNTED)
    )
    error_type = F.when(F.col("_size") > 4, F.concat_ws(",", "_head", "_tail")).otherwise(F.col("_head"))
    whole = F.col("_size") >= 4
    key = {"date_hour": F.col("date_hour"), "error_type": error_type, "source": F.col("source")}
    return typed.select(
        "value",
        status.alias("status"),
        *[F.when(whole, column).alias(name) for name, column in key.items()],
        F.when(whole, F.col("total_count")).alias("total_count"),
    )


def parse_wire(lines: DataFrame) -> DataFrame:
    """Count lines to counts, 64-bit whole numbers, leaving out lines that do not hold one."""
    rows = classify_wire(lines).filter(F.col("status") == COUNTED)
    return rows.select(*COUNT_KEY, "total_count")
