"""Log lines rendered from the ``events`` table.

Every event becomes one well-formed line of each kind, and by its type one more line that a
parser has to reject or treat specially. Nothing is left out or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Header names of the rendered structured files whose columns are found by name.
HDFS_HEADER = "LineId,Date,Time,Pid,Level,Component,Content"
BGL_HEADER = "LineId,Label,Timestamp,Date,Node,Time,Level,Content"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _at(pattern: str) -> Column:
    return F.date_format("ts", pattern)


def severity() -> Column:
    return (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "signup", "WARN")
        .otherwise("INFO")
    )


def source() -> Column:
    return F.when(F.col("value") < 30, "HDFS").otherwise("BGL")


def event_keys(events: DataFrame) -> DataFrame:
    """Count keys taken from the events themselves."""
    return events.select(
        _at("yyyy-MM-dd HH").alias("date_hour"),
        severity().alias("error_type"),
        source().alias("source"),
    )


def _by_type(**lines: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for event_type, line in lines.items():
        chosen = F.when(F.col("event_type") == event_type, line).otherwise(chosen)
    return chosen


def _lines(events: DataFrame, *lines: Column) -> DataFrame:
    return events.select(F.explode(F.array(*lines)).alias("value"))


def hdfs_lines(events: DataFrame) -> DataFrame:
    """Raw HDFS lines: a good one per event and one to reject per event."""
    start = F.concat_ws(" ", _at("yyMMdd HHmmss"), F.col("user_id"), severity())
    good = F.concat(
        start, F.lit(" svc."), "event_type", F.lit(": value="), "event_id", F.lit(", props "), "props"
    )
    extra = _by_type(
        click=F.lit(" \t "),
        error=F.lit("corrupted"),
        purchase=F.concat(start, F.lit(" no separator")),
        signup=F.concat(F.lit(" "), good),
        view=F.concat(good, F.lit("\u0085")),
    )
    return _lines(events, good, extra)


def bgl_lines(events: DataFrame) -> DataFrame:
    """Raw BGL lines: a good one per event and one more per event.

    The additional line is blank, has eight tokens, or has nine and thus an empty message.
    """
    clock = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    epoch = F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86400 + clock
    node = F.concat(F.lit("R"), "user_id")
    start = F.concat_ws(
        " ",
        F.lit("-"),
        epoch,
        _at("yyyy.MM.dd"),
        node,
        _at("yyyy-MM-dd-HH.mm.ss.SSSSSS"),
        node,
        F.lit("RAS"),
        F.upper("event_type"),
    )
    good = F.concat_ws(" ", start, severity(), F.lit(" props"), "props")
    extra = _by_type(
        click=F.lit("\t"),
        error=start,
        purchase=F.concat_ws(" ", start, severity()),
        signup=F.concat(F.lit(" "), good),
        view=F.concat(good, F.lit("\u0085")),
    )
    return _lines(events, good, extra)


def _quoted_content() -> Column:
    escaped = F.replace(F.col("props"), F.lit('"'), F.lit('""'))
    return F.concat(F.lit('"m, '), "event_type", F.lit(" "), escaped, F.lit('"'))


def _hdfs_row() -> Column:
    return F.concat(
        "event_id",
        _at("',' yyMMdd ,HHmmss,"),
        F.lit('"'),
        "user_id",
        F.lit(',x",x, '),
        severity(),
        F.lit(" ,"),
        _quoted_content(),
    )


def _hdfs_extra_row() -> Column:
    return _by_type(
        click=F.lit("LineId,Date,Time,Pid,x,Level,Content"),
        error=F.lit("1,2"),
        purchase=F.concat(F.lit("7,"), _at("yyMMdd,HHmmss"), F.lit(",q,,,,")),
        signup=F.lit(" \t"),
        view=F.concat(F.lit("8,"), _at("yyMMdd,HHmmss"), F.lit(',p,"x,ERROR,m')),
    )


def _bgl_row() -> Column:
    return F.concat(
        "event_id",
        F.lit(", "),
        severity(),
        F.lit(' ,1,"d,e",'),
        _at("yyyy-MM-dd-HH.mm.ss"),
        F.lit(","),
        _quoted_content(),
    )


def _bgl_extra_row() -> Column:
    """A header, two rows too short, a blank, and a row whose time is only a day."""
    return _by_type(
        click=F.lit("LineId,x"),
        error=F.lit("1,2"),
        purchase=F.lit("7,INFO,1,q,,,"),
        signup=F.lit(""),
        view=F.concat(F.lit("9,DAILY,1,q,"), _at("yyyy-MM-dd"), F.lit(",m")),
    )


def hdfs_rows(events: DataFrame) -> DataFrame:
    """Structured HDFS rows in the positional layout, with their path."""
    rows = _lines(events, _hdfs_row(), _hdfs_extra_row())
    return rows.withColumn("file_path", F.lit("file:/logs/HDFS_logs/part.csv"))


def bgl_rows(events: DataFrame) -> DataFrame:
    """Structured BGL rows in the positional layout, with their path."""
    rows = _lines(events, _bgl_row(), _bgl_extra_row())
    return rows.withColumn("file_path", F.lit("file:/logs/bgl_logs/part.csv"))


def mixed_rows(events: DataFrame) -> DataFrame:
    """Rows of both sources and of an unknown one, with the ``folder`` they belong to.

    Each event is written to the folder of its source; signups are written to a folder of
    no known source as well.
    """
    known = F.struct(
        F.when(source() == "HDFS", _hdfs_row()).otherwise(_bgl_row()).alias("value"),
        F.when(source() == "HDFS", "hdfs_logs").otherwise("bgl_logs").alias("folder"),
    )
    other = F.struct(F.concat("event_id", F.lit(",?")).alias("value"), F.lit("other").alias("folder"))
    both = F.when(F.col("event_type") == "signup", F.array(known, other)).otherwise(F.array(known))
    return events.select(F.inline(both))


def header_rows(events: DataFrame) -> DataFrame:
    """Structured rows of both sources laid out as ``HDFS_HEADER`` and ``BGL_HEADER``.

    HDFS days have lost leading zeros, as in a numeric column.
    """
    hdfs = F.concat(
        "event_id",
        F.lit(","),
        _at("yyMMdd").cast("int"),
        F.lit(","),
        _at("HHmmss").cast("int"),
        F.lit(",1,"),
        severity(),
        F.lit(',"c,d",'),
        _quoted_content(),
    )
    bgl = F.concat(
        "event_id",
        _at("',-,1,'yyyy.MM.dd',n,'yyyy-MM-dd-HH.mm.ss','"),
        severity(),
        F.lit(","),
        _quoted_content(),
    )
    is_hdfs = source() == "HDFS"
    return events.select(
        F.when(is_hdfs, hdfs).otherwise(bgl).alias("value"),
        F.when(is_hdfs, "/logs/hdfs_logs/a.csv").otherwise("/logs/bgl_logs/a.csv").alias("file_path"),
    )


# The same columns in another order, as a second file of the source has them.
MOVED_HDFS_HEADER = "LineId,Level,Date,Pid,Time,Content,Component"


def moved_columns(rows: DataFrame) -> DataFrame:
    """Rows of ``header_rows``, of which those of HDFS with an odd line number stand in a second
    file, whose columns are in the order of ``MOVED_HDFS_HEADER``."""
    field = lambda i: F.get(F.split("value", ","), F.lit(i))
    moved = F.concat_ws(",", field(0), field(4), field(1), field(3), field(2), F.lit("m"))
    second = F.col("file_path").contains("hdfs") & (field(0).cast("bigint") % 2 == 1)
    return rows.select(
        F.when(second, moved).otherwise(F.col("value")).alias("value"),
        F.when(second, "/logs/hdfs_logs/b.csv").otherwise(F.col("file_path")).alias("file_path"),
    )


def header_lines(spark: SparkSession) -> DataFrame:
    """The header of each file of ``moved_columns``."""
    heads = [
        (HDFS_HEADER, "/logs/hdfs_logs/a.csv"),
        (MOVED_HDFS_HEADER, "/logs/hdfs_logs/b.csv"),
        (BGL_HEADER, "/logs/bgl_logs/a.csv"),
    ]
    return spark.createDataFrame(heads, "value string, file_path string")


def odd_time_rows(events: DataFrame) -> DataFrame:
    """HDFS rows in the order of ``HDFS_HEADER`` with odd days and clocks, by event type."""
    day, clock = _at("yyMMdd"), _at("HHmmss")
    odd = _by_type(
        click=F.concat(F.lit(","), clock),
        error=F.concat(F.lit("n/a,"), clock),
        purchase=F.concat(day, F.lit(",")),
        signup=F.concat(day, F.lit(",7")),
        view=F.concat(day.cast("int").cast("string"), F.lit(",x")),
    )
    value = F.concat_ws(",", F.col("event_id"), odd, F.lit("1"), severity(), F.lit("c,m"))
    return events.select(value.alias("value"), F.lit("/logs/hdfs_logs/a.csv").alias("file_path"))


def awkward_keys(events: DataFrame) -> DataFrame:
    """Count keys whose types hold commas and quotes."""
    error_type = _by_type(
        click=F.lit('"a,b"'), error=F.lit("x,,y,"), purchase=F.lit(",z"), signup=F.lit("7,HDFS,9"), view=F.lit("plain")
    )
    return events.select(_at("yyyy-MM-dd HH").alias("date_hour"), error_type.alias("error_type"), source().alias("source"))


def wire_lines(events: DataFrame) -> DataFrame:
    """Two count lines per event; by its type the count is whole, or none that is accepted."""
    count = _by_type(
        click=F.col("event_id").cast("string"),
        error=F.lit("NaN"),
        purchase=F.lit("Infinity"),
        signup=F.lit("-1"),
        view=F.lit("2.5"),
    )
    other = _by_type(
        click=F.concat("event_id", F.lit("d")),
        error=F.lit("0x1p3"),
        purchase=F.lit("1e3"),
        signup=F.lit("-0"),
        view=F.lit("9223372036854775808"),
    )
    key = F.concat_ws(",", _at("yyyy-MM-dd HH"), severity(), F.concat(F.lit("S"), "event_id"))
    short = F.when(F.col("event_type") == "view", F.lit("a,b,3"))
    empty = F.when(F.col("event_type") == "click", F.concat(F.lit(",,,"), "event_id"))
    written = F.array(F.concat_ws(",", key, count), F.concat_ws(",", key, other), short, empty)
    return events.select(F.explode(F.array_compact(written)).alias("value"))


def large_wire_lines(events: DataFrame) -> DataFrame:
    """A count line per event, whose count is its id above 2 to the power of 53."""
    count = F.lit(1 << 53) + F.col("event_id")
    value = F.concat_ws(",", _at("yyyy-MM-dd HH"), severity(), F.concat(F.lit("S"), "event_id"), count)
    return events.select(value.alias("value"))


def own_header_files(events: DataFrame) -> DataFrame:
    """Rows of ``moved_columns`` as files with a header each: ``folder, part, value``, sorted so that a file
    begins with its header. Odd parts of HDFS have their columns in the order of ``MOVED_HDFS_HEADER``."""
    rows = moved_columns(header_rows(events))
    is_hdfs = F.col("file_path").contains("hdfs")
    body = rows.select(
        F.when(is_hdfs, "hdfs_logs").otherwise("bgl_logs").alias("folder"),
        (F.split("value", ",")[0].cast("bigint") % 4).alias("part"),
        F.lit(1).alias("after"),
        "value",
    )
    moved = F.when(F.col("part") % 2 == 1, MOVED_HDFS_HEADER).otherwise(HDFS_HEADER)
    header = F.when(F.col("folder") == "hdfs_logs", moved).otherwise(BGL_HEADER)
    heads = body.select("folder", "part").distinct().select("folder", "part", F.lit(0).alias("after"), header.alias("value"))
    return body.unionByName(heads).repartition("folder", "part").sortWithinPartitions("folder", "part", "after").drop("after")
