"""Time buckets: text slices that order lexically, plus their typed form."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BucketStyle:
    """How time tokens become buckets.

    ``hourly_hdfs`` adds the hour to HDFS buckets, which are days by default.
    ``separator`` stands between day and hour.
    """

    hourly_hdfs: bool = False
    separator: str = " "


def compact_day(token: Column) -> Column:
    """``yyMMdd...`` to ``20yy-MM-dd``; shorter tokens are kept as they are."""
    day = F.concat(
        F.lit("20"),
        F.substring(token, 1, 2),
        F.lit("-"),
        F.substring(token, 3, 2),
        F.lit("-"),
        F.substring(token, 5, 2),
    )
    return F.when(F.length(token) >= 6, day).otherwise(token)


def restore_zeros(token: Column) -> Column:
    """Six digits from one to five, as a numeric column loses leading zeros; others unchanged."""
    return F.when(token.rlike(r"\A[0-9]{1,5}\z"), F.lpad(token, 6, "0")).otherwise(token)


def compact_hour(day_token: Column, time_token: Column, separator: str) -> Column:
    """``yyMMdd`` and ``HHmmss`` to ``20yy-MM-dd<separator>HH``; where either is shorter, the day
    token is kept as it is."""
    hour = F.concat_ws(separator, compact_day(day_token), F.substring(time_token, 1, 2))
    whole = (F.length(day_token) >= 6) & (F.length(time_token) >= 6)
    return F.when(whole, hour).otherwise(day_token)


def dashed_hour(token: Column, separator: str) -> Column:
    """``yyyy-MM-dd-HH...`` to ``yyyy-MM-dd<separator>HH``; keeps tokens under 13 characters."""
    hour = F.concat_ws(separator, F.substring(token, 1, 10), F.substring(token, 12, 2))
    return F.when(F.length(token) >= 13, hour).otherwise(token)


def bucket_timestamp(date_hour: Column) -> Column:
    """The bucket start as a timestamp without time zone; null for free-form buckets."""
    text = F.when(
        date_hour.rlike(r"\A\d{4}-\d\d-\d\d.\d\d\z"),
        F.concat(F.substring(date_hour, 1, 10), F.lit(" "), F.substring(date_hour, 12, 2), F.lit(":00:00")),
    ).when(date_hour.rlike(r"\A\d{4}-\d\d-\d\d\z"), date_hour)
    return text.try_cast("timestamp_ntz")


def bucket_hour_number(date_hour: Column) -> Column:
    """Whole hours from 1970-01-01 00:00 to the bucket start; null for free-form buckets."""
    start = bucket_timestamp(date_hour)
    return F.unix_date(start.cast("date")).cast("bigint") * 24 + F.hour(start)


def bucket_hours(date_hour: Column) -> Column:
    """Length of a bucket in hours: 24 for a day, 1 otherwise."""
    return F.when(F.length(date_hour) == 10, 24).otherwise(1)
