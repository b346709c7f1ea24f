"""Counts to features and label.

Rows are shuffled twice: by (source, error type, time slice) for what a key's history says, and
by (bucket, part of its error types) for the bucket's total, so no source, bucket or error type
has to fit in one task. What a slice or part holds is first summed up where its rows are; only
these sums meet per key and per bucket, in small shuffles, and are joined back to the rows. Each
shuffle of rows carries its columns as one value, so that all that follows from it reads the same
shuffle, whichever columns the caller needs: the input is read once.

Counts, their sums and the sums of their squares are whole numbers, so they do not depend on the order
in which they are added, and a flag is decided without a division or a root.

A null in a key counts as ``UNKNOWN``, the text the count stage uses as well; counts of equal
keys are added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logrisk.functions.buckets import bucket_hour_number, bucket_hours
from logrisk.operators.counts import COUNT_KEY, UNKNOWN
from logrisk.sources.scratch import materialize

FEATURE_COLUMNS = (
    "date_hour",
    "error_type",
    "source",
    "error_frequency",
    "error_distribution",
    "rate_of_change",
    "high_error_flag",
    "label",
)


@dataclass(frozen=True)
class FeatureParams:
    """Settings of the feature stage.

    ``label_share``: a flagged row is labelled when its share of the bucket is above this.
    ``share_of``: ``source`` relates a frequency to its source's total in the bucket,
    ``cluster`` to the total of all sources.
    ``label_by``: ``rule`` labels the row itself, ``horizon`` labels rows whose key is
    flagged in a bucket that begins within ``horizon_hours`` of their end.
    ``level_of``: a key's usual level is that of its whole ``history``, later buckets included, or that
    ``as_of`` the row: of its buckets up to and including it.
    ``slices``: time slices are made of prefixes of ``date_hour``, or of ranges (``range``) of key and
    ``date_hour`` that hold about as many rows each, whatever the buckets look like; this takes one more
    shuffle and a stored table. Results do not depend on the slices.
    ``slice_chars``: falling lengths of the prefixes; seven characters are a month. (7, 4) adds years, for
    keys with many thousands of different prefixes.
    ``bucket_parts``: parts in which a bucket is totalled, by error type. Results do not depend
    on it.
    """

    label_share: float = 0.40
    share_of: str = "source"
    label_by: str = "rule"
    horizon_hours: int = 2
    level_of: str = "history"
    slices: str = "prefix"
    slice_chars: tuple[int, ...] = (7,)
    bucket_parts: int = 64

    def __post_init__(self) -> None:
        if self.share_of not in ("source", "cluster"):
            raise ValueError(f"share_of: {self.share_of!r}")
        if self.label_by not in ("rule", "horizon"):
            raise ValueError(f"label_by: {self.label_by!r}")
        if self.level_of not in ("history", "as_of"):
            raise ValueError(f"level_of: {self.level_of!r}")
        if self.slices not in ("prefix", "range"):
            raise ValueError(f"slices: {self.slices!r}")
        lengths = (*self.slice_chars, 0)
        if any(longer <= shorter for longer, shorter in zip(lengths, lengths[1:])):
            raise ValueError("slice_chars must be positive and falling")
        if self.horizon_hours < 1 or self.bucket_parts < 1:
            raise ValueError("horizon_hours and bucket_parts must be positive")


def _frequencies(counts: DataFrame) -> DataFrame:
    """Keys without nulls and ``frequency``, a 64-bit whole number; any other number raises when it is read."""
    key = [f"coalesce({name}, '{UNKNOWN}') AS {name}" for name in COUNT_KEY]
    whole = """CASE WHEN total_count IS NULL OR total_count = floor(total_count) THEN CAST(total_count AS bigint)
        ELSE CAST(raise_error('no whole number: ' || total_count) AS bigint) END AS frequency"""
    return counts.selectExpr(*key, whole)


def _dealt(rows: DataFrame, keys: list[str], others: list[str]) -> DataFrame:
    """Rows shuffled by their keys, the other columns as one value that no caller prunes."""
    packed = rows.selectExpr(*keys, f"array(struct({', '.join(others)})) AS row").repartition(*keys)
    return packed.selectExpr(*keys, "inline(row)")


#: What is added up of a stretch of time, and what a row adds to it: rows with a frequency, the frequencies
#: and their squares. A sum of squares beyond 38 digits raises.
_MOMENTS = {
    "n": "CAST(frequency IS NOT NULL AS bigint)",
    "total": "CAST(frequency AS decimal(20,0))",
    "squares": "CAST(frequency AS decimal(20,0)) * CAST(frequency AS decimal(20,0))",
}
_ALL = [f"all_{name}" for name in _MOMENTS]


def _over(by: list[str], order: str, rows: str = "") -> str:
    return f"OVER (PARTITION BY {', '.join(by)} ORDER BY {order} {rows})"


def _key_history(stretches: DataFrame, lengths: tuple[int, ...], as_of: bool) -> DataFrame:
    """Stretches (``source, error_type, slice``, their ``_MOMENTS`` and ``point``, that of their last row)
    with ``handed_on``, the point of the last row before each, and the moments ``all_...`` of the key,
    or of the stretches before this one.

    With more ``lengths`` the stretches of a key are themselves taken in slices.
    """
    key = ["source", "error_type"]
    by = [*key, "outer_slice"] if lengths else key
    if lengths:
        stretches = stretches.selectExpr("*", f"substring(slice, 1, {lengths[0]}) AS outer_slice")
    earlier = _over(by, "slice", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")
    reach = earlier if as_of else f"OVER (PARTITION BY {', '.join(by)})"
    found = stretches.selectExpr(
        *by,
        "slice",
        f"lag(point) {_over(by, 'slice')} AS handed_on",
        *[f"coalesce(sum({name}) {reach}, 0) AS all_{name}" for name in _MOMENTS],
    )
    if not lengths:
        return found
    outer = stretches.groupBy(*key, F.col("outer_slice").alias("slice")).agg(
        *[F.expr(f"sum({name}) AS {name}") for name in _MOMENTS], F.expr("max_by(point, slice) AS point")
    )
    outer = _key_history(outer, lengths[1:], as_of).selectExpr(
        *key, "slice AS outer_slice", "handed_on AS outer_handed_on", *[f"{name} AS outer_{name}" for name in _ALL]
    )
    # What the outer slices before this one hold comes first; of a whole history they know all.
    return found.join(outer, by, "left").selectExpr(
        *key,
        "slice",
        "coalesce(handed_on, outer_handed_on) AS handed_on",
        *[f"outer_{name} + {name if as_of else 0} AS {name}" for name in _ALL],
    )


def _sliced(rows: DataFrame, params: FeatureParams) -> DataFrame:
    """Add ``slice``, which ascends with ``date_hour`` within a key."""
    if params.slices == "prefix":
        length = params.slice_chars[0] if params.slice_chars else 0
        return rows.selectExpr("*", f"substring(date_hour, 1, {length}) AS slice")
    ranged = rows.repartitionByRange("source", "error_type", "date_hour")
    # Stored, as every reader has to see the same ranges.
    return materialize(ranged.withColumn("slice", F.spark_partition_id()), "feature-ranges")


def _with_history(rows: DataFrame, params: FeatureParams) -> DataFrame:
    """Add the moments ``all_...`` of the key, or as of the row, and ``previous``, the frequency in the
    key's preceding bucket, or 0.

    Each row looks back within its slice; the first row of a slice takes what earlier slices hand on.
    """
    keys = ["source", "error_type", "slice"]
    dealt = _dealt(_sliced(rows, params), keys, ["date_hour", "frequency"])
    dealt = dealt.groupBy(*keys, "date_hour").agg(F.expr("sum(frequency) AS frequency"))
    # A struct tells a preceding row without a frequency from no preceding row.
    stretches = dealt.groupBy(*keys).agg(
        *[F.expr(f"sum({term}) AS {name}") for name, term in _MOMENTS.items()],
        F.expr("max_by(struct(frequency), date_hour) AS point"),
    )
    as_of = params.level_of == "as_of"
    so_far = _over(keys, "date_hour", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    own = [f"coalesce(sum({term}) {so_far}, 0) AS own_{name}" for name, term in _MOMENTS.items()] if as_of else []
    inside = f"lag(struct(frequency)) {_over(keys, 'date_hour')} AS inside"
    lengths = params.slice_chars[1:] if params.slices == "prefix" else ()
    return (
        dealt.selectExpr("*", inside, *own)
        .join(_key_history(stretches, lengths, as_of), keys, "left")
        .selectExpr(
            *COUNT_KEY,
            "frequency",
            *([f"all_{name} + own_{name} AS all_{name}" for name in _MOMENTS] if as_of else _ALL),
            """CASE WHEN coalesce(inside, handed_on) IS NULL THEN 0
                ELSE coalesce(inside, handed_on).frequency END AS previous""",
        )
    )


#: True where ``frequency`` is above mean plus sample deviation of ``all_n`` frequencies, given by their sum S and
#: that of their squares Q. Multiplied out, that is ``(n f - S) ** 2 (n - 1) > n (n Q - S ** 2)`` and ``n f > S``, in
#: whole numbers of up to 38 digits. Where a product is longer, the same sums are compared as doubles.
_ABOVE = "try_subtract(try_multiply(CAST(all_n AS decimal(20,0)), CAST(frequency AS decimal(20,0))), all_total)"
_SPREAD = "try_subtract(try_multiply(CAST(all_n AS decimal(20,0)), all_squares), try_multiply(all_total, all_total))"
_EXACT = f"""try_multiply(try_multiply({_ABOVE}, {_ABOVE}), CAST(all_n - 1 AS decimal(20,0)))
    > try_multiply(CAST(all_n AS decimal(20,0)), {_SPREAD})"""
_ROUGH = """CAST(frequency AS double) > try_divide(CAST(all_total AS double), all_n) + sqrt(greatest(0.0D, try_divide(
    CAST(all_squares AS double) - try_divide(CAST(all_total AS double), all_n) * CAST(all_total AS double), all_n - 1)))"""
_IS_HIGH = f"all_n > 1 AND coalesce({_ABOVE} > 0, true) AND coalesce({_EXACT}, {_ROUGH})"


def _with_totals(rows: DataFrame, bucket: list[str], parts: int) -> DataFrame:
    """Add ``bucket_total``. A bucket may hold most of the rows, so it is summed and joined in
    parts, by error type; only the sums of its parts, a bounded number, meet in one group."""
    keys = [*bucket, "part"]
    others = [name for name in rows.columns if name not in keys]
    dealt = _dealt(rows.selectExpr("*", f"pmod(xxhash64(error_type), {parts}) AS part"), keys, others)
    sums = dealt.groupBy(*keys).agg(F.expr("sum(CAST(frequency AS decimal(20,0))) AS part_total"))
    whole = f"sum(part_total) OVER (PARTITION BY {', '.join(bucket)}) AS bucket_total"
    return dealt.join(sums.selectExpr(*keys, whole), keys, "left")


#: The features of a row, with what its history and its bucket say. Nothing to relate to gives no share, and
#: no change.
_MEASURED = (
    "date_hour",
    "error_type",
    "source",
    "CAST(frequency AS double) AS error_frequency",
    "round(try_divide(CAST(frequency AS double), CAST(bucket_total AS double)), 4) AS error_distribution",
    """CASE WHEN previous = 0 THEN 0.0D ELSE round(try_divide(
        CAST(frequency AS double) - CAST(previous AS double), CAST(previous AS double)), 4) END AS rate_of_change""",
    "CASE WHEN high THEN 1 ELSE 0 END AS high_error_flag",
)


def engineer_features(counts: DataFrame, params: FeatureParams = FeatureParams()) -> DataFrame:
    """Counts (``date_hour, error_type, source, total_count``) to ``FEATURE_COLUMNS``.

    Counts are whole numbers; others raise. Unless ``level_of="as_of"``, the usual level of a key
    covers its whole history, later buckets included, and the
    rule label is a function of two features: near-perfect scores on it do not show an
    ability to forecast. ``label_by="horizon"`` gives a target in the future.
    """
    bucket = ["date_hour"] if params.share_of == "cluster" else ["source", "date_hour"]
    rows = _with_history(_frequencies(counts), params)
    rows = rows.selectExpr(*COUNT_KEY, "frequency", "previous", f"{_IS_HIGH} AS high")
    measured = _with_totals(rows, bucket, params.bucket_parts).selectExpr(*_MEASURED)
    if params.label_by == "horizon":
        return label_ahead(measured, params.horizon_hours)
    severe = f"high_error_flag = 1 AND error_distribution > {params.label_share!r}D"
    return measured.selectExpr("*", f"CASE WHEN {severe} THEN 1 ELSE 0 END AS label")


def label_ahead(features: DataFrame, horizon_hours: int) -> DataFrame:
    """Label 1 where the key is flagged in a bucket that begins within ``horizon_hours`` hours of
    the row's end; a day's bucket ends after 24 hours, an hour's after one.

    Flagged rows are copied as marks to the ends that they follow; rows and marks of the same key
    and hour then meet in one shuffle, and the marks are dropped. Buckets that are not times
    get label 0.
    """
    start = bucket_hour_number(F.col("date_hour"))
    end = start + bucket_hours(F.col("date_hour"))
    point = lambda at, mark: F.struct(at.alias("hour"), F.lit(mark).alias("mark"))
    marks = F.transform(
        F.sequence(F.lit(0), F.lit(horizon_hours - 1)), lambda ahead: point(start - ahead, 1)
    )
    flagged = (F.col("high_error_flag") == 1) & start.isNotNull()
    own = F.array(point(end, 0))
    free_form = F.when(F.col("hour").isNull(), F.col("date_hour"))
    meeting = Window.partitionBy("source", "error_type", "hour", free_form)
    return (
        features.drop("label")
        .select("*", F.inline(F.when(flagged, F.concat(own, marks)).otherwise(own)))
        .withColumn("label", F.max("mark").over(meeting))
        .filter("mark = 0")
        .select(*FEATURE_COLUMNS)
    )


def preview_features(features: DataFrame, limit: int = 20) -> DataFrame:
    """The first feature rows in key order, without the label."""
    return (
        features.select(*[name for name in FEATURE_COLUMNS if name != "label"])
        .orderBy("date_hour", "source", "error_type")
        .limit(limit)
    )
