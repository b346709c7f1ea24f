"""Mixing sources to target weights by Efraimidis-Spirakis sampling, without Python tasks.

Every source gets a share of words. Whole epochs of a source come first; the fraction that is
left is a weighted sample without replacement: each document draws ``-ln(u) / weight``, the
documents of a source are taken in the order of these keys, and a prefix sum stops at the
budget. The prefix sum never brings a source together in one task: keys are cut into
slices by value, ``KEY_SLICES`` up to the key 1 and as many for each power of e beyond, slices are
totalled, and only rows of one slice of one source are ordered together.

Nulls and odd rows: a null or empty text has size 0 and is taken 0 words; a null source is a
source of its own, ordered last; a null ``doc_id`` draws like any other value. Repeated rows
are documents of their own; with equal keys the shorter comes first. An empty table gives an empty result. Extra columns
are ignored by ``mix_sizes`` and carried by ``mix_documents``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.sources.scratch import materialize

SOURCE_WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MOST_EPOCHS = 2.0
KEY_SLICES = 4096
SEED = "mix-1"
_BITS = 13  # hexadecimal digits of a draw: 52 bits, exact in a double


def word_count(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of letters among the characters, between 0 and 1 and above 0: text full of marks
    and digits is drawn less often."""
    letters = F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))
    return F.coalesce((letters + 1) / (F.length(text) + 1), F.lit(1.0)).cast("double")


def draw_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """The Efraimidis-Spirakis key ``u ** (1 / weight)`` as ``-ln(u) / weight``, smallest first.

    ``u`` follows from the id and the seed alone, so that reruns agree.
    """
    named = F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.conv(F.substring(F.md5(named), 1, _BITS), 16, 10).cast("double")
    u = (digits + 0.5) / F.lit(float(16**_BITS))
    return -F.log(u) / weight


def source_targets(
    totals: DataFrame,
    weights: Sequence[float] = SOURCE_WEIGHTS,
    share: float = TOTAL_SHARE,
    most_epochs: float = MOST_EPOCHS,
) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources by code point, null last, take ``weights`` in turn. A target never exceeds
    ``most_epochs`` times its source's size; what is above goes to the others by weight until
    none is above. That is a common level: sources sorted by cap over weight are capped as long
    as the level of the rest lies above.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    position = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (position + 1).cast("int"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # The first source whose cap lies above its level sets the level of all that follow.
    first = F.when(F.col("fits"), F.struct(F.col("cap") / F.col("weight"), "level"))
    return (
        totals.withColumn("weight", weight)
        .withColumn("cap", most_epochs * F.col("source_size"))
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("level", level)
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("common", F.min(first).over(everything)["level"])
        .withColumn(
            "target",
            F.when(F.col("common").isNull(), F.col("cap")).otherwise(
                F.least(F.col("cap"), F.col("common") * F.col("weight"))
            ),
        )
        .select("source", "source_size", "target")
    )


def sized(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, draw`` of every document."""
    return documents.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        draw_key(F.col("doc_id"), quality_weight(F.col("text")), seed).alias("draw"),
    )


def _slice(draw: Column) -> Column:
    """The slice of a draw, in the order of the draws. Up to 1 slices are even, beyond they widen
    in proportion: of the draws of any quality weight up to 1 a slice holds ``1 / KEY_SLICES`` at most."""
    place = F.when(draw < 1, draw).otherwise(1 + F.log(draw))
    return F.floor(place * KEY_SLICES).cast("int")


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "no_source": F.col("source").isNull(),
            "source_key": F.coalesce("source", F.lit("")),
            "slice": _slice(F.col("draw")),
        }
    )


def slice_starts(rows: DataFrame, **targets) -> DataFrame:
    """Where every slice of every source begins in the source's prefix sum, with the source's
    size and target. The slices of a source grow with the logarithm of its
    largest draw, not with its rows."""
    keys = ["no_source", "source_key"]
    slices = _keyed(rows).groupBy(*keys, "slice").agg(F.sum("size").alias("slice_size"))
    slices = materialize(slices, "mix-slices")
    totals = slices.groupBy(*keys).agg(F.sum("slice_size").alias("source_size"))
    named = F.when(~F.col("no_source"), F.col("source_key")).alias("source")
    shares = source_targets(totals.select(named, "source_size"), **targets).select(
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        "source_size",
        "target",
    )
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slices.withColumn("slice_start", F.coalesce(F.sum("slice_size").over(before), F.lit(0)))
        .drop("slice_size")
        .join(shares, keys)
    )


def mix_sizes(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Take words from rows of ``doc_id, source, size, draw``; other columns are carried.

    Adds ``source_size``, ``target``, ``epochs``, ``drawn`` and ``taken``: whole epochs plus the
    rows whose prefix sum, in the order of their draws, ends nearest to what is left of the
    target. ``starts`` is what ``slice_starts`` gives for the same rows.
    """
    keys = ["no_source", "source_key", "slice"]
    within = Window.partitionBy(*keys).orderBy("draw", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.col("slice_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    return (
        _keyed(rows)
        .join(starts, keys)
        .withColumn("start", start)
        .withColumn("epochs", epochs)
        .withColumn("drawn", 2 * F.col("start") + F.col("size") <= 2 * rest)
        .withColumn("taken", F.col("size") * (F.col("epochs") + F.col("drawn").cast("long")))
        .select(*rows.columns, "source_size", "target", "epochs", "drawn", "taken")
    )


def mix(documents: DataFrame, **targets) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document.

    The texts are read once: sizes and draws are stored, and everything else follows from them.
    """
    rows = materialize(sized(documents), "mix-sizes")
    mixed = mix_sizes(rows, slice_starts(rows, **targets))
    target = F.round("target", 6).alias("target")
    return mixed.select("doc_id", "source", "size", "source_size", target, "taken")


def mix_documents(documents: DataFrame, **targets) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with its own columns.

    Documents without words have nothing to take and are left out. The texts are shuffled once.
    """
    rows = documents.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        draw_key(F.col("doc_id"), quality_weight(F.col("text"))).alias("draw"),
        F.struct("*").alias("row"),
    )
    mixed = mix_sizes(rows, slice_starts(sized(documents), **targets)).filter("taken > 0")
    copies = F.sequence(F.lit(1), F.expr("taken div size").cast("int"))
    return mixed.select("row", F.explode(copies)).select("row.*")
