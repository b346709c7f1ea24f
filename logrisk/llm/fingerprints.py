"""I-Match fingerprints over randomised lexicons, in DataFrame functions only.

The lexicon holds the terms whose inverse document frequency ``ln(N / df)`` lies in
``IDF_BAND``. A text keeps its distinct terms of the lexicon, sorted; each of ``FAMILIES`` random
orders of the lexicon gives nested subsets that hold one term in 2, 8, 32, 128 and 512, and the
sorted terms of the text in a subset are hashed to one component. Large subsets agree only for
texts that are the same but for a few terms; small ones pick single terms, so that the share of
equal components falls gradually with the share of common terms. Subsets without a term of either
text say nothing and do not count; ``likeness`` is the largest share of the five sizes. A text
without any term of the lexicon has its own hash instead.

The lexicon's size has a bound that does not depend on the number of texts: a term in the band
stands in at least ``exp(-highest idf)`` of them, so there are at most ``exp(highest idf)`` times
the average number of distinct terms. It is broadcast after its size is checked against
``MOST_BROADCAST`` and joined by a shuffle beyond.

``edit_pairs`` gives every text its successor in descending ``doc_id`` order (null last, equal ids
by the text's hash, the first after the last). Rows are dealt into blocks of neighbouring ids, whose bounds are
quantiles; the first row of each block is added to the block before it. Texts are shuffled once.

A null text counts as empty; repeated rows are each other's successors; a lone text is its own.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.sources.scratch import materialize

#: Terms in at most a fifth and at least a thousandth of the texts.
IDF_BAND = (math.log(5), math.log(1000))
FAMILIES = 12
#: A subset of step s holds the terms whose draw of 16 bits is below 65536 >> STEPS[s].
STEPS = (1, 3, 5, 7, 9)
MOST_BROADCAST = 4_000_000
ZONES = 64
_BLOCKS_PER_PARTITION = 4
_LEVEL_BITS = 3
_CODE_BITS = FAMILIES * _LEVEL_BITS
#: A component is the polynomial of the sorted ranks in ``_FACTOR``; ``_FIRST`` lies outside its range.
_FIRST, _FACTOR, _MODULUS = 1 << 31, 1_000_003, (1 << 31) - 1


def terms(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits."""
    runs = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_remove(F.array_distinct(runs), "")


def lexicon(documents: DataFrame) -> DataFrame:
    """``term, packed``: rank in the sorted lexicon and the term's subsets, in one number.

    The empty term stands for the text itself and is in no subset.
    """
    words = documents.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("df"))
    low, high = IDF_BAND
    n = F.lit(float(documents.count()))
    idf = F.log(n / F.col("df"))
    kept = materialize(counts.filter((idf >= low) & (idf <= high)).select("term"), "lexicon-terms")
    digits = F.sha2(F.col("term").cast("binary"), 256)
    code = F.lit(0).cast("long")
    for family in range(FAMILIES):
        draw = F.conv(F.substring(digits, 4 * family + 1, 4), 16, 10).cast("long")
        level = sum((draw < (65536 >> step)).cast("long") for step in STEPS)
        code = code + F.shiftleft(level, family * _LEVEL_BITS)
    # At most as many rows as the bound above allows are numbered in one task.
    rank = F.row_number().over(Window.orderBy("term")).cast("long")
    ranked = kept.select("term", (F.shiftleft(rank, _CODE_BITS) + code).alias("packed"))
    nothing = documents.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(0).cast("long").alias("packed"))
    return materialize(ranked.union(nothing), "lexicon")


def fingerprinted(texts: DataFrame, words: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """``keys, carried, fingerprint`` of rows of ``keys, carried, text``; the keys name a row.

    Where the rows are partitioned by some of the keys they stay so, and nothing is shuffled.
    """
    if words.count() <= MOST_BROADCAST:
        words = F.broadcast(words)
    # Two steps: what stands beside an explode in one select is computed for each of its rows.
    held = texts.select(
        *keys, *carried, F.md5("text").alias("text_hash"), F.array_append(terms(F.col("text")), "").alias("terms")
    )
    spread = held.select(*keys, *carried, "text_hash", F.explode("terms").alias("term"))
    found = spread.join(words, "term").groupBy(*keys)
    found = found.agg(
        *[F.any_value(name).alias(name) for name in [*carried, "text_hash"]],
        F.array_sort(F.array_remove(F.collect_list("packed"), 0)).alias("packed"),
    )

    def members(packed: str, family: int, step: int) -> Column:
        shift = family * _LEVEL_BITS
        return F.filter(packed, lambda x: F.shiftright(x, shift).bitwiseAND(7) > step)

    def hashed(packed: str) -> Column:
        rank = lambda x: F.shiftright(x, _CODE_BITS)
        total = F.aggregate(packed, F.lit(_FIRST), lambda sum_, x: (sum_ * _FACTOR + rank(x)) % _MODULUS)
        return F.when(total == _FIRST, "").otherwise(total.cast("string"))

    # Subsets are nested, so each is cut from the one before.
    for step in range(len(STEPS)):
        before = {family: "packed" if step == 0 else f"in_{family}_{step - 1}" for family in range(FAMILIES)}
        found = found.withColumns(
            {f"in_{family}_{step}": members(before[family], family, step) for family in range(FAMILIES)}
        )
    sizes = [
        F.concat_ws(".", *[hashed(f"in_{family}_{step}") for family in range(FAMILIES)])
        for step in range(len(STEPS))
    ]
    whole = F.when(F.size("packed") > 0, F.concat_ws("/", *sizes)).otherwise(F.concat(F.lit("="), "text_hash"))
    return found.select(*keys, *carried, whole.alias("fingerprint"))


def likeness(one: Column, other: Column) -> Column:
    """1 for equal fingerprints; else the largest share, over the sizes of subsets, of equal
    components among those that hold a term of either text (and one more, so that few say little)."""
    sizes = F.arrays_zip(F.split(one, "/").alias("a"), F.split(other, "/").alias("b"))

    def share(size: Column) -> Column:
        pairs = F.arrays_zip(F.split(size["a"], r"\.").alias("a"), F.split(size["b"], r"\.").alias("b"))
        told = F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != ""))
        return F.size(F.filter(told, lambda p: p["a"] == p["b"])) / (F.size(told) + 1).cast("double")

    unlike = one.startswith("=") | other.startswith("=")
    return F.when(one == other, F.lit(1.0)).when(unlike, F.lit(0.0)).otherwise(F.array_max(F.transform(sizes, share)))


def _block(doc_id: Column, bounds: list[int], parts: int) -> Column:
    """Number of the block of neighbouring ids: a zone between two quantiles, found by halving,
    and one of its ``parts`` of equal width."""

    def halve(low: int, high: int) -> Column:
        if high - low == 1:
            # Doubles round, but never against the order of the ids.
            width = float(bounds[high] - bounds[low])
            part = F.floor((doc_id.cast("double") - float(bounds[low])) * parts / width)
            return F.lit(low * parts) + F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1))
        middle = (low + high) // 2
        return F.when(doc_id < bounds[middle], halve(low, middle)).otherwise(halve(middle, high))

    return halve(0, len(bounds) - 1)


def edit_pairs(documents: DataFrame) -> DataFrame:
    """``block, place, doc_id, text, next_text, extra`` of every text, with its successor's.

    Rows with ``extra`` repeat the first text of the following block and have no successor.
    Partitioned by ``block``, ordered by ``place``.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-partitions * _BLOCKS_PER_PARTITION // ZONES))
    shares = [i / ZONES for i in range(1, ZONES)]
    least, most, cuts = documents.agg(
        F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", shares, 10_000)
    ).first()
    bounds = sorted({least or 0, *(cuts or [])}) + [(0 if most is None else most) + 1]
    hashed = F.md5(F.coalesce("text", F.lit("")))
    # Texts without an id come last, in the order of their hashes.
    unnamed = -1 - F.conv(F.substring("hash", 1, 4), 16, 10).cast("long") * ZONES * parts / 65536
    rows = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), hashed.alias("hash"))
        .withColumn(
            "block",
            F.when(F.col("doc_id").isNull(), F.floor(unnamed)).otherwise(_block(F.col("doc_id"), bounds, parts)),
        )
        .withColumn("order", F.struct(F.col("doc_id").isNull(), F.bitwise_not("doc_id"), "hash"))
    )
    small = rows.groupBy("block").agg(F.min("order").alias("first"))
    small = materialize(small, "fingerprint-blocks")
    in_order = Window.orderBy("first")
    all_blocks = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("block").over(in_order), F.last("block").over(all_blocks))
    # One row per block, and there are as many blocks as the setting of partitions makes.
    small = small.select(F.col("block").alias("own"), "first", before.alias("before"))
    placed = rows.join(F.broadcast(small), F.col("block") == F.col("own")).select(
        "doc_id",
        "text",
        "order",
        F.explode(
            F.when(
                F.col("order") == F.col("first"),
                F.array(_stand(F.col("block"), False), _stand(F.col("before"), True)),
            ).otherwise(F.array(_stand(F.col("block"), False)))
        ).alias("stand"),
    )
    in_block = Window.partitionBy("block").orderBy("extra", "order")
    return placed.select("stand.*", "doc_id", "text", "order").select(
        "block",
        F.row_number().over(in_block).alias("place"),
        "doc_id",
        "text",
        F.lead("text").over(in_block).alias("next_text"),
        "extra",
    )


def _stand(block: Column, extra: bool) -> Column:
    return F.struct(block.alias("block"), F.lit(extra).alias("extra"))


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    words = lexicon(documents)
    pairs = edit_pairs(documents)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", 1, n - half), F.substring("next_text", 1, half))
    pairs = pairs.withColumn("edited", F.when(~F.col("extra"), edited))
    both = F.array(_variant(0, "text"), _variant(1, "edited"))
    carried = ["doc_id", "extra", "n_chars", "edited_sha256"]
    pairs = pairs.select(
        "block",
        "place",
        "doc_id",
        "extra",
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.when(F.col("extra"), F.slice(both, 1, 1)).otherwise(both).alias("both"),
    )
    variants = pairs.select("block", "place", *carried, F.explode("both").alias("variant"))
    variants = variants.select("block", "place", *carried, "variant.*")
    found = fingerprinted(variants, words, ["block", "place", "which"], carried)
    rows = found.groupBy("block", "place").agg(
        *[F.any_value(name).alias(name) for name in carried],
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    following = F.lead("fingerprint").over(Window.partitionBy("block").orderBy("place"))
    rows = rows.withColumn("next_fingerprint", following).filter(~F.col("extra"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def _variant(which: int, text: str) -> Column:
    return F.struct(F.lit(which).alias("which"), F.col(text).alias("text"))
