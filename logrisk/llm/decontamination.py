"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows are its runs of ``WINDOW`` consecutive words; a shorter item is one window. A
window is a set of shingles, its runs of ``SHINGLE`` words (all of a shorter window) with their
places. As a document must contain a window whole, all of its shingles are necessary, and one of
them is prefix enough: the rarest. So

1. the documents' shingles meet the items' shingles, in the task that reads them; those that no item
   holds go no further, the others are stored as hits with their place. The texts are read once;
2. shingles are ordered by their hits over all documents; a window with a shingle that has none occurs
   nowhere, and any other has its rarest shingle as its prefix;
3. the prefixes are joined with the hits. The prefix's place in the window gives the only place where
   the window can begin; it must lie in the document, and so must the window's end;
4. a candidate is verified by the shingles that cover its window, each of which must be hit at its own place.
   Shingles are compared as text, so this is exact.

The items' tables are broadcast when they have up to ``MOST_BROADCAST`` rows, counted; beyond, they are joined by
a shuffle in which every key is dealt over ``SALTS`` parts. A hot passage is many hits of few shingles,
which are dealt by document.

Words are runs of digits, lower-cased letters A to Z and characters beyond U+007F; a null text has none.
Texts without words, an empty benchmark and an empty table of documents are no special cases. Items
without an id are told as ``null``; items with equal ids are one item with the windows of all. Repeated
documents and documents without an id are rows of their own. Other columns, whatever their names,
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.sources.scratch import materialize

WINDOW = 10
SHINGLE = 5
#: Rows of a table of the items that are broadcast at most, of about a hundred bytes each.
MOST_BROADCAST = 400_000
#: Parts into which a key is dealt where the items' side is not broadcast.
SALTS = 16
# Fixed value: what separates words, once A to Z are in lower case.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    text = F.coalesce(text, F.lit(""))
    # Lower case is that of A to Z only; in a text of ASCII characters there is no other.
    ascii_only = F.octet_length(text) == F.length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(lowered, _BREAK), "")


def _shingles(size: int) -> Column:
    """``pos, shingle`` of every run of ``size`` words of the column ``words``."""
    at = lambda i: F.concat_ws(" ", *[F.get("words", i + j) for j in range(size)])
    places = F.sequence(F.lit(0), F.size("words") - size)
    found = F.transform(places, lambda i: F.struct(i.alias("pos"), at(i).alias("shingle")))
    return F.when(F.size("words") >= size, found).otherwise(F.array().cast("array<struct<pos: int, shingle: string>>"))


def item_windows(items: DataFrame, window: int = WINDOW, key: str = "item_id") -> DataFrame:
    """``item, window``: the distinct windows of every item, as words joined by blanks."""
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") > 0).withColumn("size", F.least(F.size("words"), F.lit(window)))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("size"))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, F.col("size")), " "))
    return rows.select("item", F.explode(cut).alias("window")).distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``wid, length, n, place, shingle`` of every shingle of the windows (``wid, window``): ``length`` of
    the window and ``n`` of the shingle in words."""
    cut = windows.select("wid", F.split("window", " ").alias("words"))
    cut = cut.withColumn("length", F.size("words")).withColumn("n", F.least("length", F.lit(shingle)))
    places = F.sequence(F.lit(0), F.col("length") - F.col("n"))
    text = lambda i: F.array_join(F.slice("words", i + 1, F.col("n")), " ")
    found = F.transform(places, lambda i: F.struct(i.alias("place"), text(i).alias("shingle")))
    return cut.select("wid", "length", "n", F.inline(found))


def _meet(rows: DataFrame, small: DataFrame, on: str, spread: Column) -> DataFrame:
    """The inner join of rows with a table of the items; where that is too large to broadcast, a key's rows
    are dealt over ``SALTS`` parts by ``spread``."""
    if small.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(small), on)
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [on, "_salt"]).drop("_salt")


def _hits(documents: DataFrame, known: DataFrame, sizes: list[int]) -> DataFrame:
    """``row, doc_id, n_words, pos, sid`` of every place of a document that holds a known shingle
    (``shingle, sid``); ``row`` tells documents apart. Every document has one more row, at -1."""
    rows = documents.select("doc_id", words(F.col("text")).alias("words"))
    # The empty shingle, which is known, keeps documents without a hit.
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("").alias("shingle")))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.concat(own, *[_shingles(size) for size in sizes]).alias("shingles"),
    )
    spread = rows.select("row", "doc_id", "n_words", F.inline("shingles"))
    return _meet(spread, known, "shingle", F.struct("row", "pos")).select("row", "doc_id", "n_words", "pos", "sid")


def prefixes(shingles: DataFrame, hits: DataFrame) -> DataFrame:
    """``sid, place, wid, length, covers`` of every window whose shingles (``wid, length, n, place, sid``) all
    have hits: its rarest shingle, and those that cover it, with their places."""
    rarity = hits.filter("pos >= 0").groupBy("sid").agg(F.count("*").alias("hits"))
    met = shingles.join(rarity, "sid", "left")
    covering = (F.col("place") % F.col("n") == 0) | (F.col("place") == F.col("length") - F.col("n"))
    cover = F.when(covering, F.struct("place", "sid"))
    windows = met.groupBy("wid", "length").agg(
        F.count("*").alias("necessary"),
        F.count("hits").alias("present"),
        F.min(F.struct("hits", "place", "sid")).alias("rarest"),
        F.collect_list(cover).alias("covers"),
    )
    kept = windows.filter("present = necessary")
    return kept.select("rarest.sid", "rarest.place", "wid", "length", "covers")


def occurrences(hits: DataFrame, prefix: DataFrame) -> DataFrame:
    """``row, wid, start, stop`` of every place where a window stands in a document, in words."""
    start = F.col("pos") - F.col("place")
    candidates = _meet(hits.select("row", "n_words", "pos", "sid"), prefix, "sid", F.struct("row", "pos"))
    candidates = candidates.select("row", "wid", start.alias("start"), (start + F.col("length")).alias("stop"), "n_words", "covers")
    candidates = candidates.filter((F.col("start") >= 0) & (F.col("stop") <= F.col("n_words")))
    needed = candidates.select("row", "wid", "start", "stop", F.size("covers").alias("needed"), F.inline("covers"))
    needed = needed.withColumn("pos", F.col("start") + F.col("place"))
    met = needed.join(hits.filter("pos >= 0").select("row", "pos", "sid"), ["row", "pos", "sid"])
    found = met.groupBy("row", "wid", "start", "stop", "needed").agg(F.count("*").alias("met"))
    return found.filter("met = needed").select("row", "wid", "start", "stop")


def contaminated(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, key: str = "item_id"
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every document: the runs of words that stand in an
    occurrence of a window (``start, stop``, in order), and the items of these windows, in order."""
    members = materialize(item_windows(items, window, key), "decontamination-items")
    windows = members.select("window").distinct().withColumn("wid", F.monotonically_increasing_id())
    windows = materialize(windows, "decontamination-windows")
    shingles = materialize(window_shingles(windows, shingle), "decontamination-shingles")
    known = shingles.select("shingle").distinct().withColumn("sid", F.monotonically_increasing_id())
    known = materialize(known, "decontamination-known")
    sizes = sorted(row.n for row in shingles.select("n").distinct().collect())  # at most ``shingle`` of them
    nothing = documents.sparkSession.range(1).select(F.lit("").alias("shingle"), F.lit(-1).cast("long").alias("sid"))
    hits = materialize(_hits(documents, known.unionByName(nothing), sizes), "decontamination-hits")
    prefix = materialize(prefixes(shingles.join(known, "shingle"), hits), "decontamination-prefixes")
    found = materialize(occurrences(hits, prefix), "decontamination-found")

    before = Window.partitionBy("row").orderBy("start", "stop")
    reached = F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > reached).cast("int"), F.lit(1))
    places = found.select("row", "start", "stop").distinct().withColumn("opens", opens)
    runs = places.withColumn("run", F.sum("opens").over(before)).groupBy("row", "run")
    runs = runs.agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    spans = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))

    own = members.join(windows, "window").select("wid", "item")
    told = _meet(found.select("row", "wid").distinct(), own, "wid", F.col("row")).select("row", "item").distinct()
    told = told.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    rows = hits.filter("pos = -1").select("row", "doc_id", "n_words")
    return rows.join(spans, "row", "left").join(told, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start: int, stop: int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
