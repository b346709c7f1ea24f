"""Near-duplicate classes by order MinHash, verified by banded alignment.

Texts are sequences of words (white space only separates them). Equal sequences are one text.
Each of ``SKETCHES`` hash functions picks the ``PICKED`` least occurrence-labelled k-mers of
``K`` words and keeps them in text order; their hash is a bucket key. Order MinHash collides for
texts of a small edit distance: two texts are near duplicates when their words' edit similarity,
``1 - distance / longer length``, is ``SIMILARITY`` or more. At a similarity of 0.8 with edits spread
evenly over more than ``SHORT`` words, be they substitutions, deletions or insertions, some bucket holds
both with a probability above 0.9, and above 0.97 at 0.85; the alignment then decides exactly.

The first ``FIRST_SKETCHES`` find most of the classes. The buckets of the others are tested only where they hold
texts of different classes, and no pair within a class is tested again.

Texts of at most ``SHORT`` words meet all their near duplicates. An edit takes at most ``k`` of a
text's k-mers away, so of two near duplicates each has at least one of the other's among its first
``1 + k * edits`` in any order of all k-mers (prefix filter), if the longer has more k-mers than
that takes away; ``prefixes`` chooses ``k`` so. These first k-mers are the bucket keys. The order
puts rare k-mers first, by counts in ``_CELLS`` cells: the counts bear on the size of the buckets
only. Texts just above ``SHORT`` have both kinds of keys.

Within a bucket every pair that is not yet connected is tested, by lengths, word counts and then
an alignment within the band that the threshold allows, so no link between members is lost and
no pairs are emitted: only the edges of a spanning forest are. Buckets with the same members are
tested once. Buckets above ``BLOCK`` members or ``BLOCK_WORDS`` words are cut into blocks, and pairs of
blocks tested as units of their own, so that what a task holds at a time is bounded but for single texts.
Within a unit only texts whose lengths allow for it are compared. Classes are the connected components.

A null or empty text is an empty sequence, and all those are one class, as are texts of white
space. Null ids and repeated rows are members like any other; a class is named by its least id.
An empty table gives an empty result; other columns are ignored by ``classes`` and carried by ``representatives``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logrisk.llm.components import components
from logrisk.llm.rows import map_rows
from logrisk.sources.scratch import materialize

K = 5
SKETCHES = 104
FIRST_SKETCHES = 24
PICKED = 2
SIMILARITY = 0.8
BLOCK = 4096
BLOCK_WORDS = 2_000_000
#: Words of a text up to which the search for its near duplicates is exact.
SHORT = 60
#: Words of the k-mers of short texts, where the length allows for as many.
SHORT_K = 3
_CELLS = 1 << 18
_BINS = 512
_WIDE = 8192
_CACHE_WORDS = 500_000
_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of a word, emptied when full."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = found
        return found


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def occurrences(values: np.ndarray) -> np.ndarray:
    """How often each value stood before its place."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    runs = np.diff(np.r_[starts, len(ordered)])
    out = np.empty(len(values), np.uint64)
    out[order] = (np.arange(len(ordered)) - np.repeat(starts, runs)).astype(np.uint64)
    return out


def sketch(words: np.ndarray, k: int = K) -> list[int]:
    """The order MinHash keys of a sequence of word hashes, one per hash function."""
    if not len(words):
        return []
    size = min(k, len(words))
    mers = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        mers = _mixed(mers * _MIX + words[j : j + len(mers)])
    mers = _mixed(mers + occurrences(mers) * _MIX)
    keys = np.arange(1, SKETCHES + 1, dtype=np.uint64) * _MIX
    step = max(1, (1 << 20) // len(mers))
    for low in range(0, SKETCHES, step):
        ranks = mers[None, :] * _FACTORS[low : low + step, None]
        places = []
        for _ in range(min(PICKED, len(mers))):
            place = ranks.argmin(axis=1)
            ranks[np.arange(len(place)), place] = np.iinfo(np.uint64).max
            places.append(place)
        for place in np.sort(np.stack(places), axis=0):
            keys[low : low + step] = _mixed(keys[low : low + step] * _MIX + mers[place])
    return keys.view(np.int64).tolist()


def prefixes(similarity: float = SIMILARITY) -> list[dict[int, int]]:
    """For each number of words the sizes ``k`` of the k-mers that are keys, and how many of each,
    for near duplicates of which the shorter has at most ``SHORT`` words."""

    def edits(n: int) -> int:
        return most_edits(n, n, similarity)

    widest = SHORT
    while widest + 1 - edits(widest + 1) <= SHORT:
        widest += 1
    out: list[dict[int, int]] = [{} for _ in range(widest + 1)]
    for longer in range(1, widest + 1):
        most = edits(longer)
        k = next((k for k in range(SHORT_K, 1, -1) if longer - k + 1 > k * most), 1)
        for shorter in range(max(1, longer - most), min(longer, SHORT) + 1) if most else ():
            # What the shorter text lacks lies between its words: it loses a k-mer less for each.
            for n, lost in ((longer, k * most), (shorter, k * most - (longer - shorter))):
                out[n][k] = max(out[n].get(k, 0), 1 + lost)
    return out


def short_mers(words: np.ndarray, k: int) -> np.ndarray:
    """The occurrence-labelled k-mers of a sequence of word hashes."""
    words = words.astype(np.uint64)
    mers = np.full(max(0, len(words) - k + 1), k, np.uint64)
    for j in range(k):
        mers = _mixed(mers * _MIX + words[j : j + len(mers)])
    return _mixed(mers + occurrences(mers) * _MIX) if len(mers) else mers


def _cell(mers: np.ndarray) -> np.ndarray:
    return (mers % np.uint64(_CELLS)).astype(np.int64)


def short_keys(words: np.ndarray, levels: np.ndarray, wanted: dict[int, int]) -> list[int]:
    """The first k-mers of a short text, as many as are ``wanted`` of each size, in the order of
    the ``levels`` of their cells and of their hashes."""
    keys: list[int] = []
    for k, most in wanted.items():
        mers = short_mers(words, k)
        keys += mers[np.lexsort((mers, levels[_cell(mers)]))[:most]].view(np.int64).tolist()
    return keys


def word_ids(text: str | None, hashes: WordHashes) -> tuple[bytes, np.ndarray]:
    """A text's digest and its words' hashes."""
    words = (text or "").split()
    digest = hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest()
    return digest, np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


class Places:
    """For every word of a text the places where it stands, as bits of a number.

    Numbers as wide as the text take space in the square of its length, so those of a text of
    more than ``_WIDE`` words are made from lists of places, for the band that is asked for.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.bits: dict[int, int] = {}
        self.lists: dict[int, list[int]] = {}
        for place, word in enumerate(words.tolist()):
            if self.n <= _WIDE:
                self.bits[word] = self.bits.get(word, 0) | 1 << place
            else:
                self.lists.setdefault(word, []).append(place)

    def band(self, word: int, shift: int, mask: int, width: int) -> int:
        """The places from ``shift`` on, ``width`` of them, as bits from 0 on."""
        if self.n <= _WIDE:
            places = self.bits.get(word, 0)
            return (places >> shift if shift >= 0 else places << -shift) & mask
        places, out = self.lists.get(word, ()), 0
        for place in places[bisect_left(places, shift) : bisect_left(places, shift + width)]:
            out |= 1 << place - shift
        return out


def distance_within(longer: Places, shorter: list[int], most: int) -> bool:
    """Whether the edit distance of a text, given by its ``Places``, and one of at most as many
    words is at most ``most``.

    A banded alignment, one word of the shorter text at a time: bits of a number hold the vertical
    differences of the ``2 * most + 1`` diagonals around the main one (Hyyro's bit vectors). It ends
    as soon as the value at the band's edge can no longer come down to ``most``.
    """
    n, m = longer.n, len(shorter)
    if n <= most:
        return True
    if n - m > most:
        return False
    width = 2 * most + 1
    mask, top = (1 << width) - 1, 1 << (width - 1)
    rising, falling = mask ^ ((1 << most) - 1), 0
    value, shift = most, -most
    level = m - (n - most)  # columns that are left once the band's edge has met the last row
    row_bit = top >> 1
    for column, word in enumerate(shorter):
        match = longer.band(word, shift, mask, width)
        shift += 1
        zero = ((((match & rising) + rising) ^ rising) | match | falling) & mask
        right_up = falling | (mask ^ (zero | rising))
        right_down = zero & rising
        if column < n - most:
            value += not zero & top
        else:
            value += bool(right_up & row_bit) - bool(right_down & row_bit)
            row_bit >>= 1
        if value > most + level:
            return False
        down = zero >> 1
        rising = right_down | (mask ^ (down | right_up))
        falling = down & right_up
    return value <= most


class Member:
    """A text of a bucket: its words, each with its number among equal words, in sorted order."""

    def __init__(self, digest: bytes, words: np.ndarray):
        self.digest, self.words = digest, words
        numbered = _mixed(words.astype(np.uint64) + occurrences(words) * _MIX) if len(words) else words
        self.numbered = np.sort(numbered)
        self.where: Places | None = None
        self.bins = np.bincount(words % _BINS, minlength=_BINS).astype(np.uint16 if len(words) < 1 << 16 else np.int32)


def near(x: Member, y: Member, most: int) -> bool:
    """Whether the edit distance of two texts is at most ``most``; the words that they have in
    common bound it from below, and the alignment decides."""
    if len(x.words) < len(y.words):
        x, y = y, x
    at = np.searchsorted(x.numbered, y.numbered)
    at[at == len(x.numbered)] = 0
    shared = int((x.numbered[at] == y.numbered).sum()) if len(x.numbered) else 0
    if len(x.words) - shared > most:
        return False
    if x.where is None:
        x.where = Places(x.words)
    return distance_within(x.where, y.words.tolist(), most)


def most_edits(n: int, m: int, similarity: float) -> int:
    return int((1 - similarity) * max(n, m) + 1e-9)


def links(
    members: list[Member], left: list[int], right: list[int], similarity: float, known: list | None = None
) -> Iterator[tuple[int, int]]:
    """A spanning forest of the near duplicates between ``left`` and ``right`` (which may be one
    list): every pair is tested unless both are already connected. Members of an equal ``known``
    class are."""
    parent = list(range(len(members)))
    if known is not None:
        first = {name: i for i, name in reversed(list(enumerate(known)))}
        parent = [first[name] for name in known]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # In the order of their lengths, the texts that are not too short or too long stand side by side.
    ordered = sorted(right, key=lambda j: len(members[j].words))
    bins = np.stack([members[j].bins for j in ordered])
    sizes = np.array([len(members[j].words) for j in ordered])
    allowed = ((1 - similarity) * sizes + 1e-9).astype(np.int64)
    same = left is right
    for at, i in enumerate(ordered if same else left):
        n = len(members[i].words)
        own = most_edits(n, n, similarity)
        low = at + 1 if same else int(np.searchsorted(sizes, n - own))
        high = int(np.searchsorted(sizes - allowed, n, side="right"))
        longer, most = np.maximum(sizes[low:high], n), np.maximum(allowed[low:high], own)
        # A word of the longer text that the other lacks costs an edit; bins bound what they share.
        possible = longer - np.minimum(bins[low:high], members[i].bins).sum(axis=1, dtype=np.int64) <= most
        for place in np.flatnonzero(possible):
            j = ordered[low + place]
            if i == j or root(i) == root(j):
                continue
            if near(members[i], members[j], int(most[place])):
                parent[root(j)] = root(i)
                yield i, j


_SKETCHED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_hash", T.StringType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_words", T.IntegerType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("short", T.BinaryType()),
    ]
)
_KEYED = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)
_WORDED = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("words", T.BinaryType())])


def sketched(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, text_hash, digest, n_words, keys, short`` of every document: the sketches of a text of more
    than ``SHORT`` words, and the words of one that may be near to a short one, as 32-bit hashes."""
    wanted = prefixes(similarity)

    def make():
        hashes = WordHashes()

        def short(words: np.ndarray) -> bytes | None:
            n = len(words)
            return words.astype(np.uint32).tobytes() if n < len(wanted) and wanted[n] else None

        def work(doc_ids, text_hashes, texts):
            rows = [word_ids(text, hashes) for text in texts]
            keys = [sketch(words) if len(words) > SHORT else [] for _, words in rows]
            sizes = [len(words) for _, words in rows]
            return doc_ids, text_hashes, [digest for digest, _ in rows], sizes, keys, [short(words) for _, words in rows]

        return work

    return map_rows(documents.select("doc_id", F.md5("text").alias("text_hash"), "text"), make, _SKETCHED)


def short_levels(short: DataFrame, similarity: float) -> np.ndarray:
    """How often the k-mers of each cell occur, on a scale of logarithms, from rows of ``short``."""
    wanted = prefixes(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_CELLS, np.int64)
        for batch in batches:
            for data in batch.column(0):
                words = np.frombuffer(data.as_py(), np.uint32)
                for k in wanted[len(words)]:
                    np.add.at(counts, _cell(short_mers(words, k)), 1)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], ["cell", "mers"])

    sums = short.select("short").mapInArrow(run, "cell long, mers long").groupBy("cell").agg(F.sum("mers").alias("mers"))
    found = sums.toArrow()
    counts = np.zeros(_CELLS)
    counts[found.column("cell").to_numpy()] = found.column("mers").to_numpy()
    return np.floor(4 * np.log2(counts + 1)).astype(np.uint8)


def short_sketched(rows: DataFrame, similarity: float) -> DataFrame:
    """``digest, size, keys`` of the distinct texts of ``rows`` that have ``short`` words."""
    short = rows.filter("short IS NOT NULL")
    levels, wanted = short_levels(short, similarity), prefixes(similarity)

    def make():
        def work(digests, shorts):
            words = [np.frombuffer(data, np.uint32) for data in shorts]
            return digests, [len(x) for x in words], [short_keys(x, levels, wanted[len(x)]) for x in words]

        return work

    return map_rows(short.groupBy("digest").agg(F.any_value("short").alias("short")), make, _KEYED)


def worded(texts: DataFrame) -> DataFrame:
    """``digest, words`` of rows of ``digest, text``: the words as 32-bit hashes. Texts that do
    not have the digest are left out."""

    def make():
        hashes = WordHashes()

        def work(digests, texts):
            rows = [word_ids(text, hashes) for text in texts]
            rows = [(digest, words) for expected, (digest, words) in zip(digests, rows) if digest == expected]
            return [digest for digest, _ in rows], [words.astype(np.uint32).tobytes() for _, words in rows]

        return work

    return map_rows(texts.select("digest", "text"), make, _WORDED)


def buckets(placed: DataFrame) -> DataFrame:
    """``key, id, late, members, words`` of the buckets to test, from rows of ``key, id, late, n_words``: two
    members at least, each set of members once, and ``late`` only if no other key holds it."""
    # One shuffle for both readers, which is why both of them take all columns.
    dealt = placed.repartition("key")
    sets = dealt.groupBy("key").agg(
        F.count("*").alias("members"),
        F.sum("n_words").alias("words"),
        F.bit_xor("id").alias("one"),
        F.bit_xor(F.xxhash64("id")).alias("two"),
        F.bool_and("late").alias("all_late"),
    )
    groups = sets.filter("members > 1").groupBy("members", "words", "one", "two")
    kept = groups.agg(F.min(F.struct("all_late", "key")).alias("kept")).select("kept.*", "members", "words")
    found = dealt.join(kept, "key").filter("n_words >= 0 AND late IS NOT NULL")
    return found.select("key", "id", F.col("all_late").alias("late"), "members", "words")


def between_classes(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """The buckets of ``placed`` (``key, id, members, words``) that hold several classes, with each member's
    ``class`` by ``roots`` (``node, root``)."""
    known = roots.select(F.xxhash64("node").alias("id"), F.xxhash64("root").alias("class"))
    # An id that two texts have takes either one's class; at worst a pair is not tested here.
    known = known.groupBy("id").agg(F.min("class").alias("class"))
    named = placed.join(known, "id", "left").withColumn("class", F.coalesce("class", "id"))
    several = named.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    return named.join(several.filter("least <> most").select("key"), "key")


def verified(placed: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """Edges ``a, b`` between the digests of near duplicates that share a bucket and no class. An ``id`` that
    two texts have stands for both."""
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("words") / BLOCK_WORDS)).cast("int")
    own = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = (
        placed.withColumn("blocks", F.least(blocks, F.col("members").cast("int")))
        .withColumn("own", own)
        .withColumn("other", other)
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id", "class")
    )
    keys = ["key", "low", "high"]
    held = words.select(F.xxhash64("digest").alias("id"), "digest", F.col("words").alias("held"))
    gathered = units.join(held, "id").repartition(*keys).sortWithinPartitions(*keys)

    def test(unit: tuple, rows: list[tuple]) -> tuple[list[bytes], list[bytes]]:
        _, low, high = unit
        seen: set[bytes] = set()
        members, blocks, known = [], [], []
        for own, name, digest, data in rows:
            if digest not in seen:
                seen.add(digest)
                members.append(Member(digest, np.frombuffer(data, np.uint32)))
                blocks.append(own)
                known.append(name)
        left = [i for i, own in enumerate(blocks) if own == low]
        right = left if low == high else [i for i, own in enumerate(blocks) if own == high]
        pairs = list(links(members, left, right, similarity, known)) if left and right else []
        return [members[i].digest for i, _ in pairs], [members[j].digest for _, j in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                if row[:3] != unit:
                    if len(rows) > 1:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in test(unit, rows)], ["a", "b"])
                    unit, rows = row[:3], []
                rows.append(row[3:])
        if len(rows) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in test(unit, rows)], ["a", "b"])

    return gathered.select(*keys, "own", "class", "digest", "held").mapInArrow(run, "a binary, b binary")


def first_texts(documents: DataFrame, needed: DataFrame) -> DataFrame:
    """``digest, text`` of the rows of ``documents`` that ``needed`` names by ``first``, a null mark, id and hash.
    A row meets those only that have its id and its text."""
    named = needed.select("digest", *_row_keys("first."))
    rows = documents.select("text", *_row_keys(text_hash=F.md5("text")))
    return rows.join(named.hint("merge"), ["no_id", "id_key", "hash_key"]).select("digest", "text")


def digest_classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, text_hash, root`` of every document: equal roots are one class.

    The texts are read twice and shuffled once, to be joined to the buckets that hold them.
    """
    rows = materialize(sketched(documents, similarity), "near-sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    number = F.xxhash64("digest").alias("id")
    texts = rows.groupBy("digest").agg(F.any_value("n_words").alias("n_words"), F.any_value("keys").alias("keys"))
    sketches = texts.select(number, "n_words", F.posexplode("keys").alias("place", "key"))
    late = (F.col("place") >= FIRST_SKETCHES).alias("late")
    short = short_sketched(rows, similarity).select(
        F.explode("keys").alias("key"), number, F.lit(False).alias("late"), F.col("size").alias("n_words")
    )
    placed = materialize(buckets(sketches.select("key", "id", late, "n_words").unionByName(short)), "near-buckets")
    named = rows.groupBy("digest").agg(first).select("digest", "first", number)
    needed = named.join(placed.select("id").distinct(), "id")
    words = materialize(worded(first_texts(documents, needed)), "near-words")

    early = placed.filter("not late").withColumn("class", F.col("id"))
    roots = materialize(components(verified(early, words, similarity)), "near-roots")
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    more = verified(between_classes(placed.filter("late"), roots), words, similarity)
    roots = components(stars.unionByName(more))
    joined = rows.select("doc_id", "text_hash", "digest").join(roots, F.col("digest") == F.col("node"), "left")
    return joined.select("doc_id", "text_hash", F.coalesce("root", "digest").alias("root"))


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, class_size`` of every document."""
    rows = digest_classes(documents, similarity)
    named = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(named, "root").select("doc_id", "class_id", "class_size")


def representatives(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with its own columns: the one with the least id, and of
    repeated rows any one. The texts are shuffled once more, to meet the choice."""
    rows = materialize(digest_classes(documents, similarity), "near-classes")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best")
    kept = rows.groupBy("root").agg(best).select(*_row_keys("best."))
    keys = ["no_id", "id_key", "hash_key"]
    marked = documents.select(F.struct("*").alias("row"), "doc_id", F.md5("text").alias("text_hash"))
    joined = marked.select("row", *_row_keys()).join(kept.hint("merge"), keys)
    one = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return joined.withColumn("nth", one).filter("nth = 1").select("row.*")


def _row_keys(prefix: str = "", text_hash: Column | None = None) -> list:
    """Equality keys of a document, nulls included."""
    doc_id, text_hash = F.col(f"{prefix}doc_id"), F.col(f"{prefix}text_hash") if text_hash is None else text_hash
    return [
        doc_id.isNull().alias("no_id"),
        F.coalesce(doc_id, F.lit(0)).alias("id_key"),
        F.coalesce(text_hash, F.lit("")).alias("hash_key"),
    ]
