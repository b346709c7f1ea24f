"""Exact removal of repeated byte strings across all texts.

A byte goes if a string of ``SIZE`` bytes that covers it also begins earlier, in a text of a
smaller id or before in the same text. Every window of ``SIZE`` bytes is named by its anchor, the
``SEED``-gram of least hash within it (the leftmost of equals), so that equal windows have equal
anchors at equal places and one anchor stands for a run of windows, its context.

1. Contexts are found by rolling hashes, and equal contexts within a batch are settled at once;
   the rest meet by the hash of their anchor, sorted. Of equal contexts the first stays and
   the windows of all others are repeats. What hot passages and exact copies share ends here,
   mostly within the tasks that read them.
2. Anchors with different contexts may share some windows. Their contexts' bytes are fetched and
   sorted as suffixes (see ``suffix_sort``), in units of at most ``UNIT`` contexts of an anchor.
3. Anchors with more contexts than that hand the windows that stay in each unit on to a common
   aggregation by the windows' digests, which no key can overload.
4. Runs of repeats are gathered per text, merged and cut out.

Whole contexts are equal if two independent 64-bit hashes of their bytes, the hash of their anchor, its place
in them and their length are; parts of contexts are if their bytes are. The texts are shuffled twice and read three times.

Nulls: a null text is empty; a null id is the greatest. Equal ids are ordered by the text's hash.
Of repeated rows one is kept and the others are repeats of it. Bytes are those of UTF-8; what is
left may begin or end within a character. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logrisk.llm.suffix_sort import repeats
from logrisk.sources.scratch import materialize

SIZE = 100
SEED = 32
UNIT = 4096
#: Bytes of text whose windows are found, and contexts that are sorted, at a time.
CHUNK = 1 << 17
SORTED = 1 << 14
_PLACE_BITS = 18  # of a place within a chunk, its tail included
_LAST_ID = np.iinfo(np.int64).max
_ANCHOR_BASE, _CONTEXT_BASE, _CHECK_BASE = 0xD1342543DE82EF95, 0xA0761D6478BD642F, 0x9FB21C651E98DF25
#: The part of a context's place that tells its shape: the anchor's place in it and its windows.
_SHAPE = (1 << 14) - 1


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64, for the places of a chunk."""
    n = (1 << _PLACE_BITS) + 1
    out = []
    for value in (base, pow(base, -1, 2**64)):
        powers = np.full(n, value, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class Contexts:
    """Finds the contexts of texts, many short texts or a part of a long one at a time."""

    def __init__(self, size: int = SIZE, seed: int = SEED):
        self.size, self.seed = size, seed
        self.powers = {base: _powers(base) for base in (_ANCHOR_BASE, _CONTEXT_BASE, _CHECK_BASE)}

    def parts(self, offsets: np.ndarray) -> Iterator[list[tuple[int, int, int]]]:
        """Groups of ``(text, first window, end of windows)`` of about a chunk of bytes."""
        group, total = [], 0
        for text, length in enumerate(np.diff(offsets).tolist()):
            windows = length - self.size + 1
            for start in range(0, max(0, windows), CHUNK):
                end = min(start + CHUNK, windows)
                if group and total + end - start + self.size > CHUNK:
                    yield group
                    group, total = [], 0
                group.append((text, start, end))
                total += end - start + self.size
        if group:
            yield group

    def find(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """``text, start, anchor, count, anchor hash`` and two hashes of every context: ``count``
        windows from byte ``start`` on, the anchor ``anchor`` bytes later."""
        for group in self.parts(offsets):
            pieces = [data[offsets[t] + a : offsets[t] + b + self.size - 1] for t, a, b in group]
            lengths = np.array([len(p) for p in pieces])
            places = np.r_[0, np.cumsum(lengths)]
            texts = np.array([t for t, _, _ in group])
            starts = np.array([a for _, a, _ in group])
            flat = np.concatenate(pieces).astype(np.uint64) + np.uint64(1)
            grams = self._hashes(_ANCHOR_BASE, flat)
            every = np.arange(len(flat) - self.seed + 1)
            keys = grams(every, every + self.seed)
            begin, anchor, count = self._runs(keys, places)
            piece = np.searchsorted(places, begin, side="right") - 1
            hashes = keys[anchor]
            whole, check = (
                self._hashes(base, flat)(begin, begin + count + self.size - 1) for base in (_CONTEXT_BASE, _CHECK_BASE)
            )
            yield texts[piece], starts[piece] + begin - places[piece], anchor - begin, count, hashes, whole, check

    def _hashes(self, base: int, flat: np.ndarray):
        """A function from starts and ends to the hashes of the bytes between."""
        powers, inverse = self.powers[base]
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(flat * powers[: len(flat)], out=sums[1:])
        return lambda start, end: _mixed((sums[end] - sums[start]) * inverse[start])

    def _runs(self, hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """Runs of windows with one anchor: first window, anchor, number of windows."""
        grams = np.arange(len(hashes), dtype=np.uint64)
        low_bits = np.uint64((1 << _PLACE_BITS) - 1)
        keys = (hashes & ~low_bits) | grams
        width, span = 1, self.size - self.seed + 1  # grams of a window
        least = keys
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        inside = np.ones(len(least), bool)
        for end in places[1:-1]:
            inside[end - self.size + 1 : end] = False
        window = np.flatnonzero(inside)
        anchor = (least[window] & low_bits).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)])
        count = np.diff(np.r_[first, len(window)])
        return window[first], anchor[first], count


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a column of texts; null is empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def _packed(start: np.ndarray, anchor: np.ndarray, count: np.ndarray) -> np.ndarray:
    return start << 14 | anchor << 7 | count


def _unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 14, place >> 7 & 127, place & 127


_CONTEXT = "anchor long, context long, check long, id long, text_hash long, place long, settled boolean"
_NAMES = ["anchor", "context", "check", "id", "text_hash", "place", "settled"]


def _identified(documents: DataFrame) -> DataFrame:
    """``id, text_hash, text``, which name a text and where it stands in order, and ``doc_id``."""
    text = F.coalesce("text", F.lit(""))
    number = F.coalesce("doc_id", F.lit(int(_LAST_ID)))
    return documents.select(number.alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"), "doc_id")


def _copy_number() -> Column:
    """Numbers repeated rows; where rows were joined by what names them, nothing is shuffled."""
    return F.row_number().over(Window.partitionBy("id", "text_hash").orderBy("id", "text_hash"))


def contexts(documents: DataFrame, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """All contexts of all texts. Of equal ones within a batch only the first is not ``settled``."""

    def settle(rows: list[np.ndarray]) -> list[np.ndarray]:
        order = np.lexsort((rows[5], rows[4], rows[3], rows[5] & _SHAPE, rows[2], rows[1], rows[0]))
        rows = [values[order] for values in rows]
        same = [values[1:] == values[:-1] for values in [*rows, rows[5] & _SHAPE]]
        equal = np.r_[False, same[0] & same[1] & same[2] & same[6]]
        repeated = np.r_[False, np.logical_and.reduce(same)]
        return [values[~repeated] for values in [*rows, equal]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Contexts(size, seed)
        for batch in batches:
            data, offsets = _text_bytes(batch.column(2))
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = [
                (*[x.view(np.int64) for x in told], ids[text], hashes[text], _packed(start, anchor, count))
                for text, start, anchor, count, *told in finder.find(data, offsets)
            ]
            if found:
                rows = settle([np.concatenate(values) for values in zip(*found)])
                yield pa.RecordBatch.from_arrays([pa.array(values) for values in rows], _NAMES)

    return _identified(documents).select("id", "text_hash", "text").mapInArrow(run, _CONTEXT)


def compared(rows: DataFrame, unit_size: int = UNIT) -> DataFrame:
    """Contexts sorted by anchor: repeats of an equal context are ``settled``; of the first ones of
    an anchor that has several, ``unit`` numbers the group that they are sorted in. Others go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None  # the last row, its number among the first of its anchor
        number, waiting = 0, None  # the only context of the last anchor so far

        def out(rows: list[np.ndarray], unit: np.ndarray, settled: np.ndarray) -> pa.RecordBatch:
            columns = [rows[0], rows[3], rows[4], rows[5], unit, settled]
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in columns], ["anchor", "id", "text_hash", "place", "unit", "settled"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            passed = rows[6]
            if passed.any():
                yield out([x[passed] for x in rows], np.zeros(passed.sum(), np.int32), np.ones(passed.sum(), bool))
                rows = [x[~passed] for x in rows]
            if not len(rows[0]):
                continue
            before = [np.r_[x[:1] if last is None else [y], x[:-1]] for x, y in zip(rows[:6], last or [0] * 6)]
            same = [x == y for x, y in zip([*rows[:6], rows[5] & _SHAPE], [*before, before[5] & _SHAPE])]
            if last is None:
                for x in same:
                    x[0] = False
            last = [x[-1] for x in rows[:6]]
            equal = same[0] & same[1] & same[2] & same[6]
            repeat = equal & ~(same[3] & same[4] & same[5])
            yield out([x[repeat] for x in rows], np.zeros(repeat.sum(), np.int32), np.ones(repeat.sum(), bool))
            first = np.flatnonzero(~equal)
            if not len(first):
                continue
            opens = ~same[0][first]
            group = np.cumsum(opens)
            begins = np.r_[0, np.flatnonzero(opens)] if not opens[0] else np.flatnonzero(opens)
            start = np.zeros(group[-1] + 1, np.int64)
            start[group[begins]] = begins
            numbers = np.arange(len(first)) - start[group]
            numbers[group == 0] += number + 1
            if waiting is not None and not opens[0]:
                yield out(waiting, np.zeros(1, np.int32), np.zeros(1, bool))
            if opens[0] or waiting is not None:
                waiting = None
            several = np.zeros(len(first), bool)
            several[:-1] = ~opens[1:]
            several |= ~opens
            if opens[-1]:
                waiting = [x[first[-1:]] for x in rows]
            number = int(numbers[-1])
            chosen = first[several]
            unit = (numbers[several] // unit_size).astype(np.int32)
            yield out([x[chosen] for x in rows], unit, np.zeros(len(chosen), bool))

    schema = "anchor long, id long, text_hash long, place long, unit int, settled boolean"
    # Settled rows only pass through, so they are dealt out by their text.
    salt = F.when(F.col("settled"), F.col("text_hash")).otherwise(0)
    dealt = rows.withColumn("salt", salt).repartition("anchor", "salt")
    shape = F.col("place").bitwiseAND(_SHAPE)
    ordered = dealt.sortWithinPartitions("anchor", "context", "check", shape, "id", "text_hash", "place")
    return ordered.select(*_NAMES).mapInArrow(run, schema)


def _cut(rows: DataFrame, documents: DataFrame, size: int) -> DataFrame:
    """The bytes of contexts: ``anchor, unit, id, text_hash, place, bytes``."""
    per_text = rows.groupBy("id", "text_hash").agg(F.collect_list(F.struct("anchor", "unit", "place")).alias("rows"))
    joined = _identified(documents).join(per_text.hint("merge"), ["id", "text_hash"])
    joined = joined.withColumn("copy", _copy_number()).filter("copy = 1")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _text_bytes(batch.column(2))
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(3)
            bounds = lists.offsets.to_numpy()
            flat = lists.values
            anchor, unit, place = (flat.field(name).to_numpy() for name in ("anchor", "unit", "place"))
            text = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            inside = slice(bounds[0], bounds[-1])
            anchor, unit, place = anchor[inside], unit[inside], place[inside]
            start, _, count = _unpacked(place)
            begin = offsets[text] + start
            cut = [data[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + count + size - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (anchor, unit, ids[text], hashes[text], place)] + [pa.array(cut, pa.binary())],
                ["anchor", "unit", "id", "text_hash", "place", "bytes"],
            )

    schema = "anchor long, unit int, id long, text_hash long, place long, bytes binary"
    return joined.select("id", "text_hash", "text", "rows").mapInArrow(run, schema)


def sorted_repeats(cut: DataFrame, size: int = SIZE, unit_size: int = UNIT) -> DataFrame:
    """``id, text_hash, start, stop, digest``: runs of bytes that repeat within a unit; and, of
    anchors that may have more units, every window that does not, with its digest."""

    def settle(rows: list[tuple], whole: list[bool]) -> pa.RecordBatch:
        ids, hashes, places, held = (list(x) for x in zip(*[row[2:] for row in rows]))
        ids, hashes = np.array(ids), np.array(hashes)
        start, anchor, count = _unpacked(np.array(places))
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((start + anchor, hashes, ids))] = np.arange(len(rows))
        again = repeats(held, anchor, count, rank, size)
        begins = again & ~np.pad(again, ((0, 0), (1, 0)))[:, :-1]
        ends = again & ~np.pad(again, ((0, 0), (0, 1)))[:, 1:]
        row, first = np.nonzero(begins)
        _, last = np.nonzero(ends)
        out = [ids[row], hashes[row], start[row] + first, start[row] + last + size]
        digests: list[bytes | None] = [None] * len(row)
        stays = ~again & (np.arange(again.shape[1])[None, :] < count[:, None]) & np.array(whole)[:, None]
        row, first = np.nonzero(stays)
        if len(row):
            more = [ids[row], hashes[row], start[row] + first, start[row] + first + size]
            out = [np.concatenate(pair) for pair in zip(out, more)]
            digests += [hashlib.md5(held[r][f : f + size]).digest() for r, f in zip(row.tolist(), first.tolist())]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in out] + [pa.array(digests, pa.binary())], ["id", "text_hash", "start", "stop", "digest"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        more: list[bool] = []
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if group and row[:2] != group[0][:2]:
                    done += group
                    more += [group[0][1] > 0 or len(group) >= unit_size] * len(group)
                    group = []
                    if len(done) >= SORTED:
                        yield settle(done, more)
                        done, more = [], []
                group.append(row)
        done += group
        if done:
            yield settle(done, more + [group[0][1] > 0 or len(group) >= unit_size] * len(group))

    dealt = cut.repartition("anchor", "unit").sortWithinPartitions("anchor", "unit")
    schema = "id long, text_hash long, start long, stop long, digest binary"
    return dealt.select("anchor", "unit", "id", "text_hash", "place", "bytes").mapInArrow(run, schema)


def repeat_spans(documents: DataFrame, size: int = SIZE, seed: int = SEED, unit_size: int = UNIT) -> DataFrame:
    """``id, text_hash, start, stop``: overlapping runs of bytes that stand earlier."""
    found = materialize(compared(contexts(documents, size, seed), unit_size), "suffix-contexts")
    start, count = F.shiftright("place", 14), F.col("place").bitwiseAND(127)
    stop = start + count + (size - 1)
    equal = found.filter("settled").select("id", "text_hash", start.alias("start"), stop.alias("stop"))
    cut = _cut(found.filter("NOT settled"), documents, size)
    partial = materialize(sorted_repeats(cut, size, unit_size), "suffix-repeats")
    names = ["id", "text_hash", "start", "stop"]
    windows = partial.filter("digest IS NOT NULL")
    place = F.struct("id", "text_hash", "start")
    later = windows.join(windows.groupBy("digest").agg(F.min(place).alias("first")), "digest").filter(place > F.col("first"))
    return equal.union(partial.filter("digest IS NULL").select(*names)).union(later.select(*names))


def remove_repeats(documents: DataFrame, size: int = SIZE, seed: int = SEED, unit_size: int = UNIT) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed runs of bytes of every text and what is left."""
    spans = repeat_spans(documents, size, seed, unit_size).groupBy("id", "text_hash")
    spans = spans.agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    rows = _identified(documents).join(spans.hint("merge"), ["id", "text_hash"], "left")
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    rows = rows.select("doc_id", "text", F.coalesce("spans", none).alias("spans"), _copy_number().alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _text_bytes(batch.column(1))
            bounds, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values
            starts, stops = flat.field("start").to_numpy(), flat.field("stop").to_numpy()
            copies = batch.column(3).to_pylist()
            sizes, removed, kept = [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                if copies[i] > 1 and len(text) >= size:
                    merged = [(0, len(text))]
                else:
                    merged = _merged(starts[bounds[i] : bounds[i + 1]], stops[bounds[i] : bounds[i + 1]])
                edges = [0, *[x for pair in merged for x in pair], len(text)]
                sizes.append(len(text))
                removed.append([{"start": a, "stop": b} for a, b in merged])
                kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, _SPANS), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    schema = "doc_id long, n_bytes long, spans array<struct<start: bigint, stop: bigint>>, kept binary"
    return rows.mapInArrow(run, schema)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    opens = np.flatnonzero(np.r_[True, starts[1:] > reach[:-1]])
    return list(zip(starts[opens].tolist(), reach[np.r_[opens[1:] - 1, len(starts) - 1]].tolist()))
