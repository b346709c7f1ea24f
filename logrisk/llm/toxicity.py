"""Toxicity by maximum-scoring segments over token log-odds.

Training counts, for every word and every prefix of ``PREFIXES`` letters, the labelled texts of either class
that hold it, in a table of ``2 ** TABLE_BITS`` cells by hash. The table's size does not depend on the corpus, and no
token is left out of it; tokens that meet in a cell are counted as one.

A word's score is its shrunken log-odds: how much likelier a toxic text holds it than any text does. Two
hypotheses stand against each other, that the word is held by either class alike, and that its toxic share
is its own, with a Dirichlet prior of ``PRIOR_TEXTS`` texts. The score is the log-odds under the second
times the probability of the second, which starts from ``TELLING``. What a prefix is found to be, without the
texts of the word itself, is the prior of the longer prefix and last of the word: forms that training never
met are scored by their stem. Words that tell of clean texts score below 0, words that tell nothing are close
to it. A word that is repeated in a text scores once, as it is counted once; every place pays ``DRIFT``, so
that a passage has to be denser than that.

Scoring scans a text once and finds all maximal scoring segments (a linear-time scan that keeps
candidates with their left cumulative sums). Segments are judged as extreme values, with the
background's Karlin-Altschul parameters ``rate`` (the exponent at which the expected score ratio is 1) and
``density`` (segments per word): a passage is significant if ``rate * S`` is above the chance level
``ln(density * n)`` of a text of ``n`` words. A text's evidence is the sum of what its significant passages have above
it, or, if none is, what its best one lacks. It becomes a probability by a logistic curve.

Labels are read only where ``crc32(doc_id)`` mod 5 is not 0. Counts cover all those rows. Background and curve are
fitted on a sample of them by hash, about ``CALIBRATION_ROWS`` rows or all if there are fewer; each of these rows is
scored without what it has itself added to the counts.

A null or empty text holds no segment and gets the probability of such texts. Null ids match no
label; a row's label is the largest where several exist; null labels are ignored. Repeated rows
are scored each. Without training rows of both classes all scores are the share of toxic labels
(0 if there are none). An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logrisk.llm.rows import map_rows, pieces
from logrisk.llm.terms import WORD, words_of
from logrisk.sources.scratch import materialize

FOLDS = 5
TABLE_BITS = 22
PREFIXES = (4, 5, 6)
#: Weight of a prior share, in texts.
PRIOR_TEXTS = 20.0
#: Probability, before any count, that a token tells the classes apart.
TELLING = 0.01
DRIFT = 0.15
#: Rows that background and curve are fitted on.
CALIBRATION_ROWS = 20_000
#: The range of evidence that the histogram covers.
_EVIDENCE = (-40.0, 60.0)
#: Steps to 1 of the scores' histogram, and the score from which segments are counted.
_STEPS, _COUNTED = 50, 2.0
#: Words whose cells or scores a task keeps at a time.
_KEPT = 500_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the rows that may be learned from, one per id."""
    usable = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    return usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def cells_of(word: str) -> tuple[int, ...]:
    """The cells of a word's shorter prefixes, ascending in length, and of the word itself."""
    tokens = [word[:size] + "*" for size in PREFIXES if len(word) > size]
    mask = (1 << TABLE_BITS) - 1
    return tuple(xxhash.xxh64_intdigest(token) & mask for token in [*tokens, word])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers, by Stirling's series eight steps further on."""
    z, steps = x + 8, np.ones_like(x)
    for step in range(8):
        steps = steps * (x + step)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / z**2) / z**2) / z**2) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(steps)


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _log_gamma(a) + _log_gamma(b) - _log_gamma(a + b)


@dataclass
class ToxicityModel:
    """Texts per cell, all and toxic, the toxic share of all distinct words, and the calibration."""

    texts: np.ndarray
    toxic: np.ndarray
    share: float
    rate: float = 1.0
    density: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

    def word_scores(self, words: list[str], own: int | None = None) -> np.ndarray:
        """The shrunken log-odds of words; in a text that was counted with label ``own``, without
        that text."""
        most = len(PREFIXES) + 1
        padded = [(-1,) * (most - len(cells)) + cells for cells in map(cells_of, words)]
        cells = np.array(padded, np.int64).reshape(-1, most)
        toxic = np.where(cells < 0, 0, self.toxic[cells])
        clean = np.where(cells < 0, 0, self.texts[cells]) - toxic
        if own is not None:
            toxic, clean = np.maximum(toxic - own, 0), np.maximum(clean - 1 + own, 0)
        share, telling = np.full(len(words), self.share), np.full(len(words), TELLING)
        for place in range(most):
            in_toxic, in_clean = toxic[:, place], clean[:, place]
            if place + 1 < most:  # a prefix speaks for the others that have it
                in_toxic = np.maximum(in_toxic - toxic[:, place + 1], 0)
                in_clean = np.maximum(in_clean - clean[:, place + 1], 0)
            held = np.flatnonzero((cells[:, place] >= 0) & (in_toxic + in_clean > 0))
            t, c = in_toxic[held].astype(float), in_clean[held].astype(float)
            a, b = PRIOR_TEXTS * share[held], PRIOR_TEXTS * (1 - share[held])
            ratio = _log_beta(t + a, c + b) - _log_beta(a, b) - t * math.log(self.share) - c * math.log(1 - self.share)
            odds = telling[held] / (1 - telling[held]) * np.exp(np.clip(ratio, -600, 600))
            telling[held] = np.clip(odds / (1 + odds), 1e-12, 1 - 1e-12)
            share[held] = (t + a) / (t + c + PRIOR_TEXTS)
        return telling * (np.log(share / (1 - share)) - math.log(self.share / (1 - self.share)))

    def word_score(self, word: str, own: int | None = None) -> float:
        return float(self.word_scores([word], own)[0])


class _Cells(dict):
    """The cells of the words met last."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _KEPT:
            self.clear()
        found = self[word] = cells_of(word)
        return found


def texts_per_cell(labelled: DataFrame) -> DataFrame:
    """``cell, texts, marked`` of rows of ``text, toxic``: the rows that hold a token of the cell, and those of
    them that are toxic. Cell -1 adds up the distinct words of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, marked = (np.zeros(1 << TABLE_BITS, np.int32) for _ in range(2))
        total = [0, 0]
        of_word = _Cells()
        for batch in batches:
            for piece in pieces(batch):
                for text, toxic in zip(*[column.to_pylist() for column in piece.columns]):
                    words = set(words_of(text))
                    held = set()
                    for word in words:
                        held.update(of_word[word])
                    cells = np.fromiter(held, np.int32, len(held))
                    texts[cells] += 1
                    total[0] += len(words)
                    if toxic == 1:
                        marked[cells] += 1
                        total[1] += len(words)
        used = np.flatnonzero(texts)
        found = [np.append(used, -1), np.append(texts[used], total[0]), np.append(marked[used], total[1])]
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in found], ["cell", "texts", "marked"])

    partial = labelled.select("text", "toxic").mapInArrow(run, "cell long, texts long, marked long")
    return partial.groupBy("cell").agg(F.sum("texts").alias("texts"), F.sum("marked").alias("marked"))


def learn_tokens(labelled: DataFrame) -> ToxicityModel | None:
    """The counts of rows of ``text, toxic``; None unless both classes have words."""
    # At most a row per cell of the table.
    counts = texts_per_cell(labelled).toArrow()
    cells, all_texts, all_marked = (counts[name].to_numpy() for name in ("cell", "texts", "marked"))
    whole = cells == -1
    words, toxic_words = int(all_texts[whole].sum()), int(all_marked[whole].sum())
    if not 0 < toxic_words < words:
        return None
    texts, toxic = (np.zeros(1 << TABLE_BITS, np.int32) for _ in range(2))
    texts[cells[~whole]], toxic[cells[~whole]] = all_texts[~whole], all_marked[~whole]
    return ToxicityModel(texts, toxic, toxic_words / words)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence, as ``(first place, last place, score)``."""
    found: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum after, link
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    for place in np.flatnonzero(scores > 0).tolist():
        first, before, after = place, float(sums[place]), float(sums[place + 1])
        while True:
            # The last candidate that begins lower; links skip those that begin higher.
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                break
            first, before = found[j][0], found[j][2]
            del found[j:]
        found.append((first, place, before, after, j))
    return [(first, last, after - before) for first, last, before, after, _ in found]


def evidence(scores: list[float], words: int, rate: float, density: float) -> float:
    """What the significant segments have above the level of chance, or the best one lacks."""
    chance = math.log(density * max(1, words))
    above = [rate * score - chance for score in scores]
    if not above:
        return -max(0.0, chance)
    return sum(x for x in above if x > 0) if max(above) > 0 else max(above)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


_PASSAGE = T.StructType(
    [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]
)
_BIN = T.StructType([T.StructField("step", T.IntegerType()), T.StructField("n", T.LongType())])
_FOUND = [T.StructField("n_words", T.LongType()), T.StructField("passages", T.ArrayType(_PASSAGE))]
_SCANNED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), *_FOUND]
)
_SAMPLED = T.StructType(
    [T.StructField("toxic", T.IntegerType()), *_FOUND, T.StructField("steps", T.ArrayType(_BIN))]
)


class _Scanner:
    """Scores the words of many texts together and finds the segments of each."""

    def __init__(self, model: ToxicityModel, own: int | None = None):
        self.model, self.own, self.known = model, own, {}

    def scan(self, texts: list[str | None]) -> Iterator[tuple[str, np.ndarray, list[tuple[int, int, float]]]]:
        """The lower-cased text, the scores of its places and its segments, of every text."""
        plain = [(text or "").lower() for text in texts]
        words = [WORD.findall(text) for text in plain]
        firsts = [{word: place for place, word in reversed(list(enumerate(found)))} for found in words]
        new = {word for first in firsts for word in first if word not in self.known}
        if len(self.known) + len(new) > _KEPT:
            self.known.clear()
            new = {word for first in firsts for word in first}
        if new:
            listed = list(new)
            self.known.update(zip(listed, self.model.word_scores(listed, self.own).tolist()))
        for text, found, first in zip(plain, words, firsts):
            scores = np.full(len(found), -DRIFT)
            scores[list(first.values())] += [self.known[word] for word in first]
            yield text, scores, segments(scores)


def scan(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, text_hash, n_words, passages`` of every document: its significant passages by code point, end
    exclusive; or, where none is, the score of its best segment, at -1."""

    def make():
        scanner = _Scanner(model)

        def passages(text: str, scores: np.ndarray, found: list[tuple[int, int, float]]) -> list[dict]:
            chance = math.log(model.density * max(1, len(scores)))
            significant = [segment for segment in found if model.rate * segment[2] > chance]
            if not significant:
                return [{"start": -1, "end": -1, "score": s} for s in sorted(s for _, _, s in found)[-1:]]
            # Places in the lower-cased text; they are the text's own where lower case keeps lengths.
            places = [m.span() for m in WORD.finditer(text)]
            return [{"start": places[a][0], "end": places[b][1], "score": s} for a, b, s in significant]

        def work(doc_ids, text_hashes, texts):
            sizes, found = [], []
            for text, scores, segments_ in scanner.scan(texts):
                sizes.append(len(scores))
                found.append(passages(text, scores, segments_))
            return doc_ids, text_hashes, sizes, found

        return work

    return map_rows(documents.select("doc_id", _text_hash().alias("text_hash"), "text"), make, _SCANNED)


def _sampled(labelled: DataFrame, model: ToxicityModel) -> DataFrame:
    """``toxic, n_words, passages, steps`` of rows that were counted (``toxic, text``), each scored without
    itself; all segments are ``passages`` without a place, and ``steps`` are a histogram of the places' scores."""

    def make():
        by_label = [_Scanner(model, label) for label in (0, 1)]

        def work(toxic, texts):
            labels, sizes, found, listed = [], [], [], []
            for label, scanner in enumerate(by_label):
                own = [text for text, told in zip(texts, toxic) if told == label]
                for _, scores, segments_ in scanner.scan(own):
                    labels.append(label)
                    sizes.append(len(scores))
                    found.append([{"start": -1, "end": -1, "score": s} for _, _, s in segments_])
                    steps = np.unique(np.rint(scores * _STEPS), return_counts=True)
                    listed.append([{"step": int(x), "n": int(n)} for x, n in zip(*steps)])
            return labels, sizes, found, listed

        return work

    return map_rows(labelled.select("toxic", "text"), make, _SAMPLED)


def _rate(steps: list[tuple[int, int]]) -> float:
    """The positive exponent at which the expected score ratio of places (score in steps, number) is 1."""
    total = sum(n for _, n in steps)

    def excess(rate: float) -> float:
        return sum(n * math.exp(min(700.0, rate * step / _STEPS)) for step, n in steps) / max(1, total) - 1

    low, high = 1e-3, 50.0
    if not any(step > 0 for step, _ in steps) or excess(low) > 0:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _logistic(histogram: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope from ``(evidence, clean rows, toxic rows)``: Newton's method with
    halved steps, and a light pull of the slope to 0 so that separable classes stay finite."""

    def loss(a: float, b: float) -> float:
        total = 0.05 * b * b
        for x, clean, toxic in histogram:
            t = a + b * x
            softplus = max(t, 0.0) + math.log1p(math.exp(-abs(t)))
            total += (clean + toxic) * softplus - toxic * t
        return total

    a, b = 0.0, 0.0
    for _ in range(200):
        g0, g1, h00, h01, h11 = 0.0, -0.1 * b, 1e-9, 0.0, 0.1
        for x, clean, toxic in histogram:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * x))))
            n = clean + toxic
            g0, g1 = g0 + toxic - n * p, g1 + (toxic - n * p) * x
            w = n * p * (1 - p)
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        det = max(h00 * h11 - h01 * h01, 1e-300)
        step_a, step_b = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        before, size = loss(a, b), 1.0
        while size > 1e-8 and loss(a + size * step_a, b + size * step_b) > before:
            size /= 2
        a, b = a + size * step_a, b + size * step_b
        if abs(size * step_a) + abs(size * step_b) < 1e-9:
            break
    return a, b


def _chance(model: ToxicityModel) -> Column:
    return F.log(F.lit(model.density) * F.greatest(F.col("n_words"), F.lit(1)))


def _evidence_column(model: ToxicityModel) -> Column:
    """``evidence`` of a row of ``scan``, in SQL functions."""
    chance = _chance(model)
    above = F.transform("passages", lambda p: model.rate * p["score"] - chance)
    total = F.aggregate(F.filter(above, lambda x: x > 0), F.lit(0.0), lambda so_far, x: so_far + x)
    best = F.array_max(above)
    return F.when(F.size("passages") == 0, -F.greatest(chance, F.lit(0.0))).when(best > 0, total).otherwise(best)


def calibrate(documents: DataFrame, labels: DataFrame, model: ToxicityModel) -> None:
    """Set rate, density and curve from a sample of the labelled rows. The histograms have a fixed
    number of steps, whatever the number of rows."""
    draw = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(1 << 31))
    sample = labels.filter(draw < F.lit(CALIBRATION_ROWS / max(1, labels.count()) * (1 << 31)))
    # The sample is bounded, so that it may be broadcast.
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    scanned = materialize(_sampled(rows, model), "toxic-sample")
    clean = scanned.filter("toxic = 0")
    steps = clean.select(F.inline("steps")).groupBy("step").agg(F.sum("n").alias("n")).collect()
    model.rate = _rate([(row.step, row.n) for row in steps])
    many = F.size(F.filter("passages", lambda p: p["score"] >= _COUNTED))
    found = clean.agg(F.sum(many), F.sum("n_words")).first()
    model.density = ((found[0] or 0) + 0.5) / ((found[1] or 0) + 1.0) * math.exp(model.rate * _COUNTED)
    step = F.round(F.least(F.greatest(_evidence_column(model), F.lit(_EVIDENCE[0])), F.lit(_EVIDENCE[1])), 1)
    counts = scanned.groupBy(step.alias("x")).agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1))
    model.intercept, model.slope = _logistic([tuple(row) for row in counts.collect()])


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_words, passages, evidence, score`` of every document, learned from
    ``labels``; ``passages`` are the significant ones.

    The texts are shuffled once, to meet their labels, and scanned once. What was scanned is stored.
    """
    learnable = materialize(training_labels(labels), "toxic-labels")
    # The labels grow with the texts, so they are never broadcast, however few they are.
    model = learn_tokens(documents.select("doc_id", "text").join(learnable.hint("merge"), "doc_id"))
    if model is None:
        share = learnable.join(documents.select("doc_id"), "doc_id").agg(F.avg("toxic")).first()[0] or 0.0
        nothing = F.array().cast(T.ArrayType(_PASSAGE))
        rows = documents.select("doc_id", _text_hash().alias("text_hash"), F.lit(0).cast("long").alias("n_words"))
        return rows.withColumns({"passages": nothing, "evidence": F.lit(0.0), "score": F.lit(float(share))})
    calibrate(documents, learnable, model)
    scanned = materialize(scan(documents, model), "toxic-scan")
    found = scanned.withColumn("evidence", _evidence_column(model))
    bounded = F.least(F.greatest("evidence", F.lit(_EVIDENCE[0])), F.lit(_EVIDENCE[1]))
    curve = 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * bounded)))
    significant = F.filter("passages", lambda p: p["start"] >= 0)
    return found.withColumns({"score": curve, "passages": significant})


def accepted(documents: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents, with their own columns, whose score stays below ``least``."""
    keys = ["no_id", "id_key", "text_key"]

    def named(text_hash: Column) -> list[Column]:
        values = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), text_hash
        return [value.alias(key) for value, key in zip(values, keys)]

    scored = score_documents(documents, labels)
    rejected = scored.filter(F.col("score") >= least).select(*named(F.col("text_hash"))).distinct()
    rows = documents.select(F.struct("*").alias("row"), *named(_text_hash()))
    return rows.join(rejected.hint("merge"), keys, "left_anti").select("row.*")
