"""Personal data by patterns, and terms that give it away by information-theoretic sanitisation.

Patterns find the protected entities: addresses, numbers and phones, leftmost and without
overlap per kind. The corpus then tells how strongly a term reveals an entity. With ``N`` texts,
a term and an entity that stand together in ``co`` texts, however far apart, have the pointwise
mutual information ``log2(N * co / (df(term) * df(entity)))``; the entity itself carries
``log2(N / df(entity))``. A term whose share of that information reaches ``DISCLOSURE`` is
sanitised wherever it occurs in texts of the entity: numbers and capitalised words are
generalised to their class, other words removed. Counts cover all texts; a pair must be seen in
``LEAST_TEXTS`` different texts, since a single one says nothing about co-occurrence: an entity of one text
alone is not protected against the words beside it.

Entities that stand in the same texts are given away by the same terms. Terms are counted with these classes of
entities, not with each of them, so that a long list of addresses does not multiply the words of its text.

A null or empty text holds nothing; ids may be null; repeated rows are handled each; an entity in
every text carries no information and is given away by nothing; an empty table gives an empty
result. Other columns are ignored by ``find`` and carried by ``sanitize``.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logrisk.llm.rows import map_rows
from logrisk.llm.terms import WORD, texts_per_word
from logrisk.sources.scratch import materialize

KINDS = ("email", "ip", "card", "phone")
ADDED = "term"
#: Least share of an entity's information that makes a term disclosing.
DISCLOSURE = 0.8
#: Different texts in which a term and an entity must stand together.
LEAST_TEXTS = 2
LEAST_LETTERS = 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
#: A match never begins within a run of digits, as the run before it would have matched too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Each address around an ``@``: the run of local characters before it and the domain after
    it. One linear pass, whatever the length of the runs."""
    found, end, at = [], 0, text.find("@")
    runs = _LOCAL.finditer(text) if at >= 0 else iter(())
    run = next(runs, None)
    while at >= 0:
        while run and run.end() < at:
            run = next(runs, None)
        start = max(run.start(), end) if run and run.end() == at else at
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, by kind and start."""
    found = [("email", *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = _DIGITS.sub("", match[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", match[0])) <= 15:
                found.append(("phone", *match.span()))
    return found


def terms(text: str, found: list[tuple[str, int, int]]) -> dict[str, list[tuple[int, int]]]:
    """Every term of a text and its places, outside of the entities."""
    taken = sorted((start, end) for _, start, end in found)
    places: dict[str, list[tuple[int, int]]] = {}
    i = 0
    for match in WORD.finditer(text):
        while i < len(taken) and taken[i][1] <= match.start():
            i += 1
        if i == len(taken) or match.end() <= taken[i][0]:
            term = match[0].lower()
            if len(term) >= LEAST_LETTERS:
                places.setdefault(term, []).append(match.span())
    return places


def entities(text: str, found: list[tuple[str, int, int]]) -> list[str]:
    """The distinct entities of a text."""
    return list(dict.fromkeys(f"{kind}:{text[start:end].lower()}" for kind, start, end in found))


def contexts(text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, str, list[tuple[int, int]]]]:
    """``(entity, term, places)`` for every entity and term of a text."""
    return [(entity, term, at) for entity in entities(text, found) for term, at in terms(text, found).items()]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_SPAN = _struct(("kind", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()))
_PLACE = _struct(("start", T.IntegerType()), ("end", T.IntegerType()))
_FOUND = _struct(
    ("doc_id", T.LongType()),
    ("text_hash", T.BinaryType()),
    ("base", T.ArrayType(_SPAN)),
    ("entities", T.ArrayType(T.StringType())),
    ("text", T.StringType()),
)
_CLASS = _struct(("texts", T.LongType()), ("one", T.LongType()), ("two", T.LongType()))
_TERMS = _struct(("classes", T.ArrayType(_CLASS)), ("copies", T.LongType()), ("terms", T.ArrayType(T.StringType())))
_ADDED = _struct(("text_hash", T.BinaryType()), ("places", T.ArrayType(_PLACE)))


def _text_hash(text: str | None) -> bytes:
    return hashlib.md5((text or "").encode("utf-8", "surrogatepass")).digest()


def _patterns(documents: DataFrame) -> DataFrame:
    """Base spans and entities of every document, and the text of those that hold an entity."""

    def make():
        def one(text: str | None):
            found = base_spans(text or "")
            spans = [{"kind": k, "start": a, "end": b} for k, a, b in found]
            return _text_hash(text), spans, entities(text or "", found), text if found else None

        def work(doc_ids, texts):
            rows = [one(text) for text in texts]
            return doc_ids, *([row[i] for row in rows] for i in range(4))

        return work

    return map_rows(documents.select("doc_id", "text"), make, _FOUND)


def _holders(found: DataFrame) -> DataFrame:
    """``text_hash, copies, entity`` of the distinct texts that hold an entity."""
    texts = found.filter("text IS NOT NULL").groupBy("text_hash")
    texts = texts.agg(F.count("*").alias("copies"), F.any_value("entities").alias("entities"))
    return texts.select("text_hash", "copies", F.explode("entities").alias("entity"))


def _with_text(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of distinct ``text_hash``, with the text."""
    texts = found.filter("text IS NOT NULL").groupBy("text_hash").agg(F.any_value("text").alias("text"))
    return rows.join(texts.hint("merge"), "text_hash")


def _pairs(found: DataFrame, held: DataFrame) -> DataFrame:
    """``class, term, copies`` of every distinct text (``text_hash, copies, class``) that holds both."""
    classes = held.groupBy("text_hash").agg(F.any_value("copies").alias("copies"), F.collect_list("class").alias("classes"))

    def make():
        def work(classes, copies, texts):
            return classes, copies, [list(terms(text, base_spans(text))) for text in texts]

        return work

    rows = map_rows(_with_text(classes, found).select("classes", "copies", "text"), make, _TERMS)
    rows = rows.select("classes", "copies", F.explode("terms").alias("term"))
    return rows.select(F.explode("classes").alias("class"), "term", "copies")


def disclosing(found: DataFrame, documents: DataFrame, least_texts: int = LEAST_TEXTS) -> tuple[DataFrame, DataFrame]:
    """``text_hash, class`` of the texts that hold entities of ``least_texts`` texts, and ``class, term`` of the
    terms that give the entities of a class away. A class is told by its number of texts and two hashes of them."""
    n = found.count()
    holders = _holders(found)
    one, two = F.bit_xor(F.xxhash64("text_hash")), F.bit_xor(F.xxhash64(F.lit(1), "text_hash"))
    texts = F.struct(F.count("*").alias("texts"), one.alias("one"), two.alias("two")).alias("class")
    known = holders.groupBy("entity").agg(texts, F.sum("copies").alias("with_entity"))
    # Only an entity of that many different texts can be seen as often with a term.
    known = materialize(known.filter(F.col("class.texts") >= least_texts), "pii-entities")
    held = holders.join(known, "entity").select("text_hash", "copies", "class").distinct()
    held = materialize(held, "pii-texts")
    together = _pairs(found, held).groupBy("class", "term")
    together = together.agg(F.sum("copies").alias("co"), F.count("*").alias("texts"))
    together = materialize(together.filter(F.col("texts") >= least_texts).drop("texts"), "pii-pairs")
    words = texts_per_word(documents.select("text", F.lit(0).alias("mark")))
    seen = together.select("term").distinct()
    with_term = words.select(F.col("word").alias("term"), F.col("texts").alias("with_term")).join(seen, "term")
    with_entity = known.groupBy("class").agg(F.any_value("with_entity").alias("with_entity"))
    information = F.log2(F.lit(float(n)) / F.col("with_entity"))
    shared = F.log2(F.lit(float(n)) * F.col("co") / (F.col("with_term") * F.col("with_entity")))
    scored = together.join(with_term, "term").join(with_entity, "class")
    scored = scored.filter(F.try_divide(shared, information) >= DISCLOSURE)
    return held.select("text_hash", "class"), scored.select("class", "term")


def _added(found: DataFrame, held: DataFrame, flagged: DataFrame) -> DataFrame:
    """``text_hash, places`` of the flagged terms in every distinct text that holds entities of their class."""
    wanted = held.join(flagged, "class").groupBy("text_hash").agg(F.collect_set("term").alias("wanted"))

    def make():
        def one(text: str, wanted: list[str]) -> list[dict]:
            at = terms(text, base_spans(text))
            return [{"start": a, "end": b} for a, b in sorted(span for term in wanted for span in at.get(term, ()))]

        def work(hashes, wanted, texts):
            return hashes, [one(text, words) for text, words in zip(texts, wanted)]

        return work

    return map_rows(_with_text(wanted, found).select("text_hash", "wanted", "text"), make, _ADDED)


def find(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, base, added`` of every document: spans by kind and start.

    Texts are scanned twice. What the patterns found is stored in between, with the texts that hold
    an entity; only these are shuffled, to meet the entities seen twice and the flagged terms.
    """
    found = materialize(_patterns(documents), "pii-found")
    held, flagged = disclosing(found, documents)
    rows = found.filter("text IS NOT NULL").select("doc_id", "text_hash").distinct()
    added = rows.join(_added(found, held, flagged), "text_hash").select(
        F.col("doc_id").alias("added_id"), F.col("text_hash").alias("added_hash"), "places"
    )
    same = F.col("doc_id").eqNullSafe(F.col("added_id")) & (F.col("text_hash") == F.col("added_hash"))
    span = lambda p: F.struct(F.lit(ADDED).alias("kind"), p["start"].alias("start"), p["end"].alias("end"))
    places = F.transform("places", span)
    none = F.array().cast(T.ArrayType(_SPAN))
    return found.join(added, same, "left").select("doc_id", "text_hash", "base", F.coalesce(places, none).alias("added"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(one, ",")


def _generalised(word: str) -> str:
    if word.isdigit():
        return "[NUMBER]"
    return "[NAME]" if word[:1].isupper() else ""


def redact(text: str, spans: list) -> str:
    """Entities as their kind, disclosing numbers and names as their class, other terms removed.
    Where spans overlap the one that begins first counts, then the longer."""
    out, end = [], 0
    for span in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if span["start"] < end:
            continue
        piece = text[span["start"] : span["end"]]
        out += [text[end : span["start"]], _generalised(piece) if span["kind"] == ADDED else f"[{span['kind'].upper()}]"]
        end = span["end"]
    return "".join([*out, text[end:]])


def sanitize(documents: DataFrame) -> DataFrame:
    """The documents with their own columns, spans replaced in ``text``; ``n_chars``, where it is
    a column, follows the text. The texts are shuffled once, to meet their spans."""
    spans = find(documents).filter((F.size("base") > 0) | (F.size("added") > 0))
    spans = spans.select(
        F.col("doc_id").alias("span_id"), F.col("text_hash").alias("span_hash"), F.concat("base", "added").alias("spans")
    ).dropDuplicates(["span_id", "span_hash"])
    row_hash = F.unhex(F.md5("text")).alias("row_hash")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("row_id"), row_hash)
    same = F.col("row_id").eqNullSafe(F.col("span_id")) & (F.col("row_hash") == F.col("span_hash"))
    joined = rows.join(spans, same, "left").select("row", F.col("row.text").alias("text"), "spans")

    replace = F.udf(lambda text, spans: redact(text, spans) if spans and text else text, "string", useArrow=True)
    def column(name: str, kind: str) -> Column:
        if name == "text":
            return F.col("text")
        return F.length("text").cast(kind).alias(name) if name == "n_chars" else F.col("row").getField(name).alias(name)

    replaced = joined.withColumn("text", replace("text", "spans"))
    return replaced.select(*[column(name, kind) for name, kind in documents.dtypes])
