"""Token counts of a unigram vocabulary by a count-only Viterbi pass.

The vocabulary is a list of pieces with scores. Text is cut at blanks, each blank (U+0020 or
the mark U+2581) opening a word, and a text that does not begin with one is given one. Within a
word an Aho-Corasick automaton enumerates every piece that ends at each position; dynamic
programming carries the best score and its number of tokens, without back pointers. Ties follow
the tokenizer: among equal scores at one position the longest piece wins, as the pieces are tried
from the earliest start and only a better score replaces. A character that is no piece costs the
lowest score less 10; such characters become their bytes where the vocabulary has byte pieces,
and otherwise one unknown token per run.

A character that occurs in no piece cuts a word as well, since every path passes both of its
sides; line ends are cut this way, so that a worker's bounded cache of words meets few new
ones. Whole texts of any length are counted, one at a time in a task. A null or empty text has 0 tokens; ids may be
null or repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import ahocorasick
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logrisk.llm.rows import map_rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 500_000


def read_pieces(path: str = PIECES) -> list[tuple[str, float]]:
    """Pieces and scores of a piece model file, in id order; the first is the unknown piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class _Words(dict):
    """Token counts by word, emptied when full."""

    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        found = self.count(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


class UnigramCounter:
    def __init__(self, pieces: Sequence[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {piece for piece, _ in pieces}
        self.single = {piece for piece in names if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        lines_cut = self.bytes and not any("\n" in piece for piece in names)
        cut = f"{MARK}[^{MARK}\n]*|[^{MARK}\n]+|\n" if lines_cut else f"{MARK}[^{MARK}]*"
        self.units = re.compile(cut).findall
        self.words = _Words(self.count_word)

    def count_word(self, word: str) -> int:
        n = len(word)
        score, count, run = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(word)
        at, found = next(matches, (n, None))
        for i in range(n):
            best = None
            while at == i:
                length, own = found
                start = i + 1 - length
                value = own + score[start]
                if best is None or value > best:
                    best, tokens = value, count[start] + 1
                at, found = next(matches, (n, None))
            unknown = False
            if word[i] not in self.single:
                value = self.unknown + score[i]
                if best is None or value > best:
                    unknown, best = True, value
                    if self.bytes:
                        tokens = count[i] + len(word[i].encode("utf-8", "surrogatepass"))
                    else:
                        tokens = count[i] + (not run[i])
            score[i + 1], count[i + 1], run[i + 1] = best, tokens, unknown
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if not marked.startswith(MARK):
            marked = MARK + marked
        return sum(map(self.words.__getitem__, self.units(marked)))


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def count_tokens(documents: DataFrame, path: str = PIECES) -> DataFrame:
    """``doc_id, n_chars, n_tokens`` of every document; ``n_chars`` are code points."""

    def make():
        counter = UnigramCounter(read_pieces(path))

        def work(doc_ids, texts):
            return doc_ids, [len(text or "") for text in texts], [counter.count(text) for text in texts]

        return work

    return map_rows(documents.select("doc_id", "text"), make, SCHEMA)
