"""BPE encoding by tree concatenation, and decoding.

A text is cut into words as the tokenizer's file says. A short word is merged pair by pair,
lowest rank first and leftmost among equals. A long word without a break is halved until the
halves are short; at each join the last tokens of the left and the first of the right are
encoded anew, in windows that double until the first token of the window is the left side's
own and the last the right side's own. Then every pair of neighbours in the result stands in
the encoding of a text that contains both, which makes the whole the one encoding of the word.
The work of a join is local, so a word of n letters costs n log n in the worst case.

Texts are spread over the tasks by Spark; a task holds one text at a time and a bounded cache
of words. Result per text: ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``,
the tokens' texts joined by blanks, as the tokenizer has no decoder. A null or empty text gives
empty ids and an empty text; null ids or repeated rows are carried as they are; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from heapq import heapify, heappop, heappush

import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from logrisk.llm.rows import map_rows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Symbols that are merged directly; longer words are halved.
LEAF = 96
#: Symbols up to which all neighbours are looked at anew for each merge.
FEW = 24
#: Words kept with their tokens in each Python worker.
CACHE_WORDS = 400_000
_NONE = (1 << 62, 0)  # no merge; ranks are below

_ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^ \t-\ra-z0-9]+")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+")
_SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Scripts whose characters every Unicode version classifies alike; other texts are cut by the
#: library's own normalizer, so that new code points follow its tables.
_SETTLED = re.compile("[\x00-՗‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]*")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 characters for themselves, the
    others by code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class _Cache(dict):
    """Ids and tokens by word, emptied when full."""

    def __init__(self, encoder: WordBpe):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> tuple[bytes, str]:
        ids, token = self.encoder.encode_word(word), self.encoder.token
        found = struct.pack(f"<{len(ids)}I", *ids), " ".join([token[i] for i in ids])
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


class WordBpe:
    """Encoder for a tokenizer file of byte-level BPE with word ends."""

    def __init__(self, path: str = TOKENIZER, leaf: int = LEAF):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.path, self.leaf, self.end = path, leaf, model["end_of_word_suffix"]
        vocab = model["vocab"]
        self.token = {number: text for text, number in vocab.items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.token.update({number: text for text, number in self.special.items()})
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.width = {
            number: len(text.removesuffix(self.end)) for text, number in vocab.items()
        }
        self.splitter = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.cache = _Cache(self)
        self._library = None

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours, lowest rank first, leftmost among equal ranks."""
        return self._merge_few(symbols) if len(symbols) <= FEW else self._merge_many(symbols)

    def _merge_few(self, symbols: list[int]) -> list[int]:
        """By looking at all neighbours anew for each merge."""
        tokens, find = list(symbols), self.merges.get
        found = [find(pair, _NONE) for pair in zip(tokens, tokens[1:])]
        while found:
            best = min(found)
            if best is _NONE:
                break
            i = found.index(best)
            tokens[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = find((tokens[i - 1], best[1]), _NONE)
            if i < len(found):
                found[i] = find((best[1], tokens[i + 1]), _NONE)
        return tokens

    def _merge_many(self, symbols: list[int]) -> list[int]:
        """By a heap of the merges that are possible."""
        merges = self.merges
        n = len(symbols)
        tokens, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get((tokens[i], tokens[i + 1]))
            if found:
                heap.append((found[0], i, found[1]))
        heapify(heap)
        while heap:
            rank, i, new = heappop(heap)
            j = after[i]
            if tokens[i] is None or j >= n or merges.get((tokens[i], tokens[j])) != (rank, new):
                continue
            tokens[i], tokens[j] = new, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = merges.get((new, tokens[k]))
                if found:
                    heappush(heap, (found[0], i, found[1]))
            p = before[i]
            if p >= 0:
                found = merges.get((tokens[p], new))
                if found:
                    heappush(heap, (found[0], p, found[1]))
        return [token for token in tokens if token is not None]

    def encode_symbols(self, symbols: list[int]) -> list[int]:
        """Tokens of one word: leaves from left to right, joined as in a tree of halves."""
        if len(symbols) <= self.leaf:
            return self.merge(symbols)
        level = [
            (start, self.merge(symbols[start : start + self.leaf])) for start in range(0, len(symbols), self.leaf)
        ]
        while len(level) > 1:
            joined = [
                (left[0], self.join(symbols, right[0], left[1], right[1]))
                for left, right in zip(level[::2], level[1::2])
            ]
            level = joined + level[len(level) - len(level) % 2 :]
        return level[0][1]

    def join(self, symbols: list[int], middle: int, left: list[int], right: list[int]) -> list[int]:
        """One encoding from those of two neighbouring parts that meet at ``middle``."""
        width, size = self.width, 1
        while True:
            head, tail = left[-size:], right[:size]
            start = middle - sum(width[t] for t in head)
            stop = middle + sum(width[t] for t in tail)
            window = self.merge(symbols[start:stop])
            left_agrees = len(head) == len(left) or window[0] == head[0]
            right_agrees = len(tail) == len(right) or window[-1] == tail[-1]
            if left_agrees and right_agrees:
                return left[: len(left) - len(head)] + window + right[len(tail) :]
            size *= 2

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "surrogatepass")
        return self.encode_symbols([*(self.inner[b] for b in data[:-1]), self.last[data[-1]]])

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        if text.isascii():
            return _ASCII_WORDS.findall(text.lower())
        if _SETTLED.fullmatch(text):
            plain = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
            return _WORDS.findall(plain.replace("Σ", "σ").lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        plain = self._library.normalizer.normalize_str(text)
        return [plain[a:b] for _, (a, b) in self._library.pre_tokenizer.pre_tokenize_str(plain)]

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the decoded text."""
        pairs, start = [], 0
        text = text or ""
        for match in [*self.splitter.finditer(text), None]:
            words = self.words(text[start : match.start() if match else len(text)])
            pairs.extend(map(self.cache.__getitem__, words))
            if match:
                pairs.append((struct.pack("<I", self.special[match[0]]), match[0]))
                start = match.end()
        return b"".join([ids for ids, _ in pairs]), " ".join([decoded for _, decoded in pairs])

    def decode(self, ids: bytes) -> str:
        return " ".join([self.token[i] for (i,) in struct.iter_unpack("<I", ids)])


def encode_documents(documents: DataFrame, path: str = TOKENIZER, carried: list[str] | None = None) -> DataFrame:
    """``doc_id``, the ``carried`` columns, ``ids`` and ``decoded`` of every document."""
    rows = documents.select("doc_id", *(carried or []), "text")
    fields = [rows.schema[name] for name in rows.columns[:-1]]
    schema = T.StructType([*fields, T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def make():
        encoder = WordBpe(path)

        def work(*columns):
            pairs = [encoder.encode(text) for text in columns[-1]]
            return *columns[:-1], [ids for ids, _ in pairs], [decoded for _, decoded in pairs]

        return work

    return map_rows(rows, make, schema)
