"""Byte-level BPE by dynamic programming over prefixes.

For every byte prefix of a word there is exactly one last token that a valid encoding of the prefix can end in, and
following those last tokens backwards gives the encoding. A token may follow another if encoding the two tokens'
bytes gives the two tokens again. So a longer word is encoded by extending the table of a shorter one, and after an
edit only the words near it are done again.

Defined results: a null text and an empty text both have the ids ``[]``.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.session import spread

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern that splits text into words for this vocabulary.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose ids a task keeps; beyond it the table is begun anew, so a task's memory is bounded.
KEPT_WORDS = 400_000


class Vocabulary:
    """Ranked byte tokens with the test whether one token may follow another."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = {v: k for k, v in ranks.items()}
        self._follows: dict[tuple[int, int], bool] = {}
        self._split: dict[int, tuple[int, int] | None] = {}

    @classmethod
    def load(cls, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Vocabulary:
        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as file:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token`` (None for a single byte): the cut at which both sides are
        tokens of lower rank that may follow one another."""
        if token not in self._split:
            word, found = self.bytes_of[token], None
            parts = [self.ranks[word[k : k + 1]] for k in range(len(word))]
            while len(parts) > 2:
                ranked = [(self._merged(a, b), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
                low, k = min((r, k) for r, k in ranked if r is not None)
                parts[k : k + 2] = [low]
            if len(parts) == 2:
                found = (parts[0], parts[1])
            self._split[token] = found
        return self._split[token]

    def _merged(self, a: int, b: int) -> int | None:
        return self.ranks.get(self.bytes_of[a] + self.bytes_of[b])

    def may_follow(self, a: int, b: int) -> bool:
        """True if the bytes of ``a`` and ``b`` together are encoded as those two tokens.

        The tokens are taken apart again in the reverse order of their merges. If at some point the two parts that
        touch could have merged before the younger part came to be, the boundary would not have survived.
        """
        known = self._follows.get((a, b))
        if known is None:
            left, right, before = a, b, len(self.ranks) + 1
            known = True
            while True:
                joined = self._merged(left, right)
                if joined is not None and joined < before and self.halves(joined) == (left, right):
                    known = False
                    break
                # Undo the latest merge next to the boundary; on the left a tie is undone later.
                sides = [(t, s) for t, s in ((left, 1), (right, 0)) if self.halves(t)]
                if not sides:
                    break
                latest, side = max(sides, key=lambda x: (x[0], -x[1]))
                if side:
                    left, before = self.halves(latest)[1], latest
                else:
                    right, before = self.halves(latest)[0], latest + 1
            self._follows[(a, b)] = known
        return known


class PrefixTable:
    """The unique valid last token of every byte prefix of one word; grows by exact appends."""

    __slots__ = ("vocabulary", "word", "last")

    def __init__(self, vocabulary: Vocabulary, word: bytes = b"") -> None:
        self.vocabulary, self.word, self.last = vocabulary, b"", []
        self.append(word)

    def append(self, more: bytes) -> PrefixTable:
        """Extends the table; entries of the old prefix stay as they are."""
        v, ranks, last = self.vocabulary, self.vocabulary.ranks, self.last
        word = self.word = self.word + more
        for end in range(len(last) + 1, len(word) + 1):
            for start in range(max(0, end - v.longest), end):
                token = ranks.get(word[start:end])
                if token is not None and (start == 0 or v.may_follow(last[start - 1], token)):
                    last.append(token)
                    break
        return self

    def cut_back(self, length: int) -> PrefixTable:
        """Keeps the first ``length`` bytes."""
        self.word = self.word[:length]
        del self.last[length:]
        return self

    def ids(self) -> list[int]:
        out, end = [], len(self.word)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


def _members(of: str) -> str:
    """The two-byte code points that ``of`` matches, as the inside of a character class."""
    points = [ord(c) for c in regex.findall(of, "".join(chr(o) for o in range(0x10000) if not 0xD800 <= o < 0xE000))]
    begins = [x for n, x in enumerate(points) if not n or points[n - 1] != x - 1]
    ends = [x for n, x in enumerate(points) if n + 1 == len(points) or points[n + 1] != x + 1]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(begins, ends))


@lru_cache(maxsize=4)
def word_splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text.

    Its classes of letters, numbers and spaces are written out for two-byte code points, so that the standard library's
    faster matcher does for texts without others; they are taken from the matcher that knows them, so both agree.
    """
    slow = regex.compile(pattern).findall
    letters, numbers, spaces = (_members(c) for c in (r"\p{L}", r"\p{N}", r"\s"))
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    for name, members in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", spaces)):
        plain = plain.replace(name, f"[{members}]")
    fast = re.compile(plain.replace(r"\S", f"[^{spaces}]")).findall

    def split(text: str) -> list[str]:
        two_bytes = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return fast(text) if two_bytes else slow(text)

    return split


class Encoder:
    """Texts to ids; words seen before come from a bounded table."""

    def __init__(self, vocabulary: Vocabulary, pattern: str = WORD_PATTERN, kept: int = KEPT_WORDS) -> None:
        self.vocabulary, self.kept = vocabulary, kept
        self.words = word_splitter(pattern)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.flat = array("q", [0]), array("i")

    def word_ids(self, word: str) -> list[int]:
        return PrefixTable(self.vocabulary, word.encode("utf-8", "replace")).ids()

    def _learn(self, word: str) -> int:
        self.flat.extend(self.word_ids(word))
        self.start.append(len(self.flat))
        n = self.number[word] = len(self.number)
        return n

    def encode(self, text: str | None) -> list[int]:
        values, _ = self.encode_batch([text])
        return values.tolist()

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts)."""
        if len(self.number) > self.kept:
            self.clear()
        number, learn, split = self.number, self._learn, self.words
        pieces, counts = array("i"), np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                words = split(text)
                try:
                    pieces.extend([number[w] for w in words])
                except KeyError:
                    for w in words:
                        if w not in number:
                            learn(w)
                    pieces.extend([number[w] for w in words])
                counts[k] = len(words)
        picked = np.frombuffer(pieces, np.int32) if len(pieces) else np.empty(0, np.int32)
        start, flat = np.frombuffer(self.start, np.int64), np.array(self.flat, np.int32) if len(self.flat) else np.empty(0, np.int32)
        lengths = (start[1:] - start[:-1])[picked]
        ends = np.cumsum(lengths)
        begin = ends - lengths
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(start[:-1][picked] - begin, lengths) + np.arange(total)
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(counts)]]
        del start
        return flat[at], bounds


class EditableText:
    """A text with its ids that takes appends and edits, encoding again only the words an edit can reach."""

    def __init__(self, encoder: Encoder, text: str = "") -> None:
        self.encoder, self.text = encoder, ""
        self.ends: list[int] = []  # ends of the words, in characters
        self.tables: list[PrefixTable] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> EditableText:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> EditableText:
        """Puts ``new`` in place of characters [start, stop)."""
        v = self.encoder.vocabulary
        # A word depends on its own characters and at most the next two, so words that end before that are kept.
        keep = int(np.searchsorted(self.ends, start - 2, "right")) if self.ends else 0
        moved = len(new) - (stop - start)
        text = self.text[:start] + new + self.text[stop:]
        at = self.ends[keep - 1] if keep else 0
        old = {e + moved: k for k, e in enumerate(self.ends) if e >= stop and k >= keep}
        ends, tables, spare = [], [], self.tables[keep] if keep < len(self.tables) else None
        rest: list[int] = []
        for m in regex.compile(WORD_PATTERN).finditer(text, at):
            word = m[0].encode("utf-8", "replace")
            if spare is not None and word.startswith(spare.word):
                tables.append(spare.append(word[len(spare.word) :]))
            else:
                tables.append(PrefixTable(v, word))
            spare = None
            ends.append(m.end())
            if m.end() in old and m.end() >= start + len(new):
                k = old[m.end()] + 1
                ends += [e + moved for e in self.ends[k:]]
                rest = self.tables[k:]
                break
        self.text, self.ends, self.tables = text, self.ends[:keep] + ends, self.tables[:keep] + tables + rest
        return self

    def ids(self) -> list[int]:
        return [i for t in self.tables for i in t.ids()]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder_of_process(name: str, folder: str, ranks: dict[bytes, int]) -> Encoder:
    """The encoder that tasks of one Python process share, with the words that earlier tasks have met."""
    if (name, folder) not in _ENCODERS:
        _ENCODERS[name, folder] = Encoder(Vocabulary(ranks))
    return _ENCODERS[name, folder]


def encode_corpus(
    texts: DataFrame, key: str = "doc_id", column: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS,
) -> DataFrame:
    """(key, ids) of every row: one pass, no shuffle; the vocabulary (under 2 MB) goes along once a task process."""
    shared = texts.sparkSession.sparkContext.broadcast(Vocabulary.load(name, folder).ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of_process(name, folder, shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                values, bounds = encoder.encode_batch(part.column(1).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["key", "ids"])

    kind = texts.schema[key].dataType.simpleString()
    return spread(texts.select(key, column)).mapInArrow(run, f"key {kind}, ids array<int>").select(F.col("key").alias(key), "ids")


def edited_alike(
    texts: DataFrame, key: str = "doc_id", column: str = "text", name: str = "byte_bpe_50k", folder: str = TOKENIZERS,
) -> DataFrame:
    """(key, same): whether a text's ids after an edit in its middle and an append equal those of the edited text encoded whole."""
    shared = texts.sparkSession.sparkContext.broadcast(Vocabulary.load(name, folder).ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of_process(name, folder, shared.value)
        for batch in batches:
            same = []
            for text in batch.column(1).to_pylist():
                kept, half = EditableText(encoder, text or ""), len(text or "") // 2
                kept.replace(half, min(half + 3, len(kept.text)), "n't 42").append(" the end")
                same.append(kept.ids() == encoder.encode(kept.text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.bool_())], ["key", "same"])

    kind = texts.schema[key].dataType.simpleString()
    return spread(texts.select(key, column)).mapInArrow(run, f"key {kind}, same boolean").select(F.col("key").alias(key), "same")
