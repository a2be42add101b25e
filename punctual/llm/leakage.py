"""Evaluation passages inside corpus documents, by greedy string tiling.

Items are the stated query set: they are taken in blocks of bounded size, each broadcast as a seed index, and every
document passes each block once, without a shuffle. Within a document, five-word seeds (rolling Karp-Rabin hashes)
shared with an item are joined to maximal matches; the longest match that overlaps no marked one is marked, again and
again, and an item whose matches cover too few words is dropped. The rest is checked exactly against the stated rule:
on the diagonals of its matches, and by an alignment around them where words were put in or left out.

Defined results: null, empty and word-less documents or items leak nothing; repeated item or document rows give one
row; items shorter than ``min_words`` words never match; a word put in, left out or replaced counts as one altered.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.lookalike import Rewriter
from punctual.llm.spoken import spoken_words, word_rewriter
from punctual.session import shared_path, spread

SEED_WORDS = 5
#: Shared seeds of one item and one document that are held at once; more are taken range by range of diagonals.
PAIRS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LeakRule:
    """A leak holds ``min_words`` consecutive item words, at most one in ``one_in`` of them altered."""

    min_words: int = 18
    one_in: int = 8

    def least_tiled(self) -> int:
        """Words of seed-long runs that any leak has: with a altered words there are a + 1 runs, of which all but
        one may be shorter than a seed."""
        return min(
            max(SEED_WORDS, (k - k // self.one_in) - (k // self.one_in) * (SEED_WORDS - 1))
            for k in range(self.min_words, self.min_words + 2 * self.one_in)
        )


def rolling_hashes(words: np.ndarray) -> np.ndarray:
    """Karp-Rabin hash of every window of ``SEED_WORDS`` word ids (modulo 2**64)."""
    n = len(words) - SEED_WORDS + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(SEED_WORDS):
        h = h * _BASE + words[k : k + n].astype(np.uint64)
    return h


class SeedIndex:
    """The items of one block: vocabulary, word ids and a sorted index of their seeds."""

    def __init__(self, items: list[tuple[object, list[str]]]) -> None:
        self.ids = [i for i, _ in items]
        self.vocabulary = {w: n + 1 for n, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.words = [np.array([self.vocabulary[w] for w in ws], np.int64) for _, ws in items]
        self.seeds = [rolling_hashes(ws) for ws in self.words]
        h = np.concatenate(self.seeds) if self.seeds else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(items)), [len(x) for x in self.seeds])
        order = np.argsort(h, kind="stable")
        self.hashes, self.owner = h[order], owner[order]
        self.distinct = np.unique(self.hashes)

    def likely(self, seeds: np.ndarray, least: int) -> list[int]:
        """Items of which at least ``least`` seeds are among a document's distinct ``seeds``.

        Each of an item's seeds counts once, however often the document repeats it.
        """
        lo, hi = np.searchsorted(self.hashes, seeds, "left"), np.searchsorted(self.hashes, seeds, "right")
        n = hi - lo
        at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        items, count = np.unique(self.owner[at], return_counts=True)
        return items[count >= least].tolist()


def runs(item: np.ndarray, sorted_doc: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item position, document position, length) of every maximal match of ``SEED_WORDS`` words or more.

    ``item`` has the item's seeds, ``sorted_doc`` the document's in order of hash with their ``position``. Seeds that
    follow one another on a diagonal are one match.
    """
    lo, hi = np.searchsorted(sorted_doc, item, "left"), np.searchsorted(sorted_doc, item, "right")
    total, size = int((hi - lo).sum()), len(position) + len(item)
    pieces = max(1, -(-total // PAIRS))
    out = []
    for a in range(-len(item), len(position), -(-size // pieces)):
        low, high = lo, hi
        if pieces > 1:  # shared seeds on the diagonals from a on; a diagonal lies in one piece
            b = a + -(-size // pieces)
            low, high = lo.copy(), hi.copy()
            for i in range(len(item)):
                mine = position[lo[i] : hi[i]]
                low[i], high[i] = lo[i] + np.searchsorted(mine, a + i), lo[i] + np.searchsorted(mine, b + i)
        n = high - low
        if not n.any():
            continue
        i = np.repeat(np.arange(len(item)), n)
        d = position[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
        shift = d - i
        order = np.lexsort((i, shift))
        i, shift = i[order], shift[order]
        first = np.flatnonzero(np.r_[True, (shift[1:] != shift[:-1]) | (i[1:] != i[:-1] + 1)])
        length = np.diff(np.r_[first, len(i)]) + SEED_WORDS - 1
        out.append((i[first], i[first] + shift[first], length))
        if pieces == 1:
            break
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate([x[k] for x in out]) for k in range(3))


def tiles(found: tuple[np.ndarray, np.ndarray, np.ndarray], n_item: int, n_doc: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of maximal matches: (item position, document position, length), none overlapping another.

    The longest goes first; ties go to the earlier item position, then the earlier document position.
    """
    pending = list(zip((-found[2]).tolist(), found[0].tolist(), found[1].tolist()))
    heapq.heapify(pending)
    used_i, used_d, out, left = np.zeros(n_item, bool), np.zeros(n_doc, bool), [], n_item
    while pending and left >= SEED_WORDS:
        n, i, d = heapq.heappop(pending)
        taken = used_i[i : i - n] | used_d[d : d - n]
        if not taken.any():
            out.append((i, d, -n))
            used_i[i : i - n] = used_d[d : d - n] = True
            left += n
            continue
        # What is left of a match that an earlier tile cut.
        edge = np.flatnonzero(np.diff(np.r_[True, taken, True].astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= SEED_WORDS:
                heapq.heappush(pending, (a - b, i + a, d + a))
    return sorted(out)


def on_diagonal(item: np.ndarray, doc: np.ndarray, shift: int, rule: LeakRule) -> bool:
    """Some window of the item stands ``shift`` words further in the document as the rule says.

    Positions outside the document aren't part of it, so windows stay inside.
    """
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi - lo < rule.min_words:
        return False
    wrong = item[lo:hi] != doc[lo + shift : hi + shift]
    # A window holds if this doesn't fall from its begin to its end.
    score = np.arange(hi - lo + 1) - rule.one_in * np.r_[0, np.cumsum(wrong)]
    return bool(np.any(score[rule.min_words :] >= np.minimum.accumulate(score)[: -rule.min_words]))


def aligned(item: np.ndarray, doc: np.ndarray, rule: LeakRule) -> bool:
    """Some window of the item stands in ``doc`` with at most one in ``one_in`` words replaced, put in or left out.

    Windows of up to twice ``min_words`` are enough: a longer one holds a shorter one that is as good.
    """
    longest = min(len(item), 2 * rule.min_words - 1)
    starts = len(item) - rule.min_words + 1
    if starts <= 0 or not len(doc):
        return False
    step = np.arange(len(doc) + 1)
    padded = np.r_[item, np.full(longest, -1)]
    cost = np.zeros((starts, len(doc) + 1), np.int64)  # of the window from each start, ending at each place
    for n in range(1, longest + 1):
        word = padded[n - 1 : n - 1 + starts, None]
        after = cost + 1
        np.minimum(after[:, 1:], cost[:, :-1] + (word != doc[None, :]), out=after[:, 1:])
        cost = np.minimum.accumulate(after - step, axis=1) + step
        if n >= rule.min_words:
            inside = starts - max(0, n - rule.min_words)
            if (cost[:inside].min() if inside > 0 else n) * rule.one_in <= n:
                return True
    return False


def holds(item: np.ndarray, doc: np.ndarray, found: tuple[np.ndarray, np.ndarray, np.ndarray], rule: LeakRule) -> bool:
    """The exact check, near all maximal matches, marked as tiles or not.

    Any leak has ``least_tiled`` words in matches that lie close together: on one diagonal, or, where words were put in
    or left out, within the length of a window.
    """
    at, to, length = found
    need = rule.least_tiled()
    shift = to - at
    order = np.argsort(shift, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(shift[order]) != 0])
    covered = np.add.reduceat(length[order], first)
    if any(on_diagonal(item, doc, int(s), rule) for s in shift[order][first][covered >= need]):
        return True
    reach = 2 * rule.min_words + 2 * rule.min_words // rule.one_in
    order = np.argsort(to, kind="stable")
    at, to, length = at[order], to[order], length[order]
    seen = set()
    sums = np.r_[0, np.cumsum(length)]
    near = sums[np.searchsorted(to, to + length + reach, "right")] - sums[np.searchsorted(to, to - reach - length.max(), "left")]
    for k in np.flatnonzero(near >= need).tolist():
        i, d, n = int(at[k]), int(to[k]), int(length[k])
        part, around = item[max(0, i - reach) : i + n + reach], doc[max(0, d - reach) : d + n + reach]
        key = i, n, around.tobytes()
        if key not in seen:  # a refrain has one look
            seen.add(key)
            if aligned(part, around, rule):
                return True
    return False


def leaks_of(doc: np.ndarray, index: SeedIndex, rule: LeakRule) -> Iterator[tuple[object, int]]:
    """(item id, tiled words) of every item that leaked into a document of word ids (0: in no item)."""
    h = rolling_hashes(doc)
    if not len(h) or not len(index.distinct):
        return
    spot = np.searchsorted(index.distinct, h)
    spot[spot == len(index.distinct)] = 0
    at = np.flatnonzero(index.distinct[spot] == h)
    if not len(at):
        return
    order = np.argsort(h[at], kind="stable")
    seeds, position = h[at][order], at[order]
    need = rule.least_tiled()
    for o in index.likely(np.unique(seeds), need - SEED_WORDS + 1):
        item = index.words[o]
        if len(item) < rule.min_words:
            continue
        found = runs(index.seeds[o], seeds, position)
        covered = sum(n for _, _, n in tiles(found, len(item), len(doc)))
        if covered >= need and holds(item, doc, found, rule):
            yield index.ids[o], covered


def _words(texts: DataFrame, rewriter: Rewriter) -> DataFrame:
    """(key, words): the spoken words of each text, one space between them."""
    key, column = texts.columns
    shared = texts.sparkSession.sparkContext.broadcast(rewriter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [" ".join(spoken_words(t, shared.value)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.string())], ["key", "words"])

    return texts.mapInArrow(run, f"key {texts.schema[key].dataType.simpleString()}, words string")


def _item_blocks(items: DataFrame, max_items: int, max_chars: int) -> Iterator[list]:
    """Blocks of (id, words), bounded in number and in characters, streamed to the driver one after the other."""
    block, size = [], 0
    for row in items.toLocalIterator():
        if block and (len(block) >= max_items or size + len(row.words) > max_chars):
            yield block
            block, size = [], 0
        block.append((row.key, row.words.split()))
        size += len(row.words)
    if block:
        yield block


def _search(rows: DataFrame, index: SeedIndex, rule: LeakRule, schema: str, words_of: Callable[[str | None], list[str]]) -> DataFrame:
    """Leaks of one block of items; ``words_of`` gives the words of the second column."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    item_type = pa.array([index.ids[0]]).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        known = index.vocabulary.get
        for batch in batches:
            docs, found, sizes = [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if len(words) < SEED_WORDS:
                    continue
                for item, n in leaks_of(np.array([known(w, 0) for w in words], np.int64), index, rule):
                    docs.append(i)
                    found.append(item)
                    sizes.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, batch.schema.types[0]), pa.array(found, item_type), pa.array(sizes, pa.int32())], ["doc", "item", "tiled_words"]
            )

    return rows.mapInArrow(run, schema)


def find_leaks(
    documents: DataFrame, items: DataFrame, rule: LeakRule = LeakRule(), key: str = "doc_id", item_key: str = "item_id",
    column: str = "text", max_items: int = 50_000, max_chars: int = 16_000_000, rewriter: Rewriter | None = None,
) -> DataFrame:
    """(doc id, item id, tiled_words) for every document that contains a passage of an item.

    Each block of items is broadcast (its index has about eight bytes a character, 130 MB at most, but for a single
    item that is longer). The documents never move; if there are several blocks their words are made once and written
    to the shared folder, and so are the leaks of each block, whose broadcast is then given up.
    """
    spark = documents.sparkSession
    rewriter = rewriter if rewriter and rewriter.fold_case else word_rewriter()
    kinds = documents.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"doc {kinds[0]}, item {kinds[1]}, tiled_words int"
    given = items.where(F.col(column).isNotNull()).select(item_key, column).distinct()
    blocks = _item_blocks(_words(given, rewriter), max_items, max_chars)
    first, second = next(blocks, None), next(blocks, None)
    texts = spread(documents.select(key, column))
    if first is None:
        out = spark.createDataFrame([], schema)
    elif second is None:
        out = _search(texts, SeedIndex(first), rule, schema, lambda text: spoken_words(text, rewriter))
    else:
        words, folder = shared_path(spark, "words"), shared_path(spark, "leaks")
        _words(texts, rewriter).write.parquet(words)
        while first is not None:
            _search(spark.read.parquet(words), SeedIndex(first), rule, schema, str.split).write.mode("append").parquet(folder)
            first, second = second, next(blocks, None)
        out = spark.read.parquet(folder)
    return out.groupBy(F.col("doc").alias(key), F.col("item").alias(item_key)).agg(F.max("tiled_words").alias("tiled_words"))
