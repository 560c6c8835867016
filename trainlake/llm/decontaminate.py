"""Benchmark decontamination with a BM25 index of the test items.

Every training text is cut into overlapping passages, twice as long as the longest item and
one item apart, so that each place of an item lies whole in a passage. Every passage queries the
inverted index of the items: scores are BM25 shares of the item's own full score, so one
threshold holds for all items, and block-max WAND finds all items at or above it while skipping
those that their blocks' bounds rule out. Blocks are ranges of items, the same for all words, so the bounds of all
passages of a text are summed at once and WAND walks only the blocks that can reach the threshold. An item that is found counts if its question and its
answer, each for itself, overlap with the passage.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainlake.llm.common import fresh

K1, B = 1.2, 0.75
SHARE = 0.6
OVERLAP = 0.8
NGRAM = 5
#: Items in a block.
POSTING_BLOCK = 4
#: Bounds that are summed at a time, for as many passages as that allows.
ENTRIES = 2_000_000
#: An index block, broadcast to all tasks, holds items of about so many characters, or one longer item.
INDEX_CHARS = 16 << 20
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.?!]\s+|\n+")

LEAK = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("question", T.DoubleType()), T.StructField("answer", T.DoubleType()),
]))


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; of a single sentence, its last quarter of words."""
    cuts = [m.end() for m in _SENTENCE.finditer(text.rstrip()) if words(text[m.end() :])]
    if cuts and words(text[: cuts[-1]]):
        return words(text[: cuts[-1]]), words(text[cuts[-1] :])
    found = words(text)
    at = len(found) - max(1, len(found) // 4)
    return found[:at], found[at:]


def ngrams(found: list[str], n: int) -> set[tuple[str, ...]]:
    n = max(1, min(n, len(found)))
    return {tuple(found[k : k + n]) for k in range(len(found) - n + 1)}


def overlap(part: list[str], passage: list[str]) -> float:
    """The share of the part's n-grams that the passage has; 1 for an empty part."""
    if not part:
        return 1.0
    wanted = ngrams(part, NGRAM)
    return len(wanted & ngrams(passage, min(NGRAM, len(part)))) / len(wanted)


@dataclass
class Index:
    """Postings of some items: for each word the items in order, their shares and the greatest share.

    The bounds of word number k are entries starts[k] to starts[k + 1] of blocks (numbers) and bounds.
    """

    ids: list[int]
    parts: list[tuple[list[str], list[str]]]
    postings: dict[str, tuple[list[int], list[float], float]]
    numbers: dict[str, int]
    starts: np.ndarray
    blocks: np.ndarray
    bounds: np.ndarray
    window: int
    at_once: int

    @classmethod
    def build(cls, items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_words: float) -> Index:
        lists: dict[str, list[tuple[int, float]]] = defaultdict(list)
        kept = [(i, t, words(t)) for i, t in items]
        for at, (_, _, found) in enumerate(kept):
            share = {}
            for word, tf in Counter(found).items():
                idf = math.log(1 + (n_items - frequency[word] + 0.5) / (frequency[word] + 0.5))
                share[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(found) / mean_words))
            full = sum(share.values())
            for word, value in share.items():
                lists[word].append((at, value / full))
        postings, starts, blocks, bounds = {}, [0], [], []
        for word, entries in lists.items():
            postings[word] = [e[0] for e in entries], [e[1] for e in entries], max(e[1] for e in entries)
            best: dict[int, float] = defaultdict(float)
            for at, value in entries:
                best[at // POSTING_BLOCK] = max(best[at // POSTING_BLOCK], value)
            blocks += best
            bounds += best.values()
            starts.append(len(blocks))
        window = 2 * max((len(f) for _, _, f in kept), default=1)
        longest = max((y - x for x, y in zip(starts, starts[1:], strict=False)), default=1)
        return cls(
            [i for i, _, _ in kept], [question_and_answer(t) for _, t, _ in kept], postings, {w: k for k, w in enumerate(postings)},
            np.array(starts), np.array(blocks, np.int64), np.array(bounds), window, max(1, ENTRIES // max(1, window * longest)),
        )

    def open_blocks(self, passages: np.ndarray, numbers: np.ndarray, least: float) -> list[tuple[int, int]]:
        """The pairs of passage and block whose bounds add up to the threshold; each word of a passage is given once."""
        first, sizes = self.starts[numbers], self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(sizes)
        entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + sizes, sizes)
        n = len(self.ids) // POSTING_BLOCK + 1
        keys, place = np.unique(np.repeat(passages, sizes) * n + self.blocks[entry], return_inverse=True)
        reach = np.bincount(place, self.bounds[entry], len(keys))
        return [(int(k) // n, int(k) % n) for k in keys[reach >= least - 1e-9]]

    def search(self, query: set[str], least: float, block: int | None = None) -> list[tuple[int, float]]:
        """All items of a block, or of all blocks, whose shares of the query's words add up to the threshold (WAND)."""
        first, end = (0, len(self.ids)) if block is None else (block * POSTING_BLOCK, (block + 1) * POSTING_BLOCK)
        lists = [self.postings[w] for w in query]
        at = [bisect_left(items, first) for items, _, _ in lists]
        open_ = list(range(len(lists)))
        found = []
        while True:
            here = sorted((lists[k][0][at[k]], k) for k in open_ if at[k] < len(lists[k][0]) and lists[k][0][at[k]] < end)
            open_ = [k for _, k in here]
            bound, pivot = 0.0, None
            for item, k in here:
                bound += lists[k][2]
                if bound >= least - 1e-9:
                    pivot = item
                    break
            if pivot is None:
                return found
            score = 0.0
            for item, k in here:
                if item > pivot:
                    break
                items = lists[k][0]
                at[k] = bisect_left(items, pivot, at[k])
                if at[k] < len(items) and items[at[k]] == pivot:
                    score += lists[k][1][at[k]]
                    at[k] += 1
            if score >= least - 1e-9:
                found.append((pivot, score))

    def leaks(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """Item, best score and overlaps of each verified item in the whole text."""
        found, best = words(text), {}
        known = np.array([self.numbers.get(w, -1) for w in found], np.int64)
        step, size = self.window // 2, max(1, len(self.numbers))
        starts = range(0, max(1, len(found) - step), step)
        for begin in range(0, len(starts), self.at_once):
            some = starts[begin : begin + self.at_once]
            at = np.array(some)[:, None] + np.arange(self.window)
            number = np.where(at < len(found), known[np.minimum(at, len(found) - 1)], -1) if len(found) else np.full(at.shape, -1)
            passage, column = np.nonzero(number >= 0)
            pairs = np.unique(passage * size + number[passage, column])
            for k, block in self.open_blocks(pairs // size, pairs % size, SHARE):
                words_ = found[some[k] : some[k] + self.window]
                for item, score in self.search({w for w in words_ if w in self.numbers}, SHARE, block):
                    question, answer = self.parts[item]
                    row = (self.ids[item], min(1.0, score), overlap(question, words_), overlap(answer, words_))
                    if row[2] >= OVERLAP and row[3] >= OVERLAP and (item not in best or best[item] < row):
                        best[item] = row
        return [best[k] for k in sorted(best)]


def _indexes(items: DataFrame) -> list[Index]:
    """Indexes of all items, in blocks of bounded size; word statistics are those of all items."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    (total,) = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-total // INDEX_CHARS))
    statistics = Counter()
    sizes = [0, 0]
    keyed = items.withColumn("block", F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)))
    held = []
    for block in range(blocks):
        rows = [(r.item_id, r.text) for r in keyed.filter(F.col("block") == block).orderBy("item_id", "text").collect()]
        rows = [(i, t) for i, t in rows if words(t)]
        for _, text in rows:
            found = words(text)
            statistics.update(set(found))
            sizes[0] += 1
            sizes[1] += len(found)
        held.append(rows)
    return [Index.build(rows, statistics, sizes[0], sizes[1] / max(1, sizes[0])) for rows in held if rows]


def _searching(sent):
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = LEAK.elementType.names
        for texts in batches:
            yield pd.Series([[dict(zip(names, row, strict=True)) for row in sent.value.leaks(t)] for t in texts], dtype=object)

    return search


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs (text and any other columns) with one more column: the test items found in the text.

    The column is the last one, ``leaks`` (with underscores where there is one already): an array of
    item_id, score, question and answer. NULL and empty texts have none, nor has any text if there are no
    items; items without words are left out. Repeated items count once; items that differ
    in text only count each. An item_id may be NULL.
    """
    (name,) = fresh(docs, "leaks")
    column = F.array().cast(LEAK)
    for index in _indexes(items):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        column = F.concat(column, F.pandas_udf(_searching(sent), LEAK)(F.col("text").cast("string")))
    return docs.select("*", column.alias(name))
