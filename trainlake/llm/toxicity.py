"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on words of toxic and one on words of ordinary text.
A window is one word: it is compressed with either dictionary, and its distance is the share of
its bytes that the toxic dictionary saves over the ordinary one. The largest distance of a text
is its raw score; a threshold calibrated on labelled texts that no dictionary has seen turns it
into a score from 0 to 1, with 0.5 at the threshold.

Windows are much shorter than what zstandard compresses at all, so each is followed by
a fixed filling that both dictionaries hold and that costs the same few bytes with either.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.llm.common import fold, fresh

#: Bounds of the labelled sample, in texts of each class and characters of each text.
TOXIC_TEXTS, ORDINARY_TEXTS, SAMPLE_CHARS = 2000, 4000, 12_000
TOXIC_BYTES, ORDINARY_BYTES, LEVEL = 8 << 10, 64 << 10, 3
#: Words drawn by how often they occur, to train the ordinary dictionary on.
ORDINARY_SAMPLES = 200_000
#: A word stands for toxic text if it or a beginning of it is found in so many different places of it, and so much oftener (log) than in ordinary text.
PLACES, LOG_RATIO, FEWEST_WORDS = 8, 2.0, 20
CACHED_WINDOWS = 300_000
CLEAN_WEIGHT = 3
STEM = 4
FILLING = b"0123456789ABCDEF"
_WORD = re.compile(r"\w+")


def windows(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _bytes(word: str) -> bytes:
    return f" {word} ".encode() + FILLING


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"".join(sorted(set(samples))) + FILLING)[-size:]


@dataclass(frozen=True)
class Model:
    """Both dictionaries and the threshold; small enough to travel with each task."""

    ordinary: bytes
    toxic: bytes
    threshold: float
    spread: float


class Scorer:
    """Scores texts; remembers the distances of at most CACHED_WINDOWS words."""

    def __init__(self, model: Model):
        self._model = model
        self._known: dict[str, float] = {}
        self._compressors = []
        for content in (model.ordinary, model.toxic):
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=LEVEL)
            self._compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False,
            ))

    def _distances(self, words: list[str]) -> np.ndarray:
        data = [_bytes(w) for w in words]
        ordinary, toxic = (np.array([len(x) for x in c.multi_compress_to_buffer(data, threads=1)]) for c in self._compressors)
        return (ordinary - toxic) / np.array([len(x) for x in data])

    def raw(self, text: str | None) -> float:
        """The largest distance of all windows of the whole text; -1 without any."""
        words = set(windows(text))
        unknown = [w for w in words if w not in self._known]
        best = -1.0
        if unknown:
            found = self._distances(unknown).tolist()
            best = max(found)
            if len(self._known) + len(unknown) > CACHED_WINDOWS:
                best = max([best, *(self._known[w] for w in words if w in self._known)])
                self._known.clear()
            self._known.update(p for p in zip(unknown, found, strict=True) if len(p[0]) <= 64)
        return max([best, *(self._known[w] for w in words if w in self._known)])

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-(self.raw(text) - self._model.threshold) / self._model.spread))


def _stems(word: str) -> list[str]:
    """The beginnings of a word from STEM letters on, and the whole word with its end."""
    return [*(word[:k] for k in range(STEM, min(len(word), 2 * STEM) + 1)), word + " "]


def _places(texts: list[str]) -> Counter:
    """In how many different places each stem is found: with different words both before and after it, so that copies count once."""
    counts, known = [], {}
    for side in (0, 1):  # one after the other, and each word kept once: the pairs are what takes most of the memory
        pairs = set()
        for text in texts:
            w = ["", *(known.setdefault(x, x) for x in windows(text)), ""]
            pairs.update(zip(w[1:-1], w[2:] if side else w[:-2]))
        words = Counter(word for word, _ in pairs)
        stems = Counter()
        for word, n in words.items():
            for stem in _stems(word):
                stems[stem] += n
        counts.append(stems)
    return counts[0] & counts[1]


def _threshold(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the fewest errors, a clean text taken for toxic weighing CLEAN_WEIGHT times; in the middle of the widest such gap."""
    values = np.unique(scores)
    cuts = np.concatenate([[values[0] - 0.1], (values[:-1] + values[1:]) / 2, [values[-1] + 0.1]])
    errors = np.array([np.mean(scores[toxic] < c) + CLEAN_WEIGHT * np.mean(scores[~toxic] >= c) for c in cuts])
    gaps = np.concatenate([[0], np.diff(values), [0]])
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(cuts[best[np.argmax(gaps[best])]])


def train(texts: list[str], toxic: list[bool]) -> Model | None:
    """Dictionaries from two thirds of the texts, the threshold from the rest; None without both classes."""
    pairs = list(zip(texts, toxic, strict=True))
    bad, good = [t for t, y in pairs if y], [t for t, y in pairs if not y]
    if not any(map(windows, bad)) or not any(map(windows, good)):
        return None
    learn = lambda x: [t for k, t in enumerate(x) if k % 3] or x
    test = lambda x: x[::3]
    in_toxic, in_ordinary = _places(learn(bad)), _places(learn(good))
    if not in_toxic or not in_ordinary:
        in_toxic, in_ordinary = _places(bad), _places(good)
    whole = lambda c: {s[:-1]: n for s, n in c.items() if s[-1] == " "}
    toxic_words, ordinary_words = whole(in_toxic), whole(in_ordinary)
    share = math.log(sum(ordinary_words.values()) / sum(toxic_words.values()))
    ratio = {s: math.log((n + 0.5) / (in_ordinary[s] + 0.5)) + share for s, n in in_toxic.items()}
    marked = sorted(toxic_words)
    for least in (PLACES, PLACES * 5 // 8, PLACES * 3 // 8):  # small samples have no word in many places
        stems = {s for s, r in ratio.items() if r > LOG_RATIO and in_toxic[s] >= least}
        found = sorted(w for w in toxic_words if not stems.isdisjoint(_stems(w)))
        if len(found) >= FEWEST_WORDS:
            marked = found
            break
    words, places = list(ordinary_words), np.array(list(ordinary_words.values()), float)
    drawn = np.random.default_rng(0).choice(len(words), ORDINARY_SAMPLES, p=places / places.sum())
    repeats = max(int(toxic_words[w] ** 0.5) for w in marked)
    toxic_samples = [_bytes(w) for k in range(max(1, repeats)) for w in marked if toxic_words[w] > k * k]
    model = Model(_dictionary([_bytes(words[k]) for k in drawn], ORDINARY_BYTES), _dictionary(toxic_samples, TOXIC_BYTES), 0.0, 0.02)
    scorer = Scorer(model)
    held = [(scorer.raw(t), y) for part, y in ((test(bad), True), (test(good), False)) for t in part]
    threshold = _threshold(np.array([s for s, _ in held]), np.array([y for _, y in held]))
    return Model(model.ordinary, model.toxic, threshold, model.spread)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column) -> Model | None:
    """A model from labelled documents.

    labels has doc_id and toxic (0 or 1, others are left out); doc_ids labelled both ways are left
    out, too. may_learn is a condition on doc_id. The sample is bounded (see the constants) and is
    the same on every run: the doc_ids with the smallest hashes of each class.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & may_learn).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").select("doc_id", "toxic")
    order = F.xxhash64(F.lit(17), "doc_id")
    chosen = [known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(n) for y, n in ((1, TOXIC_TEXTS), (0, ORDINARY_TEXTS))]
    # At most TOXIC_TEXTS + ORDINARY_TEXTS rows of two numbers.
    sample = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.substring(F.col("text").cast("string"), 1, SAMPLE_CHARS).alias("text")).filter("text <> ''")
    rows = texts.join(sample, "doc_id").orderBy(order, "doc_id", "text").limit(TOXIC_TEXTS + ORDINARY_TEXTS).collect()
    return train([r.text for r in rows], [r.toxic == 1 for r in rows])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """The table with one more column, the score of each whole text.

    The column is the last one; it is called score, with underscores behind it where the table has
    such a column. NULL and empty texts and texts without any word get the lowest score. Without a
    model (no labels of one class) every score is 0. Rows are scored one by one, repeated ones alike.
    """
    (name,) = fresh(docs, "score")
    if model is None:
        return docs.select("*", F.lit(0.0).alias(name))

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return docs.select("*", F.pandas_udf(scored, "double")(F.col("text").cast("string")).alias(name))


def may_learn(doc_id: Column) -> Column:
    """Documents whose labels may be learned from; the others are held out."""
    return fold(doc_id, 5) != 0
