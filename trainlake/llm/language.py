"""Language identification by error-correcting output codes.

Every language has a codeword of bits, and for each bit a binary classifier over hashed byte
trigrams tells on which side a text lies. Decoding weighs the loss of each bit by how well its
classifier did in training and takes the nearest codeword; a text whose two nearest codewords
are about as near is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.llm.common import fold

BUCKETS = 1 << 13
#: Bounds of the labelled sample: texts of a language, texts in all, characters of a text.
TEXTS_EACH, TEXTS_ALL, SAMPLE_CHARS = 1200, 20_000, 4000
MAX_LANGUAGES = 1000
AMBIGUOUS = 0.2
_BLANKED = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
UNKNOWN = "und"


def counts(text: str) -> np.ndarray:
    """How often each hashed byte trigram of the lower-cased text occurs; other ASCII characters count as blanks."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace").translate(_BLANKED), np.uint8).astype(np.uint32)
    joined = data[:-2] | data[1:-1] << 8 | data[2:] << 16
    joined = joined[joined & 0xFFFF != 0x2020]
    hashed = (joined * np.uint32(2654435761)) >> np.uint32(32 - 13)
    return np.bincount(hashed, minlength=BUCKETS)


def codewords(n: int) -> np.ndarray:
    """A codeword of -1 and 1 for each of n languages.

    Up to six languages get the exhaustive code, all ways to halve them; more get the random
    code with the largest smallest distance among a hundred, a fixed seed for each n.
    """
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        columns = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, np.int8).T
    rng, width = np.random.default_rng(n), 12 * int(np.ceil(np.log2(n)))
    best, distance = None, -1
    for _ in range(100):
        code = rng.choice(np.array([-1, 1], np.int8), (n, width))
        gram = code.astype(int) @ code.T
        np.fill_diagonal(gram, -width)
        if (width - gram.max()) // 2 > distance:
            best, distance = code, (width - gram.max()) // 2
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    trust: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        found = counts(text)
        return (found @ self.weights) / max(1, found.sum()) - self.shift

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """Language, its share of the weight of all, and whether the next one is about as near."""
        losses = (np.log1p(np.exp(-np.clip(margins * self.code, -30, 30))) * self.trust).sum(1)
        weight = np.exp(losses.min() - losses)
        order = np.argsort(losses, kind="stable")
        close = len(order) > 1 and losses[order[1]] - losses[order[0]] < AMBIGUOUS * self.trust.sum()
        return self.languages[order[0]], float(weight.max() / weight.sum()), bool(close)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not any(map(str.isalpha, text)) or not self.languages:
            return UNKNOWN, 0.0, False
        return self.decode(self.margins(text))


def train(texts: list[str], langs: list[str]) -> Model:
    """Naive Bayes weights for each bit, scaled so that margins of the training texts are about one."""
    languages = tuple(sorted(set(langs)))
    number = np.array([languages.index(x) for x in langs], int)
    code = codewords(len(languages))
    total = np.zeros((len(languages), BUCKETS))
    for text, k in zip(texts, number, strict=True):
        found = counts(text)
        total[k] += found / max(1, found.sum())
    rate = np.log((total + 0.01) / (total + 0.01).sum(1, keepdims=True)) if languages else total
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    for bit in range(code.shape[1]):
        plus, minus = rate[code[:, bit] > 0], rate[code[:, bit] < 0]
        if len(minus):
            side = lambda r: np.log(np.exp(r).mean(0))
            weights[:, bit] = side(plus) - side(minus)
    seen = np.array([counts(t) @ weights / max(1, counts(t).sum()) for t in texts]).reshape(len(texts), code.shape[1])
    shift, scale, trust = np.zeros(code.shape[1]), np.ones(code.shape[1]), np.ones(code.shape[1])
    for bit in range(code.shape[1]):
        side = code[number, bit] > 0
        if side.any() and not side.all():
            shift[bit] = (np.median(seen[side, bit]) + np.median(seen[~side, bit])) / 2
            scale[bit] = max(1e-6, np.median(np.abs(seen[:, bit] - shift[bit]))) / 4
            error = np.mean((seen[:, bit] > shift[bit]) != side)
            trust[bit] = max(0.05, np.log((1 - error + 1e-3) / (error + 1e-3)))
    trust = trust / max(trust.sum(), 1e-9)
    return Model(languages, code, (weights / scale).astype(np.float32), shift / scale, trust * len(trust) ** 0.5)


def fit(docs: DataFrame, may_learn: Column) -> Model:
    """A model from the text and language of documents.

    docs has doc_id, text and lang; may_learn is a condition on doc_id. The sample is bounded (see
    the constants): of each language the documents whose hash is below a level that gives about
    TEXTS_EACH of them. Without labelled texts the model knows no language.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(may_learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    each = min(TEXTS_EACH, TEXTS_ALL // max(1, len(sizes)))
    levels = docs.sparkSession.createDataFrame([(x, float(each / n)) for x, n in sorted(sizes.items())], "lang string, level double")
    position = F.pmod(F.xxhash64(F.lit(29), "doc_id", F.length("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.join(F.broadcast(levels), "lang").filter(position < F.col("level"))
    rows = chosen.select("lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"), position.alias("at")).orderBy("at", "lang", "text").limit(2 * TEXTS_ALL).collect()
    return train([r.text for r in rows], [r.lang for r in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every row of docs (doc_id, text).

    NULL texts, texts without a letter, and all texts if no language is known get ``und``
    with score 0. Whole texts count; rows are judged one by one, repeated ones alike.
    """
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous"])

    judge = F.pandas_udf(judged, "lang_pred string, score double, ambiguous boolean")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), judge(F.col("text").cast("string")).alias("found")).select("doc_id", "found.*")


def may_learn(doc_id: Column) -> Column:
    """Documents that may be learned from; the others are held out."""
    return fold(doc_id, 3) != 1
