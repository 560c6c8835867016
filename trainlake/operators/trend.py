"""Word counts over document collections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.functions.stopwords import stopwords
from trainlake.functions.words import clean_steps, letter_words

MIN_LENGTH = 4
BROADCAST_WORDS = 100_000


def clean_text(df: DataFrame, column: str | Column = "text", **options) -> DataFrame:
    """Rows with text only, cleaned: one column `text`."""
    c = F.col(column) if isinstance(column, str) else column
    return df.select(c.alias("text")).na.drop().select(clean_steps(F.col("text"), **options).alias("text"))


def tokens(
    df: DataFrame, text: Column, keep: Sequence[str] = (), **options
) -> DataFrame:
    """One row for each word of the text; NULL text gives none."""
    return df.select(*keep, F.explode(letter_words(text, **options)).alias("word"))


def min_length(words: DataFrame, length: int = MIN_LENGTH) -> DataFrame:
    return words.filter(F.length("word") >= length)


def drop_stopwords(words: DataFrame, stop: Sequence[str] | None = None) -> DataFrame:
    """Rows whose word is not in the list.

    A hash join against the list beats a long IN filter here. The list is a
    Python sequence, so its size is known; only a short one is broadcast by hint.
    """
    listed = stopwords() if stop is None else tuple(stop)
    if not listed:
        return words
    one_row = words.sparkSession.range(1, numPartitions=1)
    table = one_row.select(F.explode(F.lit(list(listed))).alias("word"))
    if len(listed) <= BROADCAST_WORDS:
        table = F.broadcast(table)
    return words.join(table, "word", "left_anti")


def word_counts(
    df: DataFrame,
    text: str | Column = "text",
    by: Sequence[str] = (),
    stop: Sequence[str] | None = None,
    length: int = MIN_LENGTH,
    **options,
) -> DataFrame:
    """(by..., word, count) of the words that matter.

    Both filters run ahead of the shuffle, and counts are combined in each task
    before it, so a word that makes up a third of all text is no hot key.
    """
    c = F.col(text) if isinstance(text, str) else text
    words = drop_stopwords(min_length(tokens(df, c, by, **options), length), stop)
    return words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("count"))


def trending(
    df: DataFrame, text: str | Column = "text", top: int | None = None, **options
) -> DataFrame:
    """Words by descending count, equal counts by word; all of them or the top ones.

    The word in the sort key also spreads the many words of count one over the
    partitions of the sort.
    """
    ranked = word_counts(df, text, **options).orderBy(F.desc("count"), "word")
    return ranked if top is None else ranked.limit(top)
