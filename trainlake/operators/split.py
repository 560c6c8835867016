"""Train, validation and test sets, and folds."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.functions.buckets import BUCKETS, hash_bucket


DECILE = BUCKETS // 10


def bucket_edges(weights: Sequence[float]) -> list[int]:
    """Bucket numbers where the parts begin, and the end."""
    total = sum(weights)
    return [0] + [round(BUCKETS * edge / total) for edge in itertools.accumulate(weights)]


def split_index(key: Column, weights: Sequence[float], seed: int = 42) -> Column:
    """The number of the part a row belongs to: 0, 1, ..."""
    cuts = bucket_edges(weights)[1:-1]
    bucket = hash_bucket(key, seed)
    part = F.lit(len(weights) - 1)
    for number, cut in reversed(list(enumerate(cuts))):
        part = F.when(bucket < cut, number).otherwise(part)
    return part


def hash_split(
    df: DataFrame, key: Column, weights: Sequence[float], seed: int = 42
) -> list[DataFrame]:
    """One frame for each weight; together they are the input, row by row.

    A filter on a hash of the row key: no shuffle and no sort, the same rows
    under any partitioning. A NULL key belongs to the last part.
    """
    part = split_index(key, weights, seed)
    return [df.filter(part == number) for number in range(len(weights))]


def with_buckets(df: DataFrame, key: Column, seed: int = 42) -> DataFrame:
    """Add the row's bucket and its decile, a partition column for a table that
    is to be split again and again."""
    bucket = F.coalesce(hash_bucket(key, seed), F.lit(BUCKETS - 1)).cast("int")
    return df.withColumn("bucket", bucket).withColumn("decile", (F.col("bucket") / DECILE).cast("int"))


def bucket_split(df: DataFrame, weights: Sequence[float]) -> list[DataFrame]:
    """hash_split of a frame with buckets; of a table partitioned by decile each
    part reads its own deciles only."""
    edges = bucket_edges(weights)
    return [
        df.filter(F.col("decile").between(low // DECILE, max(high - 1, 0) // DECILE))
        .filter((F.col("bucket") >= low) & (F.col("bucket") < high))
        .drop("decile")
        for low, high in itertools.pairwise(edges)
    ]


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Spark's own split, for data without a key; depends on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def fold_column(
    df: DataFrame, key: Column, folds: int = 3, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add the fold number 0..folds-1 of each row."""
    return df.withColumn(name, (hash_bucket(key, seed) % folds).cast("int"))


def bucket_folds(df: DataFrame, folds: int = 3, name: str = "fold") -> DataFrame:
    """fold_column of a frame with buckets."""
    return df.withColumn(name, F.col("bucket") % folds)


def combine(*frames: DataFrame) -> DataFrame:
    """Union by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
