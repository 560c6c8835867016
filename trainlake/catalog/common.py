"""Helpers of the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trainlake.session import spread_scan

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, on all cores even if it is small."""
    return spread_scan(table(spark, sf_dir, name).select(*columns))


class Queries(dict):
    """Queries by name, filled by decorating functions."""

    def __call__(self, query: Query) -> Query:
        self[query.__name__] = query
        return query
