"""Fill missing numbers with a statistic of the training rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.functions.numbers import nan_to_null
from trainlake.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Imputation:
    """One fill value for each column."""

    values: Mapping[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        """NULL and NaN replaced in place, in one projection."""
        return df.withColumns(
            {c: F.coalesce(nan_to_null(F.col(c)), F.lit(v)) for c, v in self.values.items()}
        )


def fit_imputation(
    train: DataFrame,
    columns: Sequence[str],
    strategy: str = "median",
    relative_error: float | None = None,
) -> Imputation:
    """Median (a value of the data, the lower one of two), mean or mode of the columns.

    Given a relative error, the median is one sketch pass; without it, exact.
    """
    if not columns:
        values = {}
    elif strategy == "median" and relative_error is None:
        values = exact_quantiles(train, columns)
    elif strategy == "median":
        values = _sketched_medians(train, columns, relative_error)
    elif strategy == "mean":
        row = train.agg(*[F.avg(nan_to_null(F.col(c))).alias(c) for c in columns]).first()
        values = row.asDict()
    elif strategy == "mode":
        values = modes(train, columns)
    else:
        raise ValueError(f"unknown strategy {strategy!r}; known: median, mean, mode")
    empty = [c for c in columns if values.get(c) is None]
    if empty:
        raise ValueError(f"columns without any value cannot be imputed: {empty}")
    return Imputation({c: float(values[c]) for c in columns})


def _sketched_medians(
    train: DataFrame, columns: Sequence[str], relative_error: float
) -> dict[str, float | None]:
    accuracy = max(1, round(1 / relative_error))
    aggs = [
        F.percentile_approx(nan_to_null(F.col(c).cast("double")), 0.5, accuracy).alias(c)
        for c in columns
    ]
    return train.agg(*aggs).first().asDict()


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) of numeric columns: one scan, combined before the shuffle."""
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    return (
        values.unpivot([], list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Most frequent value of each column, the smallest of equals."""
    best = value_counts(df, columns).groupBy("column").agg(
        F.max(F.struct("n", (-F.col("value")).alias("negated"))).alias("best")
    )
    return {r["column"]: -r["best"]["negated"] for r in best.collect()}
