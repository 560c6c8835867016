"""Row cleaning of listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainlake.functions.numbers import missing_flag, parse_money
from trainlake.sources.listing import ListingSpec


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def money_to_double(df: DataFrame, column: str) -> DataFrame:
    """Parse a currency column in place; a column that is a number already is cast."""
    text = F.col(column).cast("string")
    return df.withColumn(column, parse_money(text))


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows with a positive value; NULL and NaN, which Spark ranks above all numbers, are dropped."""
    return df.filter((F.col(column) > 0) & ~F.isnan(F.col(column).cast("double")))


def cap_rows(df: DataFrame, column: str, upper: float) -> DataFrame:
    """Rows up to an upper bound; NULL is dropped."""
    return df.filter(F.col(column) <= upper)


def ints_to_double(df: DataFrame) -> DataFrame:
    """Every 32-bit integer column as double, in one projection; longs stay as they are."""
    widened = [
        F.col(f"`{f.name}`").cast("double").alias(f.name)
        if f.dataType == T.IntegerType()
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*widened)


def missing_flags(df: DataFrame, columns: Sequence[str], flag_nan: bool = False) -> DataFrame:
    """Add <column>_na = 1.0 or 0.0 for each column, in one projection."""
    return df.withColumns({f"{c}_na": missing_flag(F.col(c), flag_nan) for c in columns})


def clean_listing(df: DataFrame, spec: ListingSpec, key: Sequence[str] = ()) -> DataFrame:
    """Parse the label, drop unusable rows, project, widen, flag.

    The caps may be on columns outside the keep-list, so they filter before the
    projection; all of it is one pass without a shuffle. Columns named by key
    are kept in front.
    """
    rows = keep_positive(money_to_double(df, spec.label), spec.label)
    for column, upper in spec.caps:
        rows = cap_rows(rows, column, upper)
    rows = keep(rows, [*key, *(c for c in spec.keep if c not in key)])
    return missing_flags(ints_to_double(rows), spec.impute)
