"""Expressions over numeric and currency columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_money(c: Column) -> Column:
    """'$1,234.00' to 1234.0; text that is no number becomes NULL, never an error."""
    return F.translate(c, "$,", "").try_cast("double")


def nan_to_null(c: Column) -> Column:
    """NaN as NULL, so aggregates see one kind of missing value."""
    return F.when(~F.isnan(c), c)


def missing_flag(c: Column, flag_nan: bool = False) -> Column:
    """1.0 where the value is NULL (with flag_nan also where it is NaN), else 0.0."""
    missing = c.isNull() | F.isnan(c) if flag_nan else c.isNull()
    return F.when(missing, 1.0).otherwise(0.0)
