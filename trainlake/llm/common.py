"""Helpers of these operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of the table has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % n
