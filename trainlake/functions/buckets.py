"""Reproducible row buckets.

The bucket depends on the key and the seed only, so a row keeps its side of a
split under any partitioning, file layout or retry. No shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1000


def hash_bucket(key: Column, seed: int = 42, buckets: int = BUCKETS) -> Column:
    """Bucket number in 0..buckets-1 from the first 32 bits of md5('<seed>:<key>')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def row_key(*columns: str) -> Column:
    """One string key from several columns."""
    return F.concat_ws("-", *[F.col(c) for c in columns])
