"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """Replace what the path holds by these rows."""
    df.write.format(format).options(**options).mode("overwrite").save(path)


def ingest_if_absent(df: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """Write the rows only when the path holds nothing yet."""
    df.write.format(format).options(**options).mode("ignore").save(path)
