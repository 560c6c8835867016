"""Document collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text field of each known collection.
TEXT_FIELDS = {"sample": "text", "twitter-sample": "interaction.content"}


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    format: str = "json",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Load a collection with any installed data source.

    A path is left out for sources that take options only, such as a document
    store connector. Give a schema for large JSON: inference reads everything.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def collection_name(file_name: str) -> str:
    """'Sample.json' to 'sample'."""
    return file_name.replace(".json", "").lower()


def text_field(collection: str, fields: dict[str, str] | None = None) -> Column:
    """The text column of a collection, chosen by its name."""
    known = TEXT_FIELDS if fields is None else fields
    name = collection_name(collection)
    if name not in known:
        raise ValueError(f"unknown collection {collection!r}; known: {sorted(known)}")
    return F.col(known[name])
