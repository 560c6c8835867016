"""Rows that every operator must take: NULLs, empty and very long texts, repeated rows, clashing names."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 4000
CLASHES = "score leaks root row n gram cls leaks_ n_replaced main_text sequence_id text_".split()
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)
TEXTS = [(1, None), (2, ""), (3, "  \n "), (4, "one two"), (4, "one two"), (None, "one two"), (5, LONG), (6, "!!! 123"), (None, None)]


def edge_rows(spark, more=()):
    return spark.createDataFrame([(i, t, None, *CLASHES) for i, t in [*TEXTS, *more]], SCHEMA)


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)
