"""Splits and folds."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, table
from trainlake.catalog.listing import KEY
from trainlake.functions.buckets import row_key
from trainlake.operators.split import combine, fold_column, hash_split, random_split, split_index
from trainlake.session import spread_scan

QUERIES = Queries()
ORACLES: dict[str, str] = {}

SQL_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
SQL_BUCKET = f"CAST('0x' || substr(md5('42:' || {SQL_KEY}), 1, 8) AS BIGINT) % 1000"


def keyed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return spread_scan(table(spark, sf, "lineitem").drop("l_shipdate")).withColumn("row_key", row_key(*KEY))


@QUERIES
def split_80_20(spark: SparkSession, sf: str) -> DataFrame:
    """The part of each row."""
    return keyed_lines(spark, sf).select("row_key", split_index(F.col("row_key"), [0.8, 0.2]).alias("part"))


ORACLES["split_80_20"] = (
    f"SELECT {SQL_KEY} AS row_key, CASE WHEN {SQL_BUCKET} < 800 THEN 0 ELSE 1 END AS part FROM lineitem"
)


@QUERIES
def split_60_20_20(spark: SparkSession, sf: str) -> DataFrame:
    """Train, validation and test."""
    return keyed_lines(spark, sf).select("row_key", split_index(F.col("row_key"), [0.6, 0.2, 0.2]).alias("part"))


ORACLES["split_60_20_20"] = (
    f"SELECT {SQL_KEY} AS row_key, CASE WHEN {SQL_BUCKET} < 600 THEN 0 WHEN {SQL_BUCKET} < 800 THEN 1 "
    "ELSE 2 END AS part FROM lineitem"
)


@QUERIES
def kfold_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The fold of each row."""
    return fold_column(keyed_lines(spark, sf), F.col("row_key"), 10).select("row_key", "fold")


ORACLES["kfold_rows"] = f"SELECT {SQL_KEY} AS row_key, CAST({SQL_BUCKET} % 10 AS INT) AS fold FROM lineitem"


@QUERIES
def union_train_val(spark: SparkSession, sf: str) -> DataFrame:
    """Train and validation together, columns matched by name."""
    train, validation, _ = hash_split(keyed_lines(spark, sf), F.col("row_key"), [0.6, 0.2, 0.2])
    columns = ["l_returnflag", "l_quantity", "row_key"]
    both = combine(train.select(*columns), validation.select(*reversed(columns)))
    return both.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")
    )


ORACLES["union_train_val"] = (
    "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem "
    f"WHERE {SQL_BUCKET} < 800 GROUP BY l_returnflag"
)


@QUERIES
def random_split_total(spark: SparkSession, sf: str) -> DataFrame:
    """Spark's own split, whose parts also add up to the whole."""
    parts = random_split(table(spark, sf, "lineitem").select("l_quantity", "l_partkey"), [0.8, 0.2])
    return combine(*parts).agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("keys"))


ORACLES["random_split_total"] = (
    "SELECT count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS keys FROM lineitem"
)
