"""Category indexes, one-hot slots, assembled features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, table
from trainlake.catalog.splits import SQL_KEY, keyed_lines
from trainlake.operators import features as feat
from trainlake.operators.clean import ints_to_double
from trainlake.operators.models import fit_features
from trainlake.operators.split import hash_split

QUERIES = Queries()
ORACLES: dict[str, str] = {}

CATEGORIES = ("p_brand", "p_type")


def _sql_index(source: str, c: str, where: str = "TRUE") -> str:
    """(level, freq, idx) of a column."""
    return (
        f"(SELECT {c} AS level, count(*) AS freq, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx "
        f"FROM {source} WHERE {c} IS NOT NULL AND {where} GROUP BY {c})"
    )


@QUERIES
def index_table(spark: SparkSession, sf: str) -> DataFrame:
    """Levels of two columns by falling frequency."""
    return feat.fit_index(table(spark, sf, "part"), CATEGORIES).table


ORACLES["index_table"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", level, freq, idx FROM {_sql_index('part', c)}" for c in CATEGORIES
)


@QUERIES
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    """brand and type of each part as index."""
    part = table(spark, sf, "part")
    indexed = feat.apply_index(part, feat.fit_index(part, CATEGORIES))
    return indexed.select("p_partkey", "p_brand_idx", "p_type_idx")


ORACLES["string_index"] = (
    "SELECT p_partkey, b.idx AS p_brand_idx, t.idx AS p_type_idx FROM part "
    f"JOIN {_sql_index('part', 'p_brand')} b ON p_brand = b.level "
    f"JOIN {_sql_index('part', 'p_type')} t ON p_type = t.level"
)


@QUERIES
def index_high_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    """A column with a level for each customer, numbered by ranges and looked
    up in a broadcast head and a shuffled tail."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    index = feat.fit_index(orders, ["customer"], window_rows=100, partitions=8)
    return feat.apply_index(orders, index, broadcast_levels=100).select("o_orderkey", "customer_idx")


ORACLES["index_high_cardinality"] = (
    "WITH o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer FROM orders) "
    f"SELECT o_orderkey, idx AS customer_idx FROM o JOIN {_sql_index('o', 'customer')} c ON customer = level"
)


WIDE = ("l_orderkey", "l_partkey", "l_suppkey")


@QUERIES
def index_three_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Three wide columns looked up in one pass, with levels that the training rows lack."""
    lines = keyed_lines(spark, sf).select("row_key", *(F.col(c).cast("string").alias(c) for c in WIDE))
    train, _ = hash_split(lines, F.col("row_key"), [0.8, 0.2])
    index = feat.fit_index(train, WIDE)
    return feat.apply_index(lines, index, on_unknown="keep", broadcast_levels=10).drop(*WIDE)


_SQL_LINES = f"(SELECT {SQL_KEY} AS row_key, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in WIDE) + " FROM lineitem)"
ORACLES["index_three_wide"] = (
    f"WITH lines AS {_SQL_LINES}, train AS (SELECT * FROM lines WHERE CAST('0x' || substr(md5('42:' || row_key), 1, 8) AS BIGINT) % 1000 < 800), "
    + ", ".join(f"{c}_i AS {_sql_index('train', c)}" for c in WIDE)
    + " SELECT row_key, " + ", ".join(f"coalesce({c}_i.idx, (SELECT count(*) FROM {c}_i)) AS {c}_idx" for c in WIDE)
    + " FROM lines " + " ".join(f"LEFT JOIN {c}_i ON lines.{c} = {c}_i.level" for c in WIDE)
)


@QUERIES
def one_hot_long(spark: SparkSession, sf: str) -> DataFrame:
    """the one-hot slot of each part's brand; the rarest brand has none."""
    part = table(spark, sf, "part")
    index = feat.fit_index(part, ["p_brand"])
    return feat.one_hot_long(feat.apply_index(part, index), "p_partkey", index, "p_brand")


ORACLES["one_hot_long"] = (
    f"WITH b AS {_sql_index('part', 'p_brand')} SELECT p_partkey, idx AS slot, 1.0::DOUBLE AS value "
    "FROM part JOIN b ON p_brand = level WHERE idx < (SELECT count(*) FROM b) - 1"
)


def _sql_assembled(one_hot: bool) -> str:
    brand, type_ = _sql_index("part", "p_brand"), _sql_index("part", "p_type")
    if one_hot:
        width = "((SELECT count(*) FROM b) + (SELECT count(*) FROM t) - 2)"
        categories = (
            "SELECT p_partkey, b.idx AS slot, 1.0::DOUBLE AS value FROM part JOIN b ON p_brand = b.level "
            "WHERE b.idx < (SELECT count(*) FROM b) - 1 UNION ALL "
            "SELECT p_partkey, t.idx + (SELECT count(*) FROM b) - 1, 1.0 FROM part JOIN t ON p_type = t.level "
            "WHERE t.idx < (SELECT count(*) FROM t) - 1"
        )
    else:
        width = "2"
        categories = (
            "SELECT p_partkey, 0 AS slot, CAST(b.idx AS DOUBLE) AS value FROM part JOIN b ON p_brand = b.level "
            "WHERE b.idx <> 0 UNION ALL SELECT p_partkey, 1, CAST(t.idx AS DOUBLE) FROM part "
            "JOIN t ON p_type = t.level WHERE t.idx <> 0"
        )
    return (
        f"WITH b AS {brand}, t AS {type_}, s AS ({categories} UNION ALL "
        f"SELECT p_partkey, {width}, CAST(p_size AS DOUBLE) FROM part WHERE p_size <> 0 UNION ALL "
        f"SELECT p_partkey, {width} + 1, p_retailprice FROM part WHERE p_retailprice <> 0) "
        "SELECT p_partkey, CAST(slot AS BIGINT) AS slot, value FROM s"
    )


def _assembled(spark: SparkSession, sf: str, one_hot: bool) -> DataFrame:
    part = table(spark, sf, "part")
    index = feat.fit_index(part, CATEGORIES)
    indexed = feat.apply_index(part, index)
    return feat.assembled_long(indexed, "p_partkey", index, CATEGORIES, ["p_size", "p_retailprice"], one_hot)


@QUERIES
def assembled_long(spark: SparkSession, sf: str) -> DataFrame:
    """One-hot categories and numbers of each part as non-zero slots."""
    return _assembled(spark, sf, one_hot=True)


@QUERIES
def assembled_index_long(spark: SparkSession, sf: str) -> DataFrame:
    """the form for trees, one slot for each category."""
    return _assembled(spark, sf, one_hot=False)


def _vectors(spark: SparkSession, sf: str, one_hot: bool) -> DataFrame:
    part = ints_to_double(table(spark, sf, "part")).select("p_partkey", *CATEGORIES, "p_size", "p_retailprice")
    roles = feat.column_roles(part, label="")
    vectors = fit_features(part, roles, one_hot).model.transform(part)
    slots = F.posexplode(vector_to_array("features")).alias("slot", "value")
    return (
        vectors.select("p_partkey", slots)
        .filter("value <> 0")
        .select("p_partkey", F.col("slot").cast("bigint").alias("slot"), "value")
    )


@QUERIES
def vector_assembled(spark: SparkSession, sf: str) -> DataFrame:
    """The same slots from the Spark ML stages."""
    return _vectors(spark, sf, one_hot=True)


@QUERIES
def vector_assembled_index(spark: SparkSession, sf: str) -> DataFrame:
    """The same for trees."""
    return _vectors(spark, sf, one_hot=False)


ORACLES["assembled_long"] = ORACLES["vector_assembled"] = _sql_assembled(one_hot=True)
ORACLES["assembled_index_long"] = ORACLES["vector_assembled_index"] = _sql_assembled(one_hot=False)


def _unknown(spark: SparkSession, sf: str, on_unknown: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    train, _ = hash_split(part, F.col("p_name"), [0.8, 0.2])
    index = feat.fit_index(train, ["p_name"])
    return feat.apply_index(part, index, on_unknown=on_unknown).select("p_partkey", "p_name_idx")


@QUERIES
def index_unknown_skip(spark: SparkSession, sf: str) -> DataFrame:
    """rows with a name the training rows lack are dropped."""
    return _unknown(spark, sf, "skip")


@QUERIES
def index_unknown_keep(spark: SparkSession, sf: str) -> DataFrame:
    """they get an index of their own."""
    return _unknown(spark, sf, "keep")


_KNOWN = _sql_index("part", "p_name", "CAST('0x' || substr(md5('42:' || p_name), 1, 8) AS BIGINT) % 1000 < 800")
ORACLES["index_unknown_skip"] = (
    f"SELECT p_partkey, idx AS p_name_idx FROM part JOIN {_KNOWN} k ON p_name = level"
)
ORACLES["index_unknown_keep"] = (
    f"WITH k AS {_KNOWN} SELECT p_partkey, coalesce(idx, (SELECT count(*) FROM k)) AS p_name_idx "
    "FROM part LEFT JOIN k ON p_name = level"
)
