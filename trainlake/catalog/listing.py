"""Listing rows: reading, cleaning, imputing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, spread_table, table
from trainlake.functions.buckets import row_key
from trainlake.functions.numbers import parse_money
from trainlake.operators import clean
from trainlake.operators.features import column_roles, role_report
from trainlake.operators.impute import fit_imputation
from trainlake.operators.quantiles import exact_quantiles
from trainlake.session import materialise, scratch_path
from trainlake.sources.csv_ranges import read_listing_ranges
from trainlake.sources.listing import ListingSpec, few_files, money_text, read_listing, stage_listing, write_listing_csv
from trainlake.tracking.runs import input_example

QUERIES = Queries()
ORACLES: dict[str, str] = {}

SPEC = ListingSpec(
    keep=("price", "linenumber", "discount", "tax", "returnflag", "linestatus"),
    impute=("discount", "tax"),
    caps=(("quantity", 45),),
)
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def raw_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as a listing: price as currency text, zero rates as missing ones."""
    columns = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return spread_table(spark, sf, "lineitem", *KEY, *columns).select(
        row_key(*KEY).alias("row_key"),
        money_text(F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linenumber").alias("linenumber"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
    )


SQL_RAW = """(SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
    l_extendedprice AS price, l_quantity AS quantity, l_linenumber AS linenumber,
    nullif(l_discount, 0.0) AS discount, nullif(l_tax, 0.0) AS tax,
    l_returnflag AS returnflag, l_linestatus AS linestatus FROM lineitem)"""

SQL_CLEAN = f"""(SELECT row_key, price, CAST(linenumber AS DOUBLE) AS linenumber, discount, tax,
    returnflag, linestatus,
    CASE WHEN discount IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS discount_na,
    CASE WHEN tax IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS tax_na
    FROM {SQL_RAW} WHERE price > 0 AND quantity <= 45)"""


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_listing(raw_listing(spark, sf), SPEC, key=["row_key"])


@QUERIES
def csv_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The listing written as CSV, read back with a schema, and cleaned."""
    path = scratch_path(spark, "csv")
    raw = raw_listing(spark, sf)
    write_listing_csv(raw, path)
    read = read_listing(spark, path, raw.schema, multiline=False)
    return clean.clean_listing(read, SPEC, key=["row_key"])


ORACLES["csv_listing"] = f"SELECT * FROM {SQL_CLEAN}"


@QUERIES
def csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """A1: whole documents as CSV cells with line breaks and quotes, types inferred."""
    path = scratch_path(spark, "csv")
    source = table(spark, sf, "documents").select("doc_id", "lang", "text")
    write_listing_csv(source, path)
    read = read_listing(spark, path)
    return read.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.md5("text").alias("digest")
    )


ORACLES["csv_multiline"] = "SELECT doc_id, lang, md5(text) AS digest FROM documents"


@QUERIES
def csv_multiline_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A1: the same cells in one file, or in one for each so many bytes, read by byte ranges."""
    path = scratch_path(spark, "csv")
    source = table(spark, sf, "documents").select("doc_id", "lang", "text")
    write_listing_csv(few_files(source, F.octet_length("text")), path)
    return read_listing_ranges(spark, path, source.schema).select("doc_id", "lang", F.md5("text").alias("digest"))


ORACLES["csv_multiline_ranges"] = ORACLES["csv_multiline"]


@QUERIES
def staged_listing(spark: SparkSession, sf: str) -> DataFrame:
    """A1: the CSV listing converted once to columns."""
    path, staged = scratch_path(spark, "csv"), scratch_path(spark, "staged")
    raw = raw_listing(spark, sf)
    write_listing_csv(raw, path)
    return stage_listing(read_listing(spark, path, raw.schema), staged).select("row_key", "quantity", "tax")


ORACLES["staged_listing"] = f"SELECT row_key, quantity, tax FROM {SQL_RAW}"


@QUERIES
def keep_projection(spark: SparkSession, sf: str) -> DataFrame:
    """B1: a keep-list."""
    return clean.keep(table(spark, sf, "part"), ["p_partkey", "p_brand", "p_retailprice"])


ORACLES["keep_projection"] = "SELECT p_partkey, p_brand, p_retailprice FROM part"


@QUERIES
def money_parse(spark: SparkSession, sf: str) -> DataFrame:
    """B2: currency text as a number; text that is none becomes NULL."""
    text = F.when(F.col("p_type") == "PROMO", "on request").otherwise(money_text(F.col("p_retailprice")))
    return table(spark, sf, "part").select("p_partkey", parse_money(text).alias("price"))


ORACLES["money_parse"] = (
    "SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE round(p_retailprice, 2) END AS price FROM part"
)


@QUERIES
def positive_label(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a positive balance."""
    return clean.keep_positive(table(spark, sf, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


ORACLES["positive_label"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0"


@QUERIES
def cap_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines up to a quantity, the column itself not kept; NULL is dropped."""
    halves = table(spark, sf, "lineitem").withColumn("q", F.nullif("l_quantity", F.lit(1.0)))
    return clean.cap_rows(halves, "q", 45).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


ORACLES["cap_outliers"] = (
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem "
    "WHERE nullif(l_quantity, 1.0) <= 45"
)


@QUERIES
def ints_to_double(spark: SparkSession, sf: str) -> DataFrame:
    """Integers widened, longs and strings as they are."""
    return clean.ints_to_double(table(spark, sf, "part"))


ORACLES["ints_to_double"] = (
    "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS p_size, p_retailprice FROM part"
)


@QUERIES
def missing_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Flags of missing rates."""
    rows = raw_listing(spark, sf).select("row_key", "discount", "tax")
    return clean.missing_flags(rows, ["discount", "tax"])


ORACLES["missing_flags"] = (
    "SELECT row_key, discount, tax, CASE WHEN discount IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS discount_na, "
    f"CASE WHEN tax IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS tax_na FROM {SQL_RAW}"
)


@QUERIES
def listing_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaning of the training jobs."""
    return cleaned(spark, sf)


ORACLES["listing_clean"] = f"SELECT * FROM {SQL_CLEAN}"


def _imputed(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    # Written once, so that the passes of the fit read two columns and clean nothing.
    rows = materialise(cleaned(spark, sf), "listing")
    filled = fit_imputation(rows, SPEC.impute, strategy).apply(rows)
    rounded = {c: F.round(c, 6) for c in SPEC.impute}
    return filled.select("row_key", "discount", "tax", "discount_na", "tax_na").withColumns(rounded)


def _sql_imputed(discount: str, tax: str) -> str:
    return (
        f"WITH c AS {SQL_CLEAN} SELECT row_key, round(coalesce(discount, ({discount})), 6) AS discount, "
        f"round(coalesce(tax, ({tax})), 6) AS tax, discount_na, tax_na FROM c"
    )


@QUERIES
def listing_impute_median(spark: SparkSession, sf: str) -> DataFrame:
    """Missing rates filled with the exact median."""
    return _imputed(spark, sf, "median")


@QUERIES
def listing_impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    """With the mean."""
    return _imputed(spark, sf, "mean")


@QUERIES
def listing_impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    """With the most frequent value."""
    return _imputed(spark, sf, "mode")


for _name, _expr in {
    "median": "SELECT quantile_disc({c}, 0.5) FROM c",
    "mean": "SELECT avg({c}) FROM c",
    "mode": "SELECT {c} FROM c WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1",
}.items():
    ORACLES[f"listing_impute_{_name}"] = _sql_imputed(_expr.format(c="discount"), _expr.format(c="tax"))


@QUERIES
def medians_narrowed(spark: SparkSession, sf: str) -> DataFrame:
    """Exact medians of columns with very many values, by narrowing brackets."""
    lines = table(spark, sf, "lineitem").select(
        "l_extendedprice", "l_quantity", (F.col("l_extendedprice") * F.col("l_tax")).alias("tax_paid")
    )
    found = exact_quantiles(lines, lines.columns, max_distinct=500, accuracy=1000)
    return spark.createDataFrame(list(found.items()), "column string, median double")


ORACLES["medians_narrowed"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", quantile_disc({expr}, 0.5) AS median FROM lineitem"
    for name, expr in {
        "l_extendedprice": "l_extendedprice",
        "l_quantity": "l_quantity",
        "tax_paid": "l_extendedprice * l_tax",
    }.items()
)


@QUERIES
def label_impute_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Documents without a label, flagged and filled with the usual one."""
    labelled = (
        table(spark, sf, "documents")
        .select("doc_id", "lang")
        .join(table(spark, sf, "labels"), "doc_id", "left")
    )
    flagged = clean.missing_flags(clean.ints_to_double(labelled), ["quality", "toxic"])
    return fit_imputation(flagged, ["quality", "toxic"], "mode").apply(flagged)


ORACLES["label_impute_left_join"] = """
WITH j AS (SELECT d.doc_id, lang, CAST(quality AS DOUBLE) AS quality, CAST(toxic AS DOUBLE) AS toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, lang,
  coalesce(quality, (SELECT quality FROM j WHERE quality IS NOT NULL GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)) AS quality,
  coalesce(toxic, (SELECT toxic FROM j WHERE toxic IS NOT NULL GROUP BY toxic ORDER BY count(*) DESC, toxic LIMIT 1)) AS toxic,
  CASE WHEN quality IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS quality_na,
  CASE WHEN toxic IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS toxic_na FROM j"""


@QUERIES
def listing_example(spark: SparkSession, sf: str) -> DataFrame:
    """Five rows as an example of a model's input."""
    return input_example(cleaned(spark, sf), "row_key")


ORACLES["listing_example"] = f"SELECT * FROM {SQL_CLEAN} ORDER BY row_key LIMIT 5"


@QUERIES
def listing_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Roles of the columns with row and null counts; a copy of the label is none."""
    rows = cleaned(spark, sf).withColumn("label", F.col("price")).withColumn("line", F.lit(1))
    return role_report(rows, column_roles(rows, "price", exclude=["row_key"]))


_ROLES = {
    "returnflag": ("categorical", "string"),
    "linestatus": ("categorical", "string"),
    "linenumber": ("numeric", "double"),
    "discount": ("numeric", "double"),
    "tax": ("numeric", "double"),
    "discount_na": ("numeric", "double"),
    "tax_na": ("numeric", "double"),
    "row_key": ("excluded", "on request"),
    "price": ("excluded", "label"),
    "label": ("excluded", "derived from the label"),
    "line": ("excluded", "type int"),
}
ORACLES["listing_roles"] = (
    f"WITH c AS (SELECT *, price AS label, 1 AS line FROM {SQL_CLEAN}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{role}' AS role, '{why}' AS reason, count(*) AS n_rows, "
        f"count(*) - count({c}) AS n_null FROM c"
        for c, (role, why) in _ROLES.items()
    )
)
