"""Word trends over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, spread_table, table
from trainlake.functions import words as W
from trainlake.functions.stopwords import stopwords
from trainlake.operators import trend
from trainlake.session import scratch_path, spread_scan
from trainlake.sources.documents import read_documents, text_field
from trainlake.sources.tables import ingest_if_absent, write_table

QUERIES = Queries()
ORACLES: dict[str, str] = {}


def _sql_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in stopwords())


def _sql_steps(c: str) -> str:
    """The step-by-step cleaning, as SQL."""
    for pattern in (r"http\S+", "[[:punct:]]", "[0-9]", "[^a-zA-Z]"):
        c = f"trim(regexp_replace({c}, '{pattern}', ' ', 'g'))"
    return f"lower({c})"


def _sql_words(source: str, text: str, by: str = "") -> str:
    return (
        f"SELECT {by} unnest(string_split({_sql_steps(text)}, ' ')) AS word "
        f"FROM {source} WHERE {text} IS NOT NULL"
    )


def _sql_counts(source: str, text: str, by: str = "") -> str:
    by = f"{by}, " if by else ""
    return (
        f"SELECT {by} word, count(*) AS count FROM ({_sql_words(source, text, by)}) "
        f"WHERE length(word) > 3 AND word NOT IN ({_sql_list()}) GROUP BY ALL"
    )


def oracles() -> dict[str, str]:
    counted = {
        "trend_documents": _sql_counts("documents", "text"),
        "trend_pages": _sql_counts("pages", "html"),
        "trend_urls": _sql_counts("pages", "concat_ws(' ', url, html)"),
        "trend_conversations": _sql_counts("conversations", "text"),
        "trend_sink_roundtrip": _sql_counts("pages", "html"),
        "trend_by_lang": _sql_counts("documents", "text", "lang"),
        "trend_top100": _sql_counts("documents", "text") + " ORDER BY count DESC, word LIMIT 100",
    }
    return counted | ORACLES


@QUERIES
def trend_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Words of the documents by falling count."""
    return trend.trending(spread_table(spark, sf, "documents", "text"), text_field("sample"))


@QUERIES
def trend_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Words of raw web pages."""
    return trend.trending(spread_table(spark, sf, "pages", "html"), "html")


@QUERIES
def trend_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Words of pages with their address in front, which must not count."""
    text = F.concat_ws(" ", "url", "html")
    return trend.trending(spread_table(spark, sf, "pages", "url", "html"), text)


@QUERIES
def trend_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as JSON documents with a nested text field."""
    path = scratch_path(spark, "conversations")
    nested = spread_table(spark, sf, "conversations", "text").select(F.struct(F.col("text").alias("content")).alias("interaction"))
    write_table(nested, path, "json")
    read = read_documents(spark, path, schema=nested.schema)
    return trend.trending(read, text_field("twitter-sample"))


@QUERIES
def trend_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts by language."""
    return trend.word_counts(spread_table(spark, sf, "documents", "text", "lang"), "text", by=["lang"])


@QUERIES
def trend_top100(spark: SparkSession, sf: str) -> DataFrame:
    """The hundred most frequent words."""
    return trend.trending(spread_table(spark, sf, "documents", "text"), "text", top=100)


@QUERIES
def trend_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A5: the trend table written over an older one and read back."""
    path = scratch_path(spark, "trends")
    write_table(trend.word_counts(spread_table(spark, sf, "documents", "text"), "text"), path)
    write_table(trend.trending(spread_table(spark, sf, "pages", "html"), "html"), path)
    return spark.read.parquet(path)


@QUERIES
def ingest_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The second load finds the target present and changes nothing."""
    path = scratch_path(spark, "ingest")
    ingest_if_absent(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), path)
    ingest_if_absent(table(spark, sf, "labels").select("doc_id"), path)
    return spark.read.parquet(path)


ORACLES["ingest_twice"] = "SELECT doc_id, lang, n_chars FROM documents"


@QUERIES
def clean_text_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned text of each document, as a fingerprint of it."""
    rows = spread_table(spark, sf, "documents", "doc_id", "text").filter(F.col("text").isNotNull())
    clean = W.clean_steps(F.col("text"))
    return rows.select("doc_id", F.md5(clean).alias("digest"), F.length(clean).cast("bigint").alias("n_chars"))


ORACLES["clean_text_rows"] = (
    "SELECT doc_id, md5(clean) AS digest, length(clean) AS n_chars FROM "
    f"(SELECT doc_id, {_sql_steps('text')} AS clean FROM documents WHERE text IS NOT NULL)"
)


def _step(source: str, key: str, text: str, op: str, name: str, step, pattern: str) -> None:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        stripped = step(F.expr(text))
        return spread_scan(table(spark, sf, source)).select(key, F.md5(stripped).alias("digest"))

    query.__name__, query.__doc__ = name, f"{op}: one cleaning step over whole texts."
    QUERIES(query)
    sql = f"trim(regexp_replace({text}, '{pattern}', ' ', 'g'))"
    ORACLES[name] = f"SELECT {key}, md5({sql}) AS digest FROM {source}"


_step("pages", "page_id", "concat_ws(' ', url, html, url)", "B9", "strip_urls", W.strip_urls, r"http\S+")
_step("pages", "page_id", "html", "B10", "strip_punct", W.strip_punct, "[[:punct:]]")
_step("documents", "doc_id", "text", "B11", "strip_digits", W.strip_digits, "[0-9]")
_step("documents", "doc_id", "text", "B12", "letters_only", W.letters_only, "[^a-zA-Z]")


@QUERIES
def token_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """Words by language: all, long enough, and no stopwords."""
    words = trend.tokens(spread_table(spark, sf, "documents", "text", "lang"), F.col("text"), ["lang"]).filter("word <> ''")
    long_enough = F.length("word") > 3
    counted = words.groupBy("lang").agg(
        F.count(F.lit(1)).alias("1_words"), F.count_if(long_enough).alias("2_long"),
        F.count_if(long_enough & ~F.col("word").isin(*stopwords())).alias("3_kept"),
    )
    stages = counted.unpivot(["lang"], ["1_words", "2_long", "3_kept"], "stage", "n")
    return stages.filter("n > 0").select("stage", "lang", "n")


ORACLES["token_funnel"] = (
    f"WITH w AS ({_sql_words('documents', 'text', 'lang, ')}) "
    "SELECT '1_words' AS stage, lang, count(*) AS n FROM w WHERE word <> '' GROUP BY ALL UNION ALL "
    "SELECT '2_long', lang, count(*) FROM w WHERE length(word) > 3 GROUP BY ALL UNION ALL "
    f"SELECT '3_kept', lang, count(*) FROM w WHERE length(word) > 3 AND word NOT IN ({_sql_list()}) GROUP BY ALL"
)
