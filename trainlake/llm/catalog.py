"""The registered queries of these operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, table
from trainlake.llm import chat, decontaminate, divergence, html, jaccard, language, licenses, neighbours, packing, pii, token_files, toxicity, trie
from trainlake.llm.common import fold
from trainlake.session import scratch_path

QUERIES = Queries()
ORACLES: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"
#: The key of surrogates; a real job takes it from its secret store.
KEY = "surrogate key of the registered queries"


@QUERIES
def op1_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of all documents with surrogates in place of personal data."""
    return pii.replace(table(spark, sf, "documents").select("doc_id", "text"), KEY)


@QUERIES
def op2_power_of_two(spark: SparkSession, sf: str) -> DataFrame:
    """Pieces of all documents in buckets of equal length."""
    packed = packing.pack(table(spark, sf, "documents"), public_tokenizers.path(TOKENIZER), end_id=0, longest=1024)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@QUERIES
def op3_compression_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"), toxicity.may_learn(F.col("doc_id")))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@QUERIES
def op4_nn_descent(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of near-duplicate embeddings of one label."""
    return neighbours.near_vectors(table(spark, sf, "embeddings"), least=0.93)[0]


@QUERIES
def op5_license_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.scan(table(spark, sf, "documents").select("doc_id", "text"))


@QUERIES
def op6_equivalence_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of all pages."""
    found = html.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@QUERIES
def op7_block_max_wand(spark: SparkSession, sf: str) -> DataFrame:
    """Test items found in all documents, one row for each document and item."""
    found = decontaminate.find_leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@QUERIES
def op8_adaptive_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Components of near duplicates over 4-grams among all documents."""
    return jaccard.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"), words=4, percent=85)


@QUERIES
def op9_output_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Language of all documents."""
    docs = table(spark, sf, "documents")
    model = language.fit(docs, language.may_learn(F.col("doc_id")))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return language.identify(docs, model).select("doc_id", held_out, "lang_pred", "score", "ambiguous")


@QUERIES
def op10_dictionary_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of all documents, read back from the files they were written to."""
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=2)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


#: A conversation that holds the marks of a chat template.
MARKED = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


@QUERIES
def op11_budgeted_windows(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one that holds the template's marks, in windows written and read back."""
    said = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    path = scratch_path(spark, "chat-windows")
    chat.format_windows(said.union(spark.createDataFrame(MARKED, said.schema)), public_tokenizers.path(TOKENIZER)).write.parquet(path)
    return chat.digests(spark.read.parquet(path))


@QUERIES
def op12_duplicate_text_collapse(spark: SparkSession, sf: str) -> DataFrame:
    """Divergence of the sources of each language, and the terms that set a source apart."""
    return divergence.divergence(table(spark, sf, "documents").select("text", "lang", "source"))


_UPPER, _LOWER = (bytes(range(c, c + 26)).decode() for c in b"Aa")
ORACLES["op12_duplicate_text_collapse"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
terms AS (
    SELECT row, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
),
vocabulary AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM vocabulary GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN vocabulary USING (lang, term) GROUP BY lang, source, term),
named AS (SELECT DISTINCT lang, source FROM docs),
full_counts AS (
    SELECT g.lang, g.source, w.term, coalesce(c.n, 0) AS n FROM named g JOIN vocabulary w ON g.lang = w.lang
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = w.term
),
shares AS (
    SELECT f.lang, f.source, f.term, f.n, 1 + (1000000000::HUGEINT * (f.n + 2)) // (sum(f.n) OVER (PARTITION BY f.lang, f.source) + 2 * s.v) AS p
    FROM full_counts f JOIN sizes s ON f.lang = s.lang
),
whole AS (SELECT lang, term, sum(n) AS n FROM full_counts GROUP BY lang, term),
lang_shares AS (
    SELECT w.lang, w.term, 1 + (1000000000::HUGEINT * (w.n + 2)) // (sum(w.n) OVER (PARTITION BY w.lang) + 2 * s.v) AS q
    FROM whole w JOIN sizes s ON w.lang = s.lang
),
sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM named a JOIN named b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
own AS (
    SELECT s.lang, s.source, s.term AS item, ((s.p - l.q) * (s.p - l.q)) // (s.p + l.q) AS value
    FROM shares s JOIN lang_shares l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND s.p > l.q
),
parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM own)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""


@QUERIES
def op13_union_find_lcp(spark: SparkSession, sf: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf, "conversations"))
