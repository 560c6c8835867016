"""The corpus pipeline: documents are cleaned, made single, decontaminated, made private and packed.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again for
the next. All but the last return the columns of documents, with any others that docs has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.llm import decontaminate, jaccard, packing, pii, toxicity
from trainlake.llm.catalog import KEY, TOKENIZER
from trainlake.llm.common import fresh
from trainlake.session import materialise, scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns from the labelled documents of sf_dir."""
    known = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.fit(known, spark.read.parquet(f"{sf_dir}/labels.parquet"), toxicity.may_learn(F.col("doc_id")))
    scored = toxicity.score(docs, model)
    return scored.filter(F.col(scored.columns[-1]) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the row with the smallest doc_id stays.

    Repeated rows are duplicates, too: of rows with one doc_id the first stays. NULL ids come last. Rows
    without words stay. docs is read several times and has to give the same rows in the same order each time, as a
    written table does: rows are told apart by their place in it.
    """
    row, root = fresh(docs, "row", "root")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    known = numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    texts = numbered.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text"))
    groups = jaccard.link(texts, words=5, percent=80).filter("root IS NOT NULL").select("row", "root")
    members = materialise(known.join(groups, "row"), "members")
    first = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
    later = members.join(first.filter("n > 1"), "root").filter(F.col("row") != F.col("first.row")).select(F.col("row").alias(row))
    return numbered.join(materialise(later, "later"), row, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item is found."""
    found = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size(F.col(found.columns[-1])) == 0).select(*docs.columns)


def give_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates for personal data; n_chars follows the new text where it was known."""
    private = pii.replace(docs, KEY).select(*docs.columns)
    if "n_chars" in docs.columns:
        private = private.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return private


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids, in buckets of equal length."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), end_id=0, longest=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", give_surrogates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Toxicity, surrogates and tokens are beyond SQL.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
