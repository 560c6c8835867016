"""Packing by powers of two.

Each document is cut into pieces whose lengths are powers of two: as many of the longest
length as fit, then the binary digits of the rest, longest first. Pieces of one length form a
bucket, and every piece is a sequence of its own: no sequence crosses documents and none is
padded. A training step takes a batch from one bucket, with as many sequences as fit its tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.tokens import encoder
from trainlake.session import scratch_path, small_batches

SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary"
_ROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
])
#: Ids sent back to Spark at a time.
BATCH_BYTES = 8 << 20


def lengths(tokens: int, longest: int) -> list[int]:
    """Powers of two that add up to the tokens, none above the longest, in falling order."""
    whole, rest = divmod(tokens, longest)
    bits = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return [longest] * whole + bits


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_ROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROW, strict=True)], schema=_ROW)


def cut_documents(docs: DataFrame, tokenizer_path: str, end_id: int, longest: int) -> DataFrame:
    """One row for each piece with its ids as little-endian unsigned 32-bit numbers."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def cut(batches):
        encode, end = encoder(tokenizer_path).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode([text.as_py()])[0] + end
                total, start = len(ids) // 4, 0
                for n in lengths(total, longest):
                    rows.append((doc_id, start, n, total, ids[4 * start : 4 * (start + n)]))
                    start += n
                    size += 4 * n
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
            yield _batch(rows)

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(cut, SCHEMA)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, longest: int = 1024) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids, sequence_id, offset of each piece.

    docs needs doc_id and text; other columns are not looked at. A NULL or empty text is a
    document of the end id alone. Every row is packed for itself: repeated rows give repeated
    pieces in sequences of their own, and a NULL doc_id stays NULL. An empty table gives no rows.

    The pieces are written once, sorted by length within each file, so that a loader reads one
    bucket by skipping row groups. Sequences are numbered from 0 without gaps, longest bucket
    first, by the position of a piece in its file; only the counts of each file and length are
    shuffled for it, never ids.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "packed")
    cut = cut_documents(docs, tokenizer_path, end_id, longest)
    with small_batches(spark):
        cut.sortWithinPartitions(F.desc("length")).write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(cut.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    counts = stored.groupBy("length", "file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n")).select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("longer"))
    earlier = Window.partitionBy("length").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "file", "first_at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    # A file holds at most one row for each power of two: the join side is as small as the list of files.
    first = before.join(F.broadcast(buckets), "length").select("length", "file", (F.col("longer") + F.col("earlier") - F.col("first_at")).alias("base"))
    # Sent to all tasks, so that no ids are shuffled for it.
    return stored.join(F.broadcast(first), ["length", "file"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.col("base") + F.col("at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
