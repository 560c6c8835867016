"""Token id files: each document compressed for itself with one shared zstandard dictionary.

A store is a folder with two tables. ``dictionary`` has one row: the dictionary and its hash.
``blocks`` has one row for each block of documents in ascending doc_id order; its payload is

    magic 4 bytes | id width u8 | dictionary hash u64 | documents u32
    for each document: doc_id i64 | known u8 | ids u64 | position u64 | size u32
    the zstandard frames, one after the other

all little-endian; positions count from the first frame. The header is the offset index: one
document is read by skipping to its block (file statistics of first_id and last_id), then
to its frame, and decompressing nothing else.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from trainlake.llm.tokens import encoder
from trainlake.session import small_batches

MAGIC = b"TLID"
_HEAD, _ENTRY = struct.Struct("<4sBQI"), struct.Struct("<qBQQI")
LEVEL = 3
#: The dictionary is trained on at most so many texts, of each at most so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 2000, 4000, 64 << 10
BLOCK_BYTES = 1 << 20

BLOCKS = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("block", T.LongType()),
    T.StructField("first_id", T.LongType()), T.StructField("last_id", T.LongType()),
    T.StructField("start_in_part", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])
_BLOCK = pa.schema([(f.name, pa.binary() if f.name == "payload" else pa.int64()) for f in BLOCKS])
_TOKENS = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
TOKENS = "part long, doc_id long, start_in_part long, n_tokens long, ids binary"


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def train(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> tuple[bytes, int, int]:
    """Dictionary, its hash and the id width, from a bounded sample; no dictionary if the sample is too small."""
    encode = encoder(tokenizer_path)
    width = 2 if encode.vocabulary <= 1 << 16 else 4
    sample = docs.filter("text <> ''").select(F.substring("text", 1, SAMPLE_CHARS)).limit(SAMPLE_TEXTS).collect()
    pieces = [_narrow(ids, width) for ids in encode.encode([r[0] for r in sample])]
    try:
        found = zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"", 0, width
    return found, xxhash.xxh3_64_intdigest(found), width


def _compressor(dictionary: bytes):
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def encode_block(docs: list[tuple[int | None, bytes]], compressor, dictionary_hash: int, width: int) -> bytes:
    """The payload of some documents, given as doc_id and ids of 32 bits."""
    frames = [compressor.compress(_narrow(ids, width)) for _, ids in docs]
    parts, at = [_HEAD.pack(MAGIC, width, dictionary_hash, len(docs))], 0
    for (doc_id, ids), frame in zip(docs, frames, strict=True):
        parts.append(_ENTRY.pack(doc_id or 0, doc_id is not None, len(ids) // 4, at, len(frame)))
        at += len(frame)
    return b"".join(parts + frames)


def read_index(payload: bytes) -> tuple[int, int, list[tuple]]:
    """Id width, dictionary hash, and doc_id, ids, position and size of each document."""
    magic, width, dictionary_hash, n = _HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    base = _HEAD.size + n * _ENTRY.size
    entries = _ENTRY.iter_unpack(payload[_HEAD.size : base])
    return width, dictionary_hash, [(d if known else None, ids, base + at, size) for d, known, ids, at, size in entries]


def decode_block(payload: bytes, decompressor, dictionary_hash: int, only: int | None = None) -> Iterator[tuple[int | None, bytes]]:
    """doc_id and ids of 32 bits of each document, or of the documents with one doc_id."""
    width, stored, index = read_index(payload)
    if stored != dictionary_hash:
        raise ValueError("the block was written with another dictionary")
    for doc_id, _, at, size in index:
        if only is None or doc_id == only:
            raw = decompressor.decompress(payload[at : at + size])
            yield doc_id, np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes()


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, block_bytes: int = BLOCK_BYTES) -> None:
    """Encode every text, append the end id and write the store.

    docs needs doc_id and text; other columns are not looked at. A NULL or empty text is a
    document of the end id alone. Rows with one doc_id are all kept, ordered by a hash of
    their text; NULL ids come first. An empty table gives a store without blocks.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    dictionary, dictionary_hash, width = train(spark, docs, tokenizer_path)

    def blocks(batches):
        part, block, start = TaskContext.get().partitionId(), 0, 0
        encode, compressor, end = encoder(tokenizer_path).encode, _compressor(dictionary), np.array([end_id], "<u4").tobytes()
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def row():
            n = sum(len(ids) for _, ids in held) // 4
            known = [d for d, _ in held if d is not None]
            values = (part, block, known[0] if known else None, known[-1] if known else None, start, n, encode_block(held, compressor, dictionary_hash, width))
            return n, pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCK, strict=True)], schema=_BLOCK)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((doc_id, encode([text.as_py()])[0] + end))
                size += len(held[-1][1])
                if size >= 2 * block_bytes:  # ids compress to about half
                    n, out = row()
                    yield out
                    held, size, block, start = [], 0, block + 1, start + n
        if held:
            yield row()[1]

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    spark.createDataFrame([(str(dictionary_hash), bytearray(dictionary))], "hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    with small_batches(spark):
        ranged.mapInArrow(blocks, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def _dictionary(spark: SparkSession, path: str) -> tuple[bytes, int]:
    (row,) = spark.read.parquet(f"{path}/dictionary").collect()  # one row of at most DICTIONARY_BYTES
    found = bytes(row.dictionary)
    if found and xxhash.xxh3_64_intdigest(found) != int(row.hash):
        raise ValueError("the dictionary is damaged")
    return found, int(row.hash)


def read_tokens(spark: SparkSession, path: str, only: int | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids of the stored documents.

    ids are little-endian unsigned 32-bit numbers, start counts the ids of all documents before.
    With ``only``, the documents of one id: other blocks are skipped and other frames not opened.
    """
    dictionary, dictionary_hash = _dictionary(spark, path)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row for each written part: a window over the list of parts, not over documents.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def documents(batches):
        decompressor = _decompressor(dictionary)
        for batch in batches:
            for part, start, payload in zip(*(batch.column(k) for k in range(3)), strict=True):
                data, at, rows = payload.as_py(), start.as_py(), []
                if only is None:
                    for doc_id, ids in decode_block(data, decompressor, dictionary_hash):
                        rows.append((part.as_py(), doc_id, at, len(ids) // 4, ids))
                        at += len(ids) // 4
                else:
                    found = decode_block(data, decompressor, dictionary_hash, only)
                    for doc_id, n, *_ in read_index(data)[2]:
                        if doc_id == only:
                            rows.append((part.as_py(), doc_id, at, n, next(found)[1]))
                        at += n
                columns = zip(*rows, strict=True) if rows else [[]] * len(_TOKENS)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TOKENS, strict=True)], schema=_TOKENS)

    wanted = blocks if only is None else blocks.filter((F.col("first_id") <= only) & (F.col("last_id") >= only))
    opened = wanted.select("part", "start_in_part", "payload").mapInArrow(documents, TOKENS)
    # One row for each written part, of at least a block each but the last.
    return opened.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")
