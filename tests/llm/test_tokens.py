import zlib
from contextlib import contextmanager

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.rows import edge_rows, no_rows
from trainlake.llm import catalog, packing, token_files
from trainlake.llm.tokens import Encoder
from trainlake.session import small_batches

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
OURS = Encoder(PATH, cached=50)


def plain(text, end):
    return np.array(PLAIN.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\x0b\x1c\x85\xa0   aZbéß'’sdtmre.,!?1２½ж語😀́-_|:;<>", max_size=30))
def test_pieces_give_the_ids_of_the_whole_text(text):
    assert OURS.encode([text])[0] == plain(text, 0)[:-1].tobytes()


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endo", "a\x00b \x00", "<|endoftext|", "it's 'super"])
def test_special_strings_and_odd_characters_as_the_library_takes_them(text):
    assert OURS.encode([text])[0] == plain(text, 0)[:-1].tobytes()


def test_words_with_accents_come_from_the_model_itself():
    text = "À bientôt, façon für Straße ýÿ ñandú.\nöde œuf" + " ".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    words, without = Encoder(PATH), text.replace("œuf", "")
    assert words.encode([text])[0] == plain(text, 0)[:-1].tobytes()
    others, ask = [], words._joined

    class Asked:
        def encode_batch_fast(self, texts, **options):
            others.extend(texts)
            return ask.encode_batch_fast(texts, **options)

    words._joined, words._newer, words._older = Asked(), {}, {}
    words.encode([without])
    assert others and all(t.isascii() for t in others)


def test_forgotten_pieces_are_asked_for_again():
    few = Encoder(PATH, cached=6)
    texts = [" ".join(f"word{i * j % 17}" for i in range(40)) for j in range(30)] + ["x" * 500 + " y"]
    assert few.encode(texts) == [plain(t, 0)[:-1].tobytes() for t in texts] and len(few._newer) <= 3


@pytest.mark.parametrize("tokens", [1, 2, 3, 1023, 1024, 1025, 5000])
def test_lengths_are_powers_of_two(tokens):
    found = packing.lengths(tokens, 1024)
    assert sum(found) == tokens and all(n & (n - 1) == 0 and n <= 1024 for n in found) and found == sorted(found, reverse=True)


def test_numbering_sequences_shuffles_no_ids(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables whose size is not known to be small
    try:
        docs = spark.createDataFrame([(1, "a b c"), (2, "d " * 3000), (None, None)], "doc_id long, text string")
        packed = packing.pack(docs, PATH, end_id=0, longest=1024)
        plan = packed._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert sorted(r.sequence_id for r in packed.collect()) == list(range(packed.count()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packing_query_covers_every_id_once(spark):
    docs = {r.doc_id: plain(r.text, 0) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = catalog.op2_power_of_two(spark, SMALL).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows))) and {r.offset for r in rows} == {0}
    order = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert order == sorted(order, reverse=True)
    seen = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen.get(r.doc_id, 0) and r.doc_tokens == len(docs[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(docs[r.doc_id][r.start : r.start + r.length].tobytes())
        seen[r.doc_id] = r.start + r.length
    assert seen == {k: len(v) for k, v in docs.items()}


def test_packing_edge_rows(spark):
    packed = packing.pack(edge_rows(spark), PATH)
    ends = packed.filter("doc_tokens = 1")
    assert {(r.doc_id, r.length) for r in ends.collect()} == {(1, 1), (2, 1), (None, 1)}
    assert packed.filter("doc_id = 4").count() == 2 * packed.filter("doc_id IS NULL AND doc_tokens > 1").count()
    assert packing.pack(no_rows(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(edge_rows(spark), PATH, longest=1000)


def test_files_query_round_trip(spark):
    start, expected = 0, []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = plain(r.text, 2)
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, catalog.op10_dictionary_frames(spark, SMALL).collect())) == expected


def test_files_edge_rows_and_short_access(spark, tmp_path):
    path = str(tmp_path / "store")
    token_files.write_tokens(edge_rows(spark), path, PATH, 2, block_bytes=64)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert len(rows) == 9 and rows[0].doc_id is None and rows[-1].doc_id == 6
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(9)]
    found = token_files.read_tokens(spark, path, only=4).collect()
    assert sorted((r.start, bytes(r.ids)) for r in found) == sorted((r.start, bytes(r.ids)) for r in rows if r.doc_id == 4)
    empty = str(tmp_path / "empty")
    token_files.write_tokens(no_rows(spark), empty, PATH, 2)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_files_refuse_another_dictionary(spark, tmp_path):
    path = str(tmp_path / "store")
    token_files.write_tokens(spark.read.parquet(f"{SMALL}/documents.parquet"), path, PATH, 2)
    (row,) = spark.read.parquet(f"{path}/dictionary").collect()
    payload = bytes(spark.read.parquet(f"{path}/blocks").first().payload)
    assert row.dictionary and token_files.read_index(payload)[1] == int(row.hash)
    with pytest.raises(ValueError):
        list(token_files.decode_block(payload, token_files._decompressor(bytes(row.dictionary)), 1))
    assert spark.read.parquet(f"{path}/blocks").agg(F.sum("n_tokens")).first()[0] > 0


@pytest.mark.parametrize("module", [token_files, packing])
def test_texts_come_few_at_a_time(spark, tmp_path, monkeypatch, module):
    inside = []

    @contextmanager
    def watched(session):
        with small_batches(session):
            yield
            inside.append(sorted(p.name for p in tmp_path.rglob("_SUCCESS")) and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))

    monkeypatch.setattr(module, "small_batches", watched)
    monkeypatch.setattr(packing, "scratch_path", lambda *_: str(tmp_path / "packed"))
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    if module is packing:
        assert packing.pack(docs, PATH).count() == 3
    else:
        token_files.write_tokens(docs, str(tmp_path / "store"), PATH, end_id=2)
    assert inside == ["256"]
