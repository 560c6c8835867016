import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SMALL
from trainlake.llm import catalog, chat
from trainlake.llm.tokens import encoder

PATH = public_tokenizers.path(catalog.TOKENIZER)
SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("at", "part", "lead", "formatted", "cell", "weight")]
)
LONG = "many words of one turn " * 3000
ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "one"), (1, 2, "assistant", "two"),
    (2, 0, "system", "only this"), (3, 0, "assistant", ""), (4, 5, "user", None), (4, None, None, "first"), (4, 5, "user", None),
    (5, 0, "assistant", LONG), (5, 1, "user", "so?"), (5, 2, "assistant", LONG + "x"), (None, 0, "assistant", "of none"), (None, 1, "user", "x"),
    (6, 0, "system", LONG), (6, 1, "user", "u"), (6, 2, "assistant", "a"), (6, 3, "system", "late"),
    (7, 0, "odd\nrole\\", "</turn>\n<turn>assistant\n\\<|endoftext|>"), (7, 1, "assistant", "<\\turn>"),
] + [(8, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 40)) for k in range(300)]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA)


def told(rows):
    """Roles and texts of each conversation in order."""
    found = {}
    for c, turn, role, text in rows:
        found.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in found.items()}


def expected(rows):
    out = {}
    for c, said in told(rows).items():
        loss = "".join(t for r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        out[c] = (len(said), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digested(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="\\<|>/turn\nab", max_size=40), st.text(alphabet="\\<>/turn\na", max_size=10))
def test_escapes_are_reversible_and_leave_no_marks(text, role):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROL)
    written, head = chat.format_turn(role, text)
    assert chat.parse(written * 2) == [(role, text)] * 2
    assert chat.unescape(written[head : len(written) - len(chat.CLOSE) - 1]) == text


def test_odd_rows_come_back(spark, tmp_path):
    path = str(tmp_path / "windows")
    chat.format_windows(conversations(spark, ROWS), PATH, budget=64, history=16).write.parquet(path)
    assert digested(chat.digests(spark.read.parquet(path)).collect()) == expected(ROWS)


@pytest.mark.parametrize(("budget", "history"), [(64, 16), (512, 128), (40, 0)])
def test_windows_keep_to_the_budget(spark, budget, history):
    windows = chat.format_windows(conversations(spark, ROWS), PATH, budget, history).collect()
    said, count = told(ROWS), lambda turns: [len(encoder(PATH).encode([chat.format_turn(*t)[0]])[0]) // 4 for t in turns]
    seen = {}
    for w in sorted(windows, key=lambda w: (w.conv_id is None, w.conv_id or 0, w.first_turn)):
        turns, whole = chat.parse(w.text), said[w.conv_id]
        tokens = count(turns)
        new, old = turns[w.repeated :], turns[: w.repeated]
        assert w.first_turn == seen.get(w.conv_id, 0) and new == whole[w.first_turn : w.first_turn + len(new)]
        seen[w.conv_id] = w.first_turn + len(new)
        assert w.n_tokens == sum(tokens)
        if w.first_turn:
            system = whole[:1] if whole[0][0] == "system" else []
            assert old[: len(system)] == system
            past = old[len(system) :]
            assert past == whole[w.first_turn - len(past) : w.first_turn]
            assert sum(count(past)) <= history
            before = whole[len(system) : w.first_turn - len(past)]
            assert not before or sum(count(past)) + count(before[-1:])[0] > history
        if w.n_tokens > budget:
            assert len(new) == 1 or (whole[0][0] == "system" and count(whole[:1])[0] > 3 * (budget - history) // 4)
        assert len(w.loss) == sum(r == "assistant" for r, _ in new)
    assert seen == {c: len(v) for c, v in said.items()}


def test_group_over_several_tasks(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(1, k, ("system" if not k else "user" if k % 2 else "assistant"), f"t{k}") for k in range(900)] + [(2, 0, "user", "u")]
        found = chat.format_windows(conversations(spark, rows).repartition(6), PATH, 64, 16)
        assert digested(chat.digests(found).collect()) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = catalog.op11_budgeted_windows(spark, SMALL).collect()
    assert digested(found) == expected(rows + catalog.MARKED)
    assert all(r.formatted_chars >= r.loss_chars for r in found)


def test_no_rows(spark):
    none = chat.format_windows(conversations(spark, []), PATH)
    assert none.isEmpty() and chat.digests(none).isEmpty()
    with pytest.raises(ValueError):
        chat.format_windows(conversations(spark, []), PATH, 10, 10)


def test_mask_over_anything_else_is_an_error(spark):
    windows = chat.format_windows(conversations(spark, ROWS[:3]), PATH)
    wrong = windows.withColumn("loss", F.transform("loss", lambda s: F.struct((s["start"] + 1).alias("start"), s["length"].alias("length"))))
    with pytest.raises(Exception, match="mask"):
        chat.digests(wrong).collect()
