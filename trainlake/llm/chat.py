r"""Chat formatting in windows of a token budget.

A turn is written as ``<turn>role\ntext</turn>\n``. Marks, backslashes and the openings of the tokenizer's special
strings inside roles and texts are broken by a backslash after their first character (before it, for a backslash), so that none is
left in a text and unescape() gives back every string.

Windows are cut by prefix sums. Without its system turn, each turn covers the tokens from its prefix sum to the next; a grid
of cells, as wide as the budget leaves room after the system turn and the repeated history, is laid over them. The turns inside a cell make one
window, and a turn that lies across a cell's end makes one of its own. So a turn's window depends on two numbers of its own
and no task walks along a conversation. A window repeats the system turn and as many of the turns just before it as fit
the history; repeated targets are masked, so that each is learned once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.llm.tokens import encoder
from trainlake.llm.turns import clean_turns, running, turn_order

OPEN, CLOSE = "<turn>", "</turn>"
SYSTEM, TARGET = "system", "assistant"
#: What texts must not hold as it is: the marks, and what opens a special string of the tokenizer.
CONTROL = (OPEN, CLOSE, "<|")
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<turn>((?:[^\\\n]|\\.)*)\n(.*?)</turn>\n", re.DOTALL)
#: Part of the budget that is left for new turns however long the system turn is.
LEAST_ROOM = 4

_ADDED = "formatted string, chars long, head long"
#: Rows taken apart at a time.
ROWS = 256
WINDOWS = "conv_id long, first_turn long, repeated int, n_tokens long, text string, loss array<struct<start:long,length:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_WINDOW = pa.schema([("conv_id", pa.int64()), ("first_turn", pa.int64()), ("repeated", pa.int32()), ("n_tokens", pa.int64()), ("text", pa.string()), ("loss", _SPANS)])


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The turn as it is written, and the code points before its text."""
    head = OPEN + escape(role).replace("\n", "\\\n") + "\n"
    return head + escape(text) + CLOSE + "\n", len(head)


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns of a window; an error if anything else is in it."""
    found, end = [], 0
    for m in _TURN.finditer(text):
        if m.start() != end:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        end = m.end()
    if end != len(text):
        raise ValueError("not a sequence of formatted turns")
    return found


def _formatted(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Turns with their written form, its code points, those before the text, and prefix sums of tokens.

    The system turn that leads a conversation weighs nothing: every window has it. ``lead`` is its length, -1 where there is none.
    """

    def extend(batch):
        encode, columns, tokens, system = encoder(tokenizer_path).encode, [[], [], []], [], []
        for part in _slices(batch):
            for role, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                written, head = format_turn(role, text)
                for column, value in zip(columns, (written, len(written), head), strict=True):
                    column.append(value)
                tokens.append(len(encode([written])[0]) // 4)
                system.append(role == SYSTEM)
        weights = np.array(tokens, np.int64)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)]
        return arrays, weights, np.where(system, weights, -1)

    return running(clean_turns(conversations), "conv_id", turn_order(), extend, _ADDED)


def format_windows(conversations: DataFrame, tokenizer_path: str, budget: int = 512, history: int = 128) -> DataFrame:
    r"""conv_id, first_turn, repeated, n_tokens, text and loss of each window.

    conversations needs conv_id, turn, role and text; other columns are not looked at. Turns are ordered by turn, NULL first, then
    by role and text; repeated rows are turns of their own. NULL roles and texts are empty, and rows without a conv_id are one
    conversation. An empty table gives no windows.

    ``first_turn`` is the position of the window's first new turn (0 with the system turn in the first window), ``repeated`` how many turns at
    its start are repeated, ``loss`` the spans of new assistant texts in code points. A window has more tokens than the
    budget only if it is a single longer turn with what it repeats, or if the system turn takes more than three quarters of what the history leaves.

    Turns are shuffled twice: ranged to be numbered, then to their cell; a cell holds at most budget and history tokens and one turn across its end.
    """
    if not 0 <= history < budget:
        raise ValueError("the history must be shorter than the budget")
    turns = _formatted(conversations, tokenizer_path)
    leads = (F.col("at") == 0) & (F.col("role") == SYSTEM)
    has = F.col("lead") >= 0
    room = F.greatest(F.lit(budget - history) - F.greatest("lead", F.lit(0)), F.lit(max(1, (budget - history) // LEAST_ROOM)))
    start = F.col("before") - F.when(has, F.col("lead")).otherwise(0)
    placed = turns.select(
        "conv_id", "at", (F.col("role") == TARGET).alias("target"), "formatted", "chars", "head", F.col("weight").alias("tokens"),
        leads.alias("system"), start.cast("long").alias("start"), room.cast("long").alias("room"), "lead",
    )
    body = placed.filter("NOT system")
    # A turn is new in the cell it begins in, and may be history for what begins up to `history` tokens after it.
    reach = F.when(F.col("tokens") <= history, F.col("start") + history).otherwise(F.col("start"))
    cells = body.withColumn("cell", F.explode(F.sequence(F.expr("start div room"), F.floor(reach / F.col("room")).cast("long"))))
    # The system turn goes to all cells of its conversation.
    ends = body.filter("lead >= 0").groupBy("conv_id").agg(F.max(F.expr("start div room")).alias("last"))
    system = placed.filter("system").alias("p").join(ends.alias("e"), F.col("p.conv_id").eqNullSafe(F.col("e.conv_id")), "left").select(
        "p.*", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("e.last", F.lit(0).cast("long")))).alias("cell")
    )
    fields = ("start", "at", "tokens", "target", "formatted", "chars", "head", "system")
    grouped = cells.unionByName(system).groupBy("conv_id", "cell").agg(
        F.first("room").alias("room"), F.first("lead").alias("lead"), F.sort_array(F.collect_list(F.struct(*fields))).alias("turns")
    )

    def assemble(batches):
        for batch in batches:
            for part in _slices(batch):
                rows = [w for row in part.to_pylist() for w in _windows(row, history)]
                columns = [[r[k] for r in rows] for k in range(len(_WINDOW))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _WINDOW, strict=True)], schema=_WINDOW)

    return grouped.mapInArrow(assemble, WINDOWS)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS))


def _windows(cell: dict, history: int) -> Iterator[tuple]:
    """The windows that begin in a cell: one of the turns inside it, one of the turn across its end."""
    turns = cell["turns"]
    system = turns[:1] if turns[0]["system"] else []
    body = turns[len(system) :]
    if system and not body and not cell["cell"]:
        yield _window(cell["conv_id"], [], system)
    end = (cell["cell"] + 1) * cell["room"]
    own = [t for t in body if t["start"] >= end - cell["room"]]
    for new in ([t for t in own if t["start"] + t["tokens"] <= end], [t for t in own if t["start"] + t["tokens"] > end]):
        if new and not new[0]["start"]:
            yield _window(cell["conv_id"], [], system + new)
        elif new:
            at = new[0]["start"]
            yield _window(cell["conv_id"], system + [t for t in body if at - history <= t["start"] < at], new)


def _window(conv_id: int | None, repeated: list[dict], new: list[dict]) -> tuple:
    at, loss = sum(t["chars"] for t in repeated), []
    for t in new:
        if t["target"]:
            loss.append({"start": at + t["head"], "length": t["chars"] - t["head"] - len(CLOSE) - 1})
        at += t["chars"]
    turns = repeated + new
    return conv_id, new[0]["at"], len(repeated), sum(t["tokens"] for t in turns), "".join(t["formatted"] for t in turns), loss


_TURNS = "conv_id long, at long, role string, text string, loss string, window_chars long"
_TURN_ROW = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("loss", pa.string()), ("window_chars", pa.int64())])


def read_turns(windows: DataFrame) -> DataFrame:
    """The new turns of stored windows: conv_id, at, role, text, loss, window_chars.

    ``loss`` is what the mask covers of the turn, unescaped, NULL where it covers nothing; ``window_chars`` the window's length at
    its first new turn, else 0. Text under the mask that lies in no new turn is an error.
    """

    def read(batches):
        for batch in batches:
            for part in _slices(batch):
                rows = []
                for w in part.to_pylist():
                    text, spans, at, covered = w["text"], {(s["start"], s["length"]) for s in w["loss"]}, 0, 0
                    for k, (role, said) in enumerate(parse(text)):
                        written, head = format_turn(role, said)
                        span = at + head, len(written) - head - len(CLOSE) - 1
                        at += len(written)
                        if k >= w["repeated"]:
                            masked = span in spans
                            covered += masked
                            loss = unescape(text[span[0] : sum(span)]) if masked else None
                            rows.append((w["conv_id"], w["first_turn"] + k - w["repeated"], role, said, loss, 0 if k > w["repeated"] else len(text)))
                    if covered != len(w["loss"]):
                        raise ValueError("the mask covers something else than new turns")
                columns = [[r[k] for r in rows] for k in range(len(_TURN_ROW))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _TURN_ROW, strict=True)], schema=_TURN_ROW)

    return windows.select("conv_id", "first_turn", "repeated", "text", "loss").mapInArrow(read, _TURNS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation: turns, digest of what was said, code points and digest of the masked text, code points written.

    SHA-256 runs over a conversation in order, so one task reads all windows of it; it holds one batch and the two running states.
    """

    def run(batches):
        state, held = None, []

        def rows(found):
            columns = [[r[k] for r in found] for k in range(len(_DIGEST))]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DIGEST, strict=True)], schema=_DIGEST)

        for batch in batches:
            for conv_id, role, text, loss, chars in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5)), strict=True):
                if state is None or state[0] != conv_id:
                    if state is not None:
                        held.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += chars
            yield rows(held)
            held = []
        if state is not None:
            yield rows([(state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])])

    ordered = read_turns(windows).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at")
    return ordered.mapInArrow(run, DIGESTS)
