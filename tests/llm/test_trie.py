import hashlib
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tests.conftest import SMALL
from trainlake.llm import catalog, trie

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("kind", "key", "chars", "node", "at", "part")]
)


def sequences(rows):
    """The rebuilt turns of each conversation."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return found


def brute(found):
    """Every prefix of every sequence by itself."""
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))

    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] = sum(leaves[k] for k in children[prefix]) if children[prefix] else 1
        saved[prefix] = sum(saved[k] for k in children[prefix]) + ((len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0)
    rows = []
    for prefix, who in members.items():
        ends = sorted(c for c in who if len(found[c]) == len(prefix))
        rows.append((
            min(who), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(who), len(children[prefix]), leaves[prefix], saved[prefix],
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA)


def many():
    """Hot first turns, copies, conversations that are prefixes of others, one very long."""
    rows = [(c, k, ("user", "assistant")[k % 2], "hello" if k < c % 4 else f"{(c * 7 + k) % (3 + c % 5)}") for c in range(1, 700) for k in range(c % 9)]
    rows += [(c, k, "user", f"copy {k}") for c in range(1000, 1400) for k in range(7)]
    rows += [(2000, k, "user", f"long {k}") for k in range(400)] + [(2001, k, "user", f"long {k}") for k in range(350)]
    return rows + [(None, 0, "user", "of none"), (3000, None, None, None), (3000, None, None, None), (3001, 2, "user", "b"), (3001, 2, "assistant", "a"), (3100, 0, "user", "x" * 100_000)]


def level(keys, whole, named):
    kept, found = [], []
    for piece in trie.pieces(keys, whole, named):
        (found if piece["kind"] == "node" else kept).append(piece)
    return kept, found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=5), min_size=1, max_size=40), st.integers(1, 40), st.integers(2, 5))
def test_ranges_give_the_whole_trie(texts, wide, later):
    """Any cut into ranges, and any second cut of the contracted keys, gives the nodes of the brute-force trie."""
    found = {c: [("u", t * (ord(t) - 95)) for t in turns] for c, turns in enumerate(texts)}
    width = {t: t * trie.UNIT for t in "abc"}
    sorted_keys = sorted((("".join(width[t[0]] for _, t in turns), c, [len(t) for _, t in turns]) for c, turns in found.items()), key=lambda x: x[:2])
    kept, nodes = [], []
    for k in range(0, len(sorted_keys), wide):
        batch = pa.RecordBatch.from_arrays(
            [pa.array([c for _, c, _ in sorted_keys[k : k + wide]]), pa.array([t for t, *_ in sorted_keys[k : k + wide]]), pa.array([n for *_, n in sorted_keys[k : k + wide]], pa.list_(pa.int64()))],
            names=["conv_id", "key", "chars"],
        )
        for out in trie._first_pieces([batch.slice(0, 2), batch.slice(2)]):
            for piece in out.to_pylist():
                (nodes if piece["kind"] == "node" else kept).append(piece)
    ids = sorted((p for p in kept if p["kind"] == "ids"), key=lambda p: (p["node"], p["conv_id"]))
    ids = [i for n, i in enumerate(ids) if i not in ids[:n]]
    chunks = pa.RecordBatch.from_arrays([pa.array([p[c] for p in ids], t) for c, t in (("node", pa.string()), ("conv_id", pa.int64()), ("ids", pa.string()))], names=["node", "conv_id", "ids"])
    digests = {r["node"]: r["sha"] for out in trie._digest_ids([chunks]) for r in out.to_pylist()}
    kept, upper = [p for p in kept if p["kind"] == "key"], []
    as_keys = lambda ps: sorted((trie.Key(p["key"], p["chars"], [trie.Below(**b) for b in p["hanging"]]) for p in ps), key=lambda k: k.text)
    while len(kept) > 2 * later:
        keys, kept_now = as_keys(kept), []
        for k in range(0, len(keys), 2 * later):
            more, done = level(keys[k : k + 2 * later], False, True)
            kept_now += more
            upper += done
        if len(kept_now) >= len(kept):
            break
        kept = kept_now
    _, done = level(as_keys(kept), True, True)
    upper += done
    named = {p["node"]: p["conv_id"] for p in upper if p["node"]}
    rows = []
    for p in nodes + upper:
        parent = p["parent_conv_id"] if p["parent"] is None else named[p["parent"]]
        rows.append((p["conv_id"], p["depth"], parent, p["n_convs"], p["n_children"], p["n_leaves"], p["saved_tokens"], p["ends_sha256"] or digests[p["node"]]))
    assert sorted(rows, key=str) == brute(found)


def test_same_rows_as_brute_force(spark):
    rows = many()
    assert rows_of(trie.prefix_trie(conversations(spark, rows))) == brute(sequences(rows))


def test_many_tasks_and_levels(spark, monkeypatch):
    monkeypatch.setattr(trie, "CONVERSATIONS", 20)
    monkeypatch.setattr(trie, "KEYS", 8)
    rows = many()
    assert rows_of(trie.prefix_trie(conversations(spark, rows))) == brute(sequences(rows))


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(catalog.op13_union_find_lcp(spark, SMALL)) == brute(sequences(rows))


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")]])
def test_no_conversations(spark, rows):
    assert trie.prefix_trie(conversations(spark, rows)).isEmpty()
