import itertools
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tests.compare import connect, differences
from tests.llm.rows import edge_rows, no_rows
from trainlake.llm import catalog, divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = "Alpha beta GAMMA délta ÉPSILON ßeta 語 x’y a-b c_d 1st".split()
ROWS = [(f"{WORDS[i % 11]} {WORDS[i * 7 % 11]} {WORDS[i * i % 5]}", ("en", "fr", None)[i % 3], f"s{i % 4}") for i in range(200)]
ROWS += [("copied text of copied words", "en", s) for s in ("s1", "s2", "s9") for _ in range(30)] + [("copied text of copied words", "fr", None)] * 11
ROWS += [(None, "en", "silent"), ("", "de", "s1"), ("few", "de", "s2"), ("123 \n\t", "xx", None), (None, None, None), ("word " * 20_000, "en", "s1")]


def brute(rows, least=10, top=10):
    """All terms of all groups, one by one."""
    docs = [(t or "", lang or "", s or "") for t, lang, s in rows]
    found, seen, groups = defaultdict(Counter), defaultdict(Counter), {(lang, s) for _, lang, s in docs}
    for text, lang, source in docs:
        words = TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        found[lang, source].update(words)
        seen[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        sources = [s for at, s in groups if at == lang]

        def shares(counts, kept=kept):
            whole = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // whole for t in kept}

        p, q = shares(found[lang, source]), shares(sum((found[lang, s] for s in sources), Counter()))
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = []
        for other in sources:
            if other != source:
                theirs = shares(found[lang, other])
                pairs.append((sum(gap(p[t], theirs[t]) for t in kept), other))
        own = [(gap(p[t], q[t]), t) for t in kept if found[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, math.inf), ("term", own, top)):
            for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                if rank <= most:
                    out.append((lang, source, part, item, value, rank))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


def docs(spark, rows):
    schema = "text string, lang string, source string, term string, n string, copies string, p string, base string, held string"
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], schema)


def test_terms_are_runs_of_letters():
    text = "".join(map(chr, range(0x250))) + " ÀÉ Z z 語x\x7fy ½²"
    assert [t.decode() for t in divergence.terms(text.encode())] == TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


@pytest.mark.parametrize("least", [1, 10, 10_000])
def test_same_rows_as_brute_force(spark, least):
    assert rows_of(divergence.divergence(docs(spark, ROWS), least)) == brute(ROWS, least)


def test_more_than_one_square_of_sources(monkeypatch):
    monkeypatch.setattr(divergence, "SQUARE", 3)
    monkeypatch.setattr(divergence, "SQUARES", 2)
    monkeypatch.setattr(divergence, "PAIRS", 7)
    held = [[{"at": k, "p": 100 + 7 * k * t, "base": 3 + k} for k in range(17) if (k * t) % 5 < 3] for t in range(1, 40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(held)), pa.array(held)], names=["lang", "held"])
    found, expected = Counter(), Counter()
    for out in divergence._common([batch, batch]):
        for row in out.to_pylist():
            assert row["a"] < row["b"]
            found[row["a"], row["b"]] += row["value"]
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    for term in held * 2:
        for a, b in itertools.combinations(term, 2):
            expected[a["at"], b["at"]] += gap(a["p"], b["p"]) - gap(a["p"], b["base"]) - gap(a["base"], b["p"]) + gap(a["base"], b["base"])
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in expected.items() if v}


def test_counts_are_handed_on_when_too_many_are_held(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    rows = [("en", "a b A", [{"source": "x", "n": 2}, {"source": "y", "n": 1}]), ("en", "b c d e", [{"source": "x", "n": 5}])]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["lang", "text", "copies"])
    outs = list(divergence._count([batch]))
    found, docs = Counter(), Counter()
    for out in outs:
        for r in out.to_pylist():
            for held in r["held"]:
                found[held["source"], r["term"]] += held["n"]
                docs[held["source"], r["term"]] += held["docs"]
    assert len(outs) > 1 and found == {("x", b"a"): 4, ("x", b"b"): 7, ("y", b"a"): 2, ("y", b"b"): 1, ("x", b"c"): 5, ("x", b"d"): 5, ("x", b"e"): 5}
    assert docs == {("x", b"a"): 2, ("x", b"b"): 7, ("y", b"a"): 1, ("y", b"b"): 1, ("x", b"c"): 5, ("x", b"d"): 5, ("x", b"e"): 5}


def test_texts_are_collapsed_with_their_copies(spark):
    found = {(r.lang, r.text): {c.source: c.n for c in r.copies} for r in divergence.collapse(docs(spark, ROWS)).collect()}
    assert found["en", "copied text of copied words"] == {"s1": 30, "s2": 30, "s9": 30}
    assert len(found) == len({(lang or "", t or "") for t, lang, _ in ROWS})
    assert sum(n for copies in found.values() for n in copies.values()) == len(ROWS)


def test_sql_and_query_on_odd_rows(spark, tmp_path):
    docs(spark, ROWS).select("text", "lang", "source").coalesce(1).write.parquet(str(tmp_path / "out"))
    next((tmp_path / "out").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    name = "op12_duplicate_text_collapse"
    assert differences(connect(str(tmp_path)), catalog.QUERIES[name](spark, str(tmp_path)), catalog.ORACLES[name]) == ""


def test_edge_rows(spark):
    odd = edge_rows(spark).selectExpr("*", "CASE WHEN doc_id = 4 THEN 'web' END AS source")
    assert rows_of(divergence.divergence(odd, 1)) == brute([(r.text, r.lang, r.source) for r in odd.collect()], 1)
    assert divergence.divergence(no_rows(spark).selectExpr("*", "text AS source")).isEmpty()
