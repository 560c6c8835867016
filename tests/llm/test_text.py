import collections
import re
import string
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.rows import LONG, edge_rows, no_rows
from trainlake.llm import catalog, decontaminate, html, jaccard, language, licenses, pii, toxicity
from trainlake.llm.components import components
from trainlake.session import materialise, small_batches

LARGER = "/root/testdata/sf0.1"


# toxicity

def test_toxicity_on_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = [r for r in catalog.op3_compression_distance(spark, LARGER).collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    bad, good = ([r.score for r in rows if labels[r.doc_id] == y] for y in (1, 0))
    assert sum(b > g for b in bad for g in good) > 0.9 * len(bad) * len(good)


def test_toxicity_edge_rows(spark):
    model = toxicity.train(["you awful fool", "nice day today"] * 20, [True, False] * 20)
    scored = toxicity.score(edge_rows(spark), model)
    assert scored.columns[-1] == "score_" and scored.count() == 9
    low = {r.score_ for r in scored.filter("coalesce(trim(text), '') = ''").collect()}
    assert len(low) == 1 and low.pop() < 0.01
    assert toxicity.score(no_rows(spark), model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(edge_rows(spark), labels, toxicity.may_learn(F.col("doc_id"))) is None
    assert {r[0] for r in toxicity.score(edge_rows(spark), None).select("score_").collect()} == {0.0}


# language

def test_language_on_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in catalog.op9_output_codes(spark, LARGER).collect() if r.held_out]
    assert rows and sum(langs[r.doc_id] == r.lang_pred for r in rows) > 0.97 * len(rows)


def test_language_edge_rows(spark):
    model = language.train(["the cat and the dog"] * 3 + ["der hund und die katze"] * 3, ["en"] * 3 + ["de"] * 3)
    found = {(r.doc_id, r.lang_pred) for r in language.identify(edge_rows(spark, [(7, "the dog")]), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (6, "und"), (7, "en")} <= found
    marks = language.identify(edge_rows(spark, [(21, "½ ² ①② Ⅷ _ 7"), (22, "① a dog")]), model).filter("doc_id > 20")
    assert {(r.doc_id, r.lang_pred == "und") for r in marks.collect()} == {(21, True), (22, False)}
    assert language.identify(no_rows(spark), model).count() == 0
    nothing = language.fit(edge_rows(spark), language.may_learn(F.col("doc_id")))
    assert {r.lang_pred for r in language.identify(edge_rows(spark), nothing).collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 4, 6, 7, 30])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(r) for r in code}) == n and min(abs(r.sum()) for r in code.T) < n


# n-gram Jaccard join

def brute_components(rows, words, percent):
    sets = {}
    for key, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[key] = frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()
    holders = collections.defaultdict(list)
    for key, s in sets.items():
        for g in s:
            holders[g].append(key)
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for key, s in sets.items():
        for other, shared in collections.Counter(o for g in s for o in holders[g] if o < key).items():
            if 100 * shared >= percent * (len(s) + len(sets[other]) - shared):
                a, b = sorted((top(key), top(other)))
                root[b] = a
    return {k: (len(s), top(k)) for k, s in sets.items()}


def test_jaccard_query_is_exact(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in catalog.op8_adaptive_prefix(spark, SMALL).collect()}
    assert found == brute_components([(r.doc_id, r.text) for r in docs.collect()], 4, 85)


def test_jaccard_lists_hold_only_sets_with_one_of_a_near_size(spark):
    lists = {1: [100, 84], 2: [100, 85], 3: [50, 100, 110, 300], 4: [7], 5: [20, 20]}
    rows = [(gram, 10 * gram + k, n, 1) for gram, sizes in lists.items() for k, n in enumerate(sizes)]
    found = jaccard._postings(spark.createDataFrame(rows + rows[2:4], "gram long, cls long, n int, least int"), 85).collect()
    assert sorted((r.gram, r.n) for r in found) == [(2, 85), (2, 100), (3, 100), (3, 110), (5, 20), (5, 20)]


def test_jaccard_counts_ngrams_without_several_copies_of_them():
    rng = np.random.default_rng(1)
    held = [np.unique(rng.integers(0, 2**64 - 1, 5_000, np.uint64)) for _ in range(100)]
    held = [np.append(grams, np.arange(k, dtype=np.uint64)) for k, grams in enumerate(held)]
    known = collections.Counter(np.concatenate(held).tolist())
    size = sum(grams.nbytes for grams in held)
    tracemalloc.start()
    found, seen = jaccard._seen_often(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert dict(zip(found.tolist(), seen.tolist(), strict=True)) == {gram: n for gram, n in known.items() if n >= jaccard.SEEN}
    assert peak < 1.5 * size and not held


@pytest.mark.parametrize("few", range(1, 6))
def test_jaccard_counts_a_few_ngrams(few):
    found, seen = jaccard._seen_often([np.array([7], np.uint64)] * few)
    assert (found.tolist(), seen.tolist()) == (([7], [few]) if few >= jaccard.SEEN else ([], []))


def test_jaccard_gets_few_texts_at_a_time(spark, monkeypatch):
    sizes = []

    def written(df, label):
        sizes.append((label, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
        return materialise(df, label)

    monkeypatch.setattr(jaccard, "materialise", written)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    jaccard.near_duplicates(spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string"), 4, 85).count()
    assert {label: size for label, size in sizes if label in ("ngram-rows", "prefixes", "sets")} == {"ngram-rows": 256, "prefixes": 256, "sets": 256}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_small_batches_reach_python(spark):
    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    with small_batches(spark, 100):
        assert {r.n for r in spark.range(0, 1000, 1, 2).mapInArrow(rows, "n long").collect()} == {100}


def test_jaccard_large_group_of_near_copies(spark):
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(300):
        text = list(base)
        for at in ((7 * k) % 60, (11 * k + 3) % 60):
            text[at] = f"x{k}"
        rows.append((k, " ".join(text)))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert found == brute_components(rows, 4, 85)


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_jaccard_text_of_exactly_so_many_words(spark, words, percent):
    texts = [f"{' '.join([w] * n)}" for w in "ab" for n in range(1, words + 3)] + ["", "a b a b", "a b a b a b"]
    rows = list(enumerate(texts))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words, percent).collect()}
    assert found == brute_components(rows, words, percent)


def test_jaccard_rows_with_one_number_or_none(spark):
    base = " ".join(f"w{k}" for k in range(60))
    texts = [base, base, base + " end", "other " * 9, base.upper(), " ".join(f"v{k}" for k in range(30))]
    rows = [(i, t) for t in texts for i in (None, 7, None)] + [(9, base + " fin")]
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert found == {(None, 57, 7), (7, 57, 7), (None, 58, 7), (7, 58, 7), (9, 58, 7), (None, 1, 7), (7, 1, 7), (None, 27, 7), (7, 27, 7)}


def test_jaccard_edge_rows(spark):
    rows = jaccard.near_duplicates(edge_rows(spark)).collect()
    assert len(rows) == 9
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in rows if r.doc_id == 4) == [(4, 4, 1)] * 2
    assert (None, 4, 1) in [tuple(r[k] for k in ("doc_id", "component_id", "n_shingles")) for r in rows]
    assert {(r.doc_id, r.component_id) for r in rows if not r.n_shingles} == {(1, 1), (2, 2), (3, 3), (None, None)}
    assert jaccard.near_duplicates(no_rows(spark)).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 85, 95])
def test_jaccard_similar_sets_share_as_many_blocks_as_asked(percent):
    rng = np.random.default_rng(percent)
    levels = rng.integers(0, 6, 1 << jaccard.LEVEL_BITS, np.uint8)
    met = 0
    for n in [*range(2, 40), 47, 48, 100, 161, 700, 3_000]:
        for _ in range(12):
            x = rng.integers(0, 2**64 - 1, n, np.uint64)
            drop = rng.integers(0, n * (100 - percent) // 100 + 1)
            new = rng.integers(0, 2**64 - 1, rng.integers(0, drop // 2 + 1), np.uint64)
            x, y = np.unique(x), np.unique(np.append(x[drop:], new))
            shared = len(np.intersect1d(x, y))
            if len(y) and shared < len(x) + len(y) - shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                a, b = (list(jaccard.prefixes(s, levels, percent)) for s in (x, y))
                common = sum(len(np.intersect1d(p, q)) for p, _ in a for q, _ in b)
                assert common >= min(least for _, least in a + b)
                met += 1
    assert met > 100


def test_jaccard_sets_in_one_block_meet_by_ngrams():
    levels = np.zeros(1 << jaccard.LEVEL_BITS, np.uint8)
    x = np.arange(100, dtype=np.uint64)  # all in the first part of the hashes
    a, b = (np.concatenate([keys for keys, _ in jaccard.prefixes(s, levels, 85)]) for s in (x, x[5:]))
    assert len(np.intersect1d(a, b))


def test_jaccard_postings_leave_out_sets_that_share_ngrams_by_chance(spark):
    rng = np.random.default_rng(3)
    some = rng.integers(0, 2**64 - 1, 3_000, np.uint64)
    levels = np.zeros(1 << jaccard.LEVEL_BITS, np.uint8)
    rows = []
    for k in range(100):  # any two share 17 of 500 n-grams or so, and no more than that
        grams = np.unique(np.append(rng.choice(some, 225, replace=False), rng.integers(0, 2**64 - 1, 275, np.uint64)))
        rows += [(g, k, len(grams), least) for keys, least in jaccard.prefixes(grams, levels, 85) for g in keys.view(np.int64).tolist()]
    found = jaccard._postings(spark.createDataFrame(rows, "gram long, cls long, n int, least int"), 85)
    assert found.count() < 0.02 * len(rows)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (102, 102), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100}


# decontamination

def test_decontamination_finds_whole_items(spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    known = {r.item_id: decontaminate.words(r.text) for r in items.collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    expected = {(d.doc_id, i) for d in docs for i, w in known.items() if " ".join(w) in " ".join(decontaminate.words(d.text))}
    found = {(r.doc_id, r.item_id) for r in catalog.op7_block_max_wand(spark, SMALL).collect()}
    assert expected and found == expected


def test_wand_finds_all_above_the_threshold(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    counts = collections.Counter(w for _, t in items for w in set(decontaminate.words(t)))
    index = decontaminate.Index.build(items, counts, len(items), 30.0)
    for k in range(len(items) - 1):
        query = {w for w in decontaminate.words(items[k][1])[::2] + decontaminate.words(items[k + 1][1])[::3] if w in index.postings}
        share = collections.Counter()
        for w in query:
            for at, value in zip(*index.postings[w][:2], strict=True):
                share[at] += value
        for least in (0.05, 0.3, 0.6):
            wanted = {i for i, s in share.items() if s >= least - 1e-9}
            assert {i for i, _ in index.search(query, least)} == wanted
            numbers = np.array(sorted(index.numbers[w] for w in query), np.int64)
            blocks = index.open_blocks(np.zeros(len(numbers), np.int64), numbers, least)
            assert {i for _, b in blocks for i, _ in index.search(query, least, b)} == wanted


def test_decontamination_edge_rows(spark):
    items = spark.createDataFrame([(1, "what is the answer? it is forty two"), (1, "what is the answer? it is forty two"), (2, None), (3, ""), (None, "a rare phrase nobody writes")], "item_id long, text string")
    docs = edge_rows(spark, [(7, f"{LONG} WHAT is the answer? It is forty-two {LONG}"), (8, "what is the answer? nobody knows"), (9, "a rare phrase nobody writes")])
    found = decontaminate.find_leaks(docs, items)
    assert found.columns[-1] == "leaks__"
    assert {(r.doc_id, tuple(x.item_id for x in r.leaks__)) for r in found.filter("size(leaks__) > 0").collect()} == {(7, (1,)), (9, (None,))}
    assert decontaminate.find_leaks(docs, items.limit(0)).filter("size(leaks__) > 0").count() == 0
    assert decontaminate.find_leaks(no_rows(spark), items).count() == 0


# licences

def test_licenses_like_brute_force(spark):
    plain = lambda t: f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()
    expected = {(d.doc_id, k) for d in docs for k, t in licenses.TEMPLATES.items() if plain(t) in plain(d.text)}
    found = {(r.doc_id, r.license) for r in catalog.op5_license_windows(spark, LARGER).collect()}
    assert expected and found == expected


def test_licenses_edge_rows(spark):
    docs = edge_rows(spark, [(7, LONG + "released UNDER the\nMIT license!" + LONG), (8, "Released under the license.")])
    assert [(r.doc_id, r.license, r.containment) for r in licenses.scan(docs).collect()] == [(7, "mit", 1.0)]
    assert licenses.scan(no_rows(spark)).count() == 0 and licenses.scan(docs, {}).count() == 0


# surrogates

def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits)))


def test_surrogates_hide_entities_and_keep_the_rest(spark):
    forms = "|".join((r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", r"\b\d{1,3}(?:\.\d{1,3}){3}\b", r"\b[3-6]\d{15}\b", r"\(\d{3}\) \d{3}-\d{4}", r"[0-9a-f]{18,40}"))
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    pairs = set()
    for r in catalog.op1_surrogates(spark, SMALL).collect():
        old, new = re.findall(forms, before[r.doc_id]), re.findall(forms, r.text)
        assert re.split(forms, before[r.doc_id]) == re.split(forms, r.text)
        pairs |= set(zip(old, new, strict=True))
    assert pairs and len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
    # Sixteen digits without a valid check digit are no card number.
    kept = {a for a, b in pairs if a == b}
    assert kept == {a for a, _ in pairs if re.fullmatch(r"\d{16}", a) and luhn(a) % 10}
    assert not ({a for a, _ in pairs} - kept) & {b for _, b in pairs}


def test_surrogates_of_names_secrets_and_formats(spark):
    text = "Mrs. Anna Smith met Mr. Paul Smith; MRS. x; Frau Smith; Госпожа Анна Иванова. Call +1 (917) 555-2670 or 917-555-2670. PIN Password: hunter2hunter2, a@b.co A@B.CO 4111 1111 1111 1111"
    out = pii.replace(edge_rows(spark, [(7, text)]), "k").filter("doc_id = 7").first()
    assert out["n_replaced_"] == 10
    a, b = (m.split() for m in re.findall(r"M(?:rs|r)\. (\w+ \w+)", out.text))
    assert a[1] == b[1] == re.search(r"Frau (\w+)", out.text)[1] and a[0].endswith("na") and b[0].endswith("n") and not b[0].endswith("na")
    assert re.search(r"Госпожа [А-Я][а-я]+на [А-Я][а-я]+", out.text) and "hunter2" not in out.text
    one, two = re.search(r"\+1 \((\d{3})\) (\d{3}-\d{4}) or (\d{3}-\d{3}-\d{4})", out.text).group(2, 3)
    assert two.endswith(one)
    low, up = re.findall(r"\S+@\S+", out.text)
    assert up == low.upper() and low != "a@b.co"
    card = re.search(r"(4\d{3}(?: \d{4}){3})$", out.text)[1].replace(" ", "")
    assert luhn(card) % 10 == 0


def test_surrogates_stay_distinct_where_the_format_is_narrow(spark):
    rows = [(k, f"mail {a}@x.co now") for k, a in enumerate("abcdefghijklmno")]
    out = pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    made = {r.text.split()[1] for r in out}
    assert len(made) == 15 and not made & {f"{a}@x.co" for a in "abcdefghijklmno"}


def mails(spark, texts):
    return [r.text for r in pii.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()]


def test_surrogates_of_a_full_format_are_longer(spark):
    old = [f"{a}@{b}.co" for a in string.ascii_lowercase for b in string.ascii_lowercase]
    new = mails(spark, old)
    assert len(set(new)) == 676 and not set(new) & set(old) and all(re.fullmatch(r"[a-z]+@[a-z]\.co", x) for x in new)


def test_surrogates_of_many_family_names_are_distinct(spark):
    letters = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(4))
    docs = spark.range(0, 200, 1, 4).select(F.col("id").alias("doc_id"), F.concat_ws("; ", F.array(*(F.concat(F.lit(f"Mr Q{letters(k)}"), F.concat_ws("", *(F.chr(97 + (F.col("id") / 26**i).cast("int") % 26) for i in range(2)))) for k in range(1000)))).alias("text"))
    made = [m for r in pii.replace(docs, "k").collect() for m in r.text.split("; ")]
    assert len(made) == len(set(made)) == 200_000


def test_surrogates_keep_family_names_together_where_they_collide(spark, monkeypatch):
    monkeypatch.setattr(pii, "CONSONANTS", "b")
    monkeypatch.setattr(pii, "VOWELS", "ae")
    words = [f"R{a}{b}" for a in "aeiou" for b in "bcdfghjklmnprstvwxyz"]
    new = [re.fullmatch(r"Mr (\w+); Mrs (\w+) (\w+); MRS\. X", t) for t in mails(spark, [f"Mr {w}; Mrs Ann {w}; MRS. X" for w in words])]
    assert all(m[1] == m[3] for m in new) and len({m[1] for m in new}) == 100 and len({m[2] for m in new}) == 1 and new[0][2].endswith("na")


def test_surrogates_of_numbers_without_room_get_an_extension(spark):
    made = lambda what, entity, turn: spark.range(1).select(pii.render(F.lit(entity), F.lit(what), F.array(pii.surrogate(F.lit(what), F.lit(re.sub(r"\D", "", entity) if what != "ip" else entity), F.lit("s"), turn)))).first()[0]
    assert re.fullmatch(r"\(\d{3}\) \d{3}-\d{4} x\d\d", made("phone", "(917) 555-2670", pii.EXTENDED + 1))
    assert re.fullmatch(r"4\d{3}(?: \d{4}){3} x\d", made("card", "4111 1111 1111 1111", pii.EXTENDED))
    assert re.fullmatch(r"[\d.]+:\d+", made("ip", "10.0.0.1", pii.EXTENDED)) and ":" not in made("ip", "10.0.0.1", pii.EXTENDED - 1)


def test_surrogates_leave_lines_and_numbers_without_check_digit(spark):
    texts = ["token: ------------------", "order 4111 1111 1111 1112 of 917-555-2670", "password: 4111111111111112", "pwd=--abcdef--"]
    a, b, c, d = mails(spark, texts)
    assert a == texts[0] and b.startswith("order 4111 1111 1111 1112 of ") and b != texts[1]
    assert re.fullmatch(r"password: \d{16}", c) and c != texts[2] and re.fullmatch("pwd=--[a-z]{6}--", d) and d != texts[3]


def test_surrogates_edge_rows(spark):
    out = pii.replace(edge_rows(spark), "k")
    assert sorted(map(str, out.select("doc_id", "text").collect())) == sorted(map(str, edge_rows(spark).select("doc_id", "text").collect()))
    assert out.columns[-1] == "n_replaced_" and pii.replace(no_rows(spark), "k").count() == 0


# pages

def test_html_query_like_the_article_element(spark):
    import html as entities

    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in catalog.op6_equivalence_classes(spark, SMALL).collect():
        article = re.search(r"<article>(.*?)</article>", rows[r.page_id], re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1)\b[^>]*>", article.replace("<br>", " "))]
        assert r.text == "\n".join(b for b in (" ".join(entities.unescape(x).split()) for x in blocks) if b) and r.n_chars == len(r.text)


def test_html_template_without_article_elements(spark):
    page = "<html><body><div class='top'><a href=/>home</a></div><div id=menu>a b c</div><div id=x><p>Text &amp; {0}</p><p>more   {0}</p><div class='comments'>me too {0}</div></div><div id=copyright>same line</div></body></html>"
    rows = [(k, f"http://h/{k}", page.format(k)) for k in range(6)] + [(7, None, None), (8, "http://h/8", ""), (9, "x", "<p>alone<script>x('<p>')</script>")]
    out = {r.page_id: r.main_text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3] == "Text & 3\nmore 3" and out[7] == out[8] == "" and out[9] == "alone"
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, pages, host="h"):
    """page -> main text of pages of one host."""
    rows = [(k, f"http://{host}/{k}", p) for k, p in enumerate(pages)]
    return {r.page_id: r.main_text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_html_slots_hold_repeated_and_optional_parts(spark):
    frame = "<html><body><div id=top><a href=/>home</a></div>{}<div id=copyright>same line</div></body></html>"
    wordy = lambda k: f"text of page {k} " * 30
    # Sections: repeated on each page, and on one page only.
    many = [frame.format(f"<article><h1>Head {k}</h1><section><p>One {k}</p></section><section><p>Two {k}</p></section></article>") for k in range(5)]
    assert texts_of(spark, many) == {k: f"Head {k}\nOne {k}\nTwo {k}" for k in range(5)}
    odd = [frame.format(f"<article><h1>Head {k}</h1><section><p>One {k}</p></section>{'<section>Two</section>' * (k == 2)}</article>") for k in range(5)]
    assert texts_of(spark, odd) == {k: f"Head {k}\nOne {k}" + "\nTwo" * (k == 2) for k in range(5)}
    divs = [frame.format(f"<div id=x><h1>Head {k}</h1><div><p>One {k}</p></div><div><p>Two {k}</p></div></div>") for k in range(5)]
    assert texts_of(spark, divs) == {k: f"Head {k}\nOne {k}\nTwo {k}" for k in range(5)}
    # Mixed layouts, the rarer one without a token of its own in the template.
    mixed = [frame.format(f"<article><p>Art {k}</p></article>" if k % 3 == 0 else f"<div id=x><p>Div {k}</p></div>") for k in range(9)]
    assert texts_of(spark, mixed) == {k: f"{'Div' if k % 3 else 'Art'} {k}" for k in range(9)}
    # A title block far below a tenth of the text, and text beside main.
    title = [frame.format(f"<div id=t>Title {k}</div><div id=x><p>{wordy(k)}</p></div>") for k in range(5)]
    assert texts_of(spark, title) == {k: f"Title {k}\n{wordy(k).strip()}" for k in range(5)}
    beside = [frame.format(f"<main><h1>Head {k}</h1></main><div id=x><p>Body {k}</p></div>") for k in range(5)]
    assert texts_of(spark, beside) == {k: f"Head {k}\nBody {k}" for k in range(5)}
    # Pages without containers around their text.
    assert texts_of(spark, [f"<h1>Head {k}</h1><p>Bare {k}" for k in range(5)]) == {k: f"Head {k}\nBare {k}" for k in range(5)}


def test_html_keeps_lists_of_links_and_texts_that_do_not_differ(spark):
    frame = "<html><body><div id=top><a href=/>home</a></div>{}<div id=copyright>same line</div></body></html>"
    refs = [frame.format(f"<article><p>Text {k}</p><section class=refs><a href=/1>one</a> <a href=/2>two</a></section></article>") for k in range(5)]
    assert texts_of(spark, refs) == {k: f"Text {k}\none two" for k in range(5)}
    same = "one article under many dates " * 9
    dated = [frame.format(f"<div class=date>{k} May</div><div class=text><p>{same}</p></div>") for k in range(5)]
    assert texts_of(spark, dated) == {k: f"{k} May\n{same.strip()}" for k in range(5)}
    lead = [frame.format(f"<div id=x><div class=lead>Our daily news</div><p>All about page {k}</p></div>") for k in range(5)]
    assert texts_of(spark, lead) == {k: f"Our daily news\nAll about page {k}" for k in range(5)}
    marked = [frame.format(f"<div id=x><span class=ad>x{k}</span>Text {k}</div><div id=y>More {k}</div><div class=replies>me too {k}</div><div class=gdpr>{k}</div>") for k in range(5)]
    assert texts_of(spark, marked) == {k: f"Text {k}\nMore {k}" for k in range(5)}


def test_html_deep_and_long_pages(spark):
    deep = "<div>" * 100_000 + "<p>deep</p>" + "<div class=comments>x</div>end"
    assert html.main_text(deep, None) == "deep\nend"
    pages = [f"<div id=top>same</div>{deep} {k}" for k in range(3)] + ["<p>" + f"word {LONG} " * 200]
    out = texts_of(spark, pages)
    assert [out[k] for k in range(3)] == [f"deep\nend {k}" for k in range(3)] and out[3] == " ".join(f"word {LONG} ".split() * 200)
    rows = spark.createDataFrame([(k, "http://h/", f"<p>a {k // 2}", "x") for k in range(6)], "page_id long, url string, html string, main_text string")
    repeated = html.extract(rows.unionByName(rows))
    assert repeated.columns[-1] == "main_text_" and sorted(r.main_text_ for r in repeated.collect()) == sorted(f"a {k // 2}" for k in range(6) for _ in "ab")


@pytest.mark.parametrize("body, text", [
    ("<body class='has-sidebar'><p>a", "a"), ("<body class=no-sidebar><p>a", "a"), ("<body class='search-results'><p>a", "a"), ("<body class=search><p>a", "a"),
    ("<body><article class='post comments-open'><p>a</article>", "a"), ("<main class=widget><p>a</main>", "a"),
    ("<article><div class='entry-header'><h1>h</h1></div><p>a</article>", "h\na"), ("<article><div class=article__header><h1>h</h1></div>a</article>", "h\na"),
    ("<article><div class=header><h1>h</h1></div><p>a</article>", "h\na"), ("<div class=entry-header><h1>h</h1></div><p>a", "h\na"), ("<h1 class=header>h</h1><p>a", "h\na"),
    ("<div class='site-header'>x</div><div class=header>x</div><div class=share-buttons>x</div><div id=sidebar_2>x</div><div class='box side-bar'>x</div><p>a", "a"),
    ("<p class=notice>x</p><p>a", "a"), ("<p class=advert>x<p>a", "a"), ("<p class=ad>x<div>a</div>", "a"), ("<div><p class='ad'>x</div>a", "a"),
    ("<ul><li class='ad'>x<ul><li>x</li></ul>x</li><li>a<li class=promo>x<li>b</ul>c", "a\nb\nc"),
    ("<p>a <span class=sponsored>x<span>x</span>x</span>b</p>", "a b"), ("<p>a<span class=ad>x</p><p>b", "a\nb"), ("<span class=ad />a", "a"), ("<p class=no-ad>a", "a"),
])
def test_html_marks_drop_whole_names_only(body, text):
    assert html.main_text(f"<html>{body}", None) == text


# pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
        from trainlake.session import materialise

        docs = materialise(docs, name)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).select("doc_id").distinct().count() == before


def test_pipeline_keeps_one_of_each_group(spark):
    rows = [(k, f"alpha beta gamma delta epsilon zeta {'x' if k == 9 else 'eta'}") for k in (5, 3, 3, 9)] + [(None, "alpha beta gamma delta epsilon zeta eta"), (1, None), (2, ""), (2, "")]
    kept = corpus_pipeline.drop_near_duplicates(spark, edge_rows(spark).limit(0).unionByName(edge_rows(spark, rows).filter("doc_id IN (1, 2, 3, 5, 9) OR text LIKE 'alpha%'").filter("text IS NULL OR text = '' OR text LIKE 'alpha%'")), SMALL)
    assert sorted((r.doc_id, r.text is not None and r.text.startswith("alpha")) for r in kept.collect()) == [(1, False), (1, False), (2, False), (2, False), (2, False), (3, True), (9, True)]


def test_pipeline_edge_rows(spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge_rows(spark), SMALL).columns == edge_rows(spark).columns, name
        assert stage(spark, no_rows(spark), SMALL).count() == 0, name


@given(st.lists(st.integers(0, 2**64 - 1), unique=True), st.lists(st.integers(0, 2**64 - 1), unique=True), st.lists(st.integers(0, 2**64 - 1), unique=True))
def test_sketches_differ_no_more_than_their_sets(shared, left, right):
    x, y = (np.unique(np.array(shared + own, np.uint64)) for own in (left, right))
    bits = np.bitwise_count((jaccard.sketch(x) ^ jaccard.sketch(y)).view(np.uint64)).sum()
    assert bits <= len(np.setxor1d(x, y))
