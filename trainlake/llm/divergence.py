r"""Divergence of the sources of each language, from exact term counts.

Identical texts of a language are collapsed first: a digest of each text is counted by source, and the text itself travels once for each task that holds a
copy. What is left is one row for each different text with the number of its copies in each source, so it is tokenized once
and its counts are multiplied.

Between two sources a term adds floor((p-q)^2 / (p+q)), with p and q its smoothed shares in them. Most terms are missing from both,
where the share is the same for all terms, so the sum is split into four parts:

    V * z  +  sum over terms of a (f(p, b0) - z)  +  sum over terms of b (f(a0, q) - z)  +  sum over terms of both (f(p, q) - f(p, b0) - f(a0, q) + z)

with a0, b0 the shares of a missing term and z = f(a0, b0). The second and third depend on a source's counts only
through how many terms have each count. Only the last looks at terms of both sources.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.session import materialise

#: Shares are counted in parts of this.
SCALE = 1_000_000_000
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
#: Term counts a task holds before it hands them on.
HELD = 400_000
#: Documents are counted in multiples of this, in one number with occurrences, of which a task holds fewer.
DOCUMENT = 1 << 44
#: Pairs of sources that are worked on at once.
PAIRS = 1 << 18
#: Sources of one square of pairs, and squares a task holds (2 MB each) before it hands them on.
SQUARE, SQUARES = 512, 32

#: Fixed by the contract: a term is a run of letters A-Z, a-z and of anything beyond ASCII; only A-Z are lower-cased.
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_TABLE).split()


def collapse(docs: DataFrame) -> DataFrame:
    """lang, text, copies (array of source and n): one row for each different text of a language.

    NULL lang, source and text are empty. Copies are combined in each task before the shuffle, so a text that makes up a third of
    all rows is one row of each task.
    """
    clean = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    keyed = clean.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = keyed.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None)
    both = keyed.select("lang", "digest", "text", none.cast("string").alias("source"), none.cast("long").alias("n")).unionByName(
        copies.select("lang", "digest", none.cast("string").alias("text"), "source", "n")
    )
    copy = F.when(F.col("n").isNotNull(), F.struct("source", "n"))
    return both.groupBy("lang", "digest").agg(F.first("text", ignorenulls=True).alias("text"), F.collect_list(copy).alias("copies")).drop("digest")


def _count(batches):
    """Occurrences and documents of each term by source, one row for a term of a language.

    Texts are taken apart once, whatever their copies. Both numbers are held in one: documents above DOCUMENT.
    """
    counts: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
    held = 0

    def rows():
        by_term: dict[tuple[str, bytes], list] = defaultdict(list)
        for (lang, source), found in counts.items():
            for term, both in found.items():
                by_term[lang, term].append((source, both % DOCUMENT, both // DOCUMENT))
        flat = [one for many in by_term.values() for one in many]
        ends = np.cumsum([0, *map(len, by_term.values())])
        structs = pa.StructArray.from_arrays([pa.array([one[k] for one in flat], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))], ["source", "n", "docs"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
        keys = [pa.array([key[k] for key in by_term], kind) for k, kind in enumerate((pa.string(), pa.binary()))]
        return pa.RecordBatch.from_arrays([*keys, lists], names=["lang", "term", "held"])

    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lang, text, copies in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist(), strict=True):
            found = Counter(terms(text.as_py()))
            for copy in copies:
                into, n = counts[lang, copy["source"]], copy["n"]
                held -= len(into)
                for term, times in found.items():
                    into[term] = into.get(term, 0) + n * (times + DOCUMENT)
                held += len(into)
                if held >= HELD:
                    yield rows()
                    counts.clear()
                    held = 0
    yield rows()


def kept_terms(collapsed: DataFrame, least_documents: int) -> DataFrame:
    """lang, term, total, sources (array of source and n) of the terms in enough documents of their language.

    Partial counts are shuffled once, by term; both sums, by source and over sources, are made where they arrive.
    """
    partial = collapsed.mapInArrow(_count, "lang string, term binary, held array<struct<source:string,n:long,docs:long>>")
    by_source = partial.repartition("lang", "term").select("lang", "term", F.inline("held")).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return by_term.filter(F.col("docs") >= least_documents).select("lang", F.col("term").cast("string").alias("term"), "total", "sources")


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exact beyond 64 bits; NULL where no term is kept."""
    wide = "cast({} as decimal(20,0))".format
    share = F.expr(f"({wide(n)} + 2) * {SCALE} div ({wide(total)} + 2 * {wide(kept)}) + 1")
    return F.when(F.col(kept) > 0, share)


def _gap(p: str, q: str) -> Column:
    """floor((p-q)^2 / (p+q)); shares are at most SCALE + 1, so the square fits 64 bits."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _pairs(size: int):
    """Pairs of positions below size, the first the smaller, some rows of the triangle at a time."""
    rows = max(1, PAIRS // size)
    for k in range(0, size - 1, rows):
        first, second = np.nonzero(np.arange(k, min(k + rows, size - 1))[:, None] < np.arange(size)[None, :])
        yield first + k, second


def _common(batches):
    """What terms of two sources add beyond the parts of each: lang, a, b (positions, a < b), value.

    Each row is a term with its sources in order. Terms of a batch with the same number of sources are taken together, all their pairs at
    once. Sums are kept in squares of sources and handed on when a task holds too many.
    """
    squares: dict[tuple[str, int, int], np.ndarray] = {}
    names = ["lang", "a", "b", "value"]

    def rows():
        for (lang, x, y), sums in squares.items():
            a, b = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(x * SQUARE + a), pa.array(y * SQUARE + b), pa.array(sums[a, b])], names=names)
        squares.clear()

    def add(lang, a, b, value):
        square = a // SQUARE * (1 << 32) + b // SQUARE
        for key in np.unique(square).tolist():
            x, y = divmod(key, 1 << 32)
            here = square == key
            if (lang, x, y) not in squares:
                if len(squares) >= SQUARES:
                    yield from rows()
                squares[lang, x, y] = np.zeros((SQUARE, SQUARE), np.int64)
            np.add.at(squares[lang, x, y], (a[here] % SQUARE, b[here] % SQUARE), value[here])

    for batch in batches:
        langs, lists = np.array(batch.column(0).to_pylist(), object), batch.column(1)
        offsets = lists.offsets.to_numpy()
        fields = lists.values
        at, p, base = (fields.field(c).to_numpy(zero_copy_only=False) for c in ("at", "p", "base"))
        sizes = np.diff(offsets)
        for lang in dict.fromkeys(langs):
            for size in np.unique(sizes[langs == lang]).tolist():
                starts = offsets[:-1][(langs == lang) & (sizes == size)]
                for first, second in _pairs(size):
                    wide = max(1, PAIRS // len(first))
                    for k in range(0, len(starts), wide):
                        left, right = ((starts[k : k + wide, None] + side[None, :]).ravel() for side in (first, second))
                        px, py, bx, by = p[left], p[right], base[left], base[right]
                        yield from add(lang, at[left], at[right], _gaps(px, py) - _gaps(px, by) - _gaps(bx, py) + _gaps(bx, by))
    yield from rows()
    yield pa.RecordBatch.from_arrays([pa.array([], kind) for kind in (pa.string(), pa.int64(), pa.int64(), pa.int64())], names=names)


def _ranked(found: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return found.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of a language are from each other, and their own terms.

    docs needs text, lang and source, NULL being empty; other columns are not looked at, and repeated rows are documents of
    their own. Part ``pair`` has every other source of the language, part ``term`` the ``top`` terms that the source has more
    often than its language. A language without a term in ``least_documents`` documents has pairs of value 0 and no terms.
    Ties are ordered by item. An empty table gives no rows.
    """
    kept = materialise(kept_terms(collapse(docs), least_documents), "kept-terms")
    sparse = kept.select("lang", "term", "total", F.inline("sources"))
    # One row for each language, and one for each source of a language: as many as the answer has groups.
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_total"))
    totals = sparse.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    zero = F.lit(0).cast("long")
    groups = named.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").select(
        "lang", "source", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("at"),
        *(F.coalesce(c, zero).alias(c) for c in ("kept", "lang_total", "source_total")),
    )
    groups = materialise(groups.withColumn("missing", zero).withColumn("base", _share("missing", "source_total", "kept")).drop("missing"), "groups")
    shares = materialise(
        sparse.join(groups, ["lang", "source"]).select(
            "lang", "source", "at", "term", "n", "base", _share("n", "source_total", "kept").alias("p"), _share("total", "lang_total", "kept").alias("q")
        ), "shares",
    )

    others = groups.select("lang", F.col("at").alias("b"), F.col("base").alias("other"), F.col("source").alias("item"))
    alike = shares.groupBy("lang", F.col("at").alias("a"), "base", "p").agg(F.count(F.lit(1)).alias("terms"))
    single = alike.join(others, "lang").filter("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.col("terms") * (_gap("p", "other") - _gap("base", "other"))).alias("value")
    )
    held = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("at", "p", "base"))).alias("held"))
    common = held.filter(F.size("held") > 1).select("lang", "held").mapInArrow(_common, "lang string, a long, b long, value long")
    one_way = single.unionByName(common)
    swapped = one_way.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    added = one_way.unionByName(swapped).groupBy("lang", "a", "b").agg(F.sum("value").alias("added"))
    pairs = groups.select("lang", "source", F.col("at").alias("a"), "base", "kept").join(others, "lang").filter("a <> b")
    pairs = pairs.join(added, ["lang", "a", "b"], "left").withColumn("absent", F.col("kept") * _gap("base", "other"))
    pair = pairs.withColumn("value", F.coalesce("absent", zero) + F.coalesce("added", zero))
    term = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), _gap("p", "q").alias("value"))
    return _ranked(pair, "pair").unionByName(_ranked(term, "term").filter(F.col("rank") <= top))
