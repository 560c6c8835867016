"""Jaccard join of word n-grams with adaptive multi-match prefixes.

Texts are sets of n-gram hashes (64 bits); texts with one set are a class, and only classes
are compared. Single n-grams are shared by chance, the more often the more texts there are. So a
set is cut into blocks, the n-grams of one range of hashes each, in ranges that are the same for
all sets of about a size. Sets that differ in d n-grams differ in d blocks at most, and a block is hardly shared
by chance. The blocks of a set are ordered from rare to frequent. If two sets reach the
similarity, their prefixes of length d + l share l blocks at least, for any l. Each
set takes the l for which the estimated cost is least: the frequencies of its prefix, and
the candidates to verify, which must share the smaller l of both. So a set whose prefix reaches into frequent
blocks asks for more matches instead of more candidates. A set with fewer than d + 1 blocks has all of them in its
prefix, and besides n-grams in the same way, for others like it.

Groups of very many alike texts are not compared pair by pair: rounds of stars come first, in
which each set of a posting list is compared with one of them, chosen anew for each list and round. Only
sets that are not in one component by then meet in pairs, so no link between components is lost.
Pairs whose sketches already differ too much for the similarity leave within the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.llm.components import components
from trainlake.session import discard, materialise, small_batches

#: The levels of frequency are kept by this many buckets of hashes: 4 MB for any input.
LEVEL_BITS = 22
#: Parts in which the driver fetches them, a job each.
LEVEL_PARTS = 4
#: A task reports blocks that it saw in so many texts; rarer ones count as rare everywhere.
SEEN = 4
#: Blocks whose frequency a task counts at a time, and texts it takes apart at a time.
HELD_GRAMS, ROWS = 2_000_000, 256
#: Classes that a task remembers, so that copies near each other count once.
HELD_CLASSES = 10_000
#: Classes, each a number or two, that may be sent to all tasks.
BROADCAST_ROWS = 1_000_000
LONGEST_MATCH = 4
VERIFY_COST = 8
STAR_ROUNDS = 6
#: A sketch has so many longs; each bit is the parity of the n-grams of one bucket of hashes.
SKETCH = 16


def ngrams(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all n-grams; the whole sequence as one if there are fewer words."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    each = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)
    return np.unique(_joined(each, words))


def _joined(each: np.ndarray, words: int) -> np.ndarray:
    """A hash of each window of word hashes."""
    h = np.full(len(each) - words + 1, 0x9E3779B97F4A7C15, np.uint64)
    for k in range(words):
        h = (h ^ each[k : len(each) - words + 1 + k]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def sketch(grams: np.ndarray) -> np.ndarray:
    """Parities of the n-grams by bucket, as SKETCH longs; two sketches differ in no more bits than their sets in n-grams."""
    bits = np.bincount((grams % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def _differ(n: int, other: int, percent: int) -> int:
    """The most n-grams that are in only one of two sets of these sizes, if they are as similar as asked."""
    return (100 - percent) * (n + other) // (100 + percent)


def size_classes(n: int, percent: int) -> Iterator[tuple[int, int, int]]:
    """The size classes in which a set of n meets others: their number, the parts of their hashes, and the most n-grams in which n's set differs there.

    Two sets meet in the class of the larger one. Classes in which only equal sets are similar enough are left out.
    """
    low, k = 1, 0
    while 100 * n >= percent * low:
        high = max(low + 1, low * 3 // 2)
        differ = _differ(n, min(high - 1, 100 * n // percent), percent)
        if n < high and differ:
            yield k, 3 * _differ(high - 1, high - 1, percent) // 2 + 2, differ
        low, k = high, k + 1


def blocks(grams: np.ndarray, size_class: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A key and the number of n-grams of each block: the n-grams (sorted) of each part of the hashes that has any."""
    part = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    place = part[starts] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(size_class + 1)
    return _mixed(np.add.reduceat(_mixed(grams), starts) ^ _mixed(place)), np.diff(np.append(starts, len(grams)))


def _class_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def _seen_often(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What is in at least SEEN of the sets, and in how many. held is emptied, so that what it has is in memory only once."""
    grams = np.concatenate(held)
    held.clear()
    grams.sort()
    often = np.unique(grams[SEEN - 1 :][grams[SEEN - 1 :] == grams[: -(SEEN - 1)]])
    return often, np.searchsorted(grams, often, "right") - np.searchsorted(grams, often, "left")


def _rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Two kinds of rows: row, digest, n and cls of each text; gram and seen of blocks often met in a task."""
    names = ("row", "digest", "n", "cls", "gram", "seen")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def batch(columns: list) -> pa.RecordBatch:
        size = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays([pa.nulls(size, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], schema=schema)

    def shingle(batches):
        held, size, classes = [], 0, set()

        def often():
            grams, seen = _seen_often(held)
            return batch([None, None, None, None, grams.view(np.int64), seen])

        for b in batches:
            rows, ns, keys = [], [], []
            if len(classes) > HELD_CLASSES:
                classes.clear()
            for row, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                grams = ngrams(text.as_py(), words)
                key = _class_of(grams)
                rows.append(row), ns.append(len(grams)), keys.append(key if len(grams) else None)
                if len(grams) and key not in classes:
                    classes.add(key)
                    for size_class, parts, _ in size_classes(len(grams), percent):
                        held.append(blocks(grams, size_class, parts)[0])
                        size += len(held[-1])
                    if size > HELD_GRAMS:
                        yield often()
                        size = 0
            if rows:
                yield batch([rows, b.column(2).to_pylist(), ns, keys, None, None])
        if held:
            yield often()

    return docs.mapInArrow(shingle, ", ".join(f"{c} long" for c in names))


def _levels(rows: DataFrame) -> np.ndarray:
    """The logarithm of the frequency for each bucket of blocks; a table of fixed size."""
    total = rows.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("seen").alias("seen"))
    bucket = F.col("gram").bitwiseAND((1 << LEVEL_BITS) - 1)
    levels = total.groupBy(bucket.cast("int").alias("bucket")).agg(F.max(F.floor(F.log2("seen"))).cast("int").alias("level"))
    table = np.zeros(1 << LEVEL_BITS, np.uint8)
    page = F.shiftright("bucket", 12)  # at most 4 MB, as 1,024 pages
    for r in levels.groupBy(page.alias("page")).agg(F.collect_list("bucket").alias("b"), F.collect_list("level").alias("l")).coalesce(LEVEL_PARTS).toLocalIterator():
        table[np.array(r.b, int)] = r.l
    return table


def _need(n: int, percent: int) -> int:
    """The fewest n-grams that a set of n shares with a set as similar as asked."""
    return -(-percent * n // 100)


def prefix(keys: np.ndarray, sizes: np.ndarray, levels: np.ndarray, differ: int) -> tuple[np.ndarray, int]:
    """The adaptive prefix of a set's blocks and how many matches it asks for; all blocks if there are no more than may differ.

    Of blocks equally rare, those of more n-grams come first.
    """
    level = levels[(keys & np.uint64((1 << LEVEL_BITS) - 1)).astype(np.int64)]
    most = min(LONGEST_MATCH, len(keys) - differ)
    if most < 1:
        return keys, 1
    order = np.lexsort((keys, -sizes, level))
    cost = np.cumsum(np.exp2(level[order[: differ + most]].astype(float)))
    ls = np.arange(1, most + 1)
    total = cost[differ : differ + most] * (1 + VERIFY_COST / ls)
    best = int(ls[np.argmin(total)])
    return keys[order[: differ + best]], best


def prefixes(grams: np.ndarray, levels: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, int]]:
    """Keys under which a set meets all others as similar as asked, by size class, and how many matches it asks for."""
    few = False
    for size_class, parts, differ in size_classes(len(grams), percent):
        keys, sizes = blocks(grams, size_class, parts)
        few = few or len(keys) <= differ
        yield prefix(keys, sizes, levels, differ)
    if few:  # two such sets need not share a block
        yield _mixed(grams[: len(grams) - _need(len(grams), percent) + 1]), 1


def _prefixes(docs: DataFrame, words: int, percent: int, levels: np.ndarray) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(levels)
    schema = pa.schema([("gram", pa.int64()), ("cls", pa.int64()), ("n", pa.int32()), ("least", pa.int32())])

    def cut(batches):
        classes = set()
        for b in batches:
            # Copies near each other are left out here, all others where prefixes meet.
            if len(classes) > HELD_CLASSES:
                classes.clear()
            for k in range(0, b.num_rows, ROWS):
                out = [[], [], [], []]
                for text in b.column(1).slice(k, ROWS):
                    grams = ngrams(text.as_py(), words)
                    key = _class_of(grams)
                    if len(grams) and key not in classes:
                        classes.add(key)
                        for first, least in prefixes(grams, sent.value, percent):
                            for column, values in zip(out, (first.view(np.int64), np.full(len(first), key), np.full(len(first), len(grams)), np.full(len(first), least)), strict=True):
                                column.append(values)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return docs.mapInArrow(cut, "gram long, cls long, n int, least int")


def _postings(prefixes: DataFrame, percent: int) -> DataFrame:
    """The rows of prefixes, each once, whose block another set of a near enough size has as well.

    Sets of one posting list differ, or they would be one class. A set has nothing to meet in a list if even the sets of the next
    sizes there are too small and too large for it.
    """
    by_size = Window.partitionBy("gram").orderBy("n", "cls")
    smaller, larger = F.lag("n").over(by_size), F.lead("n").over(by_size)
    near = (100 * smaller >= percent * F.col("n")) | (100 * F.col("n") >= percent * larger)
    # One shuffle by block: what follows has its partitioning.
    return prefixes.repartition("gram").distinct().withColumn("near", near).filter("near").drop("near")


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """cls, sketch and n-grams of the texts whose class is the one that docs (text, cls) names."""
    names = [f"s{k}" for k in range(SKETCH)]
    schema = pa.schema([("cls", pa.int64()), ("grams", pa.list_(pa.int64())), *((c, pa.int64()) for c in names)])

    def full(batches):
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                found = [(key, ngrams(t.as_py(), words)) for t, key in zip(b.column(0).slice(k, ROWS), b.column(1).slice(k, ROWS).to_pylist(), strict=True)]
                found = [(key, grams) for key, grams in found if len(grams) and _class_of(grams) == key]
                sketches = np.array([sketch(g) for _, g in found], np.int64).reshape(len(found), SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key for key, _ in found], pa.int64()), pa.array([g.view(np.int64) for _, g in found], schema[1].type), *(pa.array(c) for c in sketches.T)],
                    schema=schema,
                )

    return docs.select("text", "cls").mapInArrow(full, "cls long, grams array<long>, " + ", ".join(f"{c} long" for c in names))


def _sent(table: DataFrame) -> DataFrame:
    """A table of a few numbers in a row, sent to all tasks if it is small enough to be."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _apart(a: str, b: str) -> Column:
    """In how many bits the sketches of two rows differ."""
    return sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(1, SKETCH)), F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))


def _similar(pairs: DataFrame, sets: DataFrame, percent: int, sketched: bool) -> DataFrame:
    """The pairs of classes (a, b) whose whole sets reach the similarity.

    Sets are only sent for pairs whose sketches may be near enough; ``sketched`` pairs are known to be. Others have their
    sizes na and nb and tell in how many lists they meet.
    """
    if not sketched:
        # Sets as similar as asked differ in (100 - percent) / (100 + percent) of both sizes at most, and so do their sketches.
        left, right = (sets.select(F.col("cls").alias(c), *(F.col(f"s{k}").alias(f"s{k}") for k in range(SKETCH))).alias(f"s{c}") for c in "ab")
        met = pairs.alias("p").join(left, F.col("p.a") == F.col("sa.a")).join(right, F.col("p.b") == F.col("sb.b"))
        near = met.filter((100 + percent) * _apart("sa", "sb") <= (100 - percent) * (F.col("na") + F.col("nb"))).select("p.*")
        # Of the stars that a set is in, the one it shares most lists with: its set is sent once a round.
        pairs = near.groupBy("a").agg(F.max(F.struct("lists", "b")).alias("best")).select("a", "best.b")
    pairs = materialise(pairs.select("a", "b").distinct(), "pairs")
    named = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    needed = sets.select("cls", "grams").join(_sent(named), "cls", "left_semi")
    left, right = (needed.select(F.col("cls").alias(c), F.col("grams").alias(f"grams_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("grams_a", "grams_b"))
    union = F.size("grams_a") + F.size("grams_b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b").distinct()


def link(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """row, n and root of each row of docs (row, text); rows with one root are alike or linked by others that are.

    row is a number, which may be NULL or that of several rows; docs is read three times and must have the same rows each
    time. Two texts link if 100 * shared >= percent * all of their
    n-grams of words: ASCII letters are lower-cased, words are what stands between ASCII blanks.
    NULL texts and texts without words have n = 0, no root and link with nothing.
    Sets and n-grams are told apart by 64-bit hashes.
    """
    docs = docs.select("row", F.col("text").cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))
    spark = docs.sparkSession
    with small_batches(spark):
        rows = materialise(_rows(docs, words, percent), "ngram-rows")
    texts = materialise(rows.filter("n IS NOT NULL").select("row", "digest", "n", "cls"), "classes")
    levels = _levels(rows)
    discard(rows)
    with small_batches(spark):
        prefixes = materialise(_prefixes(docs, words, percent, levels), "prefixes")
    postings = materialise(_postings(prefixes, percent), "postings")
    discard(prefixes)
    # One text for each class: the smallest digest under its smallest number.
    wanted = postings.select("cls").distinct()
    smallest = texts.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("row").alias("of"))
    named = texts.join(smallest, "cls").filter(F.col("row").eqNullSafe(F.col("of"))).groupBy("cls", "of").agg(F.min("digest").alias("it"))
    one_each = materialise(named, "one-each")
    of_class = F.col("row").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("it"))
    with small_batches(spark):
        sets = materialise(_sets(docs.join(_sent(one_each), of_class), words), "sets")
    n, different = sets.agg(F.count(F.lit(1)), F.count_distinct("cls")).first()
    if n > different:  # copies with one number
        several, sets = sets, materialise(sets.dropDuplicates(["cls"]), "sets")
        discard(several)
    discard(one_each)
    roots = _components_of_classes(postings, sets, percent)
    discard(sets)
    found = texts.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    return found.select("row", "n", F.coalesce("root", "cls").alias("root"))


def _components_of_classes(postings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """node and root of all classes that link with another."""
    spark = postings.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    open_, before = postings, math.inf
    for turn in range(STAR_ROUNDS + 1):
        # Posting lists whose sets are in one component have nothing more to tell.
        labelled = open_.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        # The more shared blocks a prefix has, the fewer are the set's own: the set is in the middle of its group.
        labelled = labelled.select("gram", "cls", "n", "least", "root", F.count(F.lit(1)).over(Window.partitionBy("cls")).alias("central"))
        # Sets of one component in a list, then what pairs across components would remain.
        by_root = labelled.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("k"))
        lists = by_root.groupBy("gram").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("inner"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
        lists = materialise(lists, "lists")
        last_open, open_ = open_, materialise(labelled.join(lists.select("gram"), "gram", "left_semi"), "open")
        across, size = lists.agg(F.sum(F.expr("(m * m - inner) / 2")), F.sum("m")).first()
        discard(last_open, lists)
        if not size:
            discard(open_)
            return roots
        if across <= 2 * size or across > 0.9 * before or turn == STAR_ROUNDS:
            break
        before = across
        # A star: one set is compared with all others of its list. It is one in the middle, in every other round any.
        middle = F.lit(0) if turn % 2 else -F.col("central")
        order = F.struct(middle, F.xxhash64(F.lit(turn), "gram", "cls"), "cls", "n", "root")
        heads = open_.groupBy("gram").agg(F.min(order).alias("head")).select("gram", F.col("head.cls").alias("b"), F.col("head.n").alias("nb"), F.col("head.root").alias("rb"))
        near = (100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")) & (F.col("root") != F.col("rb"))
        stars = open_.join(heads, "gram").filter(near).select(F.col("cls").alias("a"), "b", F.col("n").alias("na"), "nb")
        pairs = stars.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("lists"))
        last_links, links = links, materialise(links.unionByName(_similar(pairs, sets, percent, sketched=False)), "similar")
        discard(last_links)
        roots = components(links)
        last_open, open_ = open_, open_.select("gram", "cls", "n", "least")
        open_._scratch = last_open._scratch
    sketched = materialise(open_.join(sets.drop("grams"), "cls"), "sketched")
    discard(open_)
    a, b = sketched.alias("a"), sketched.alias("b")
    far = (F.col("a.cls") < F.col("b.cls")) & (F.col("a.root") != F.col("b.root"))
    near = (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) & ((100 + percent) * _apart("a", "b") <= (100 - percent) * (F.col("a.n") + F.col("b.n")))
    met = a.join(b, (F.col("a.gram") == F.col("b.gram")) & far & near)
    pairs = met.groupBy(F.col("a.cls").alias("a"), F.col("b.cls").alias("b")).agg(F.count(F.lit(1)).alias("k"), F.min(F.least("a.least", "b.least")).alias("least"))
    links = materialise(links.unionByName(_similar(pairs.filter("k >= least").select("a", "b"), sets, percent, sketched=True)), "similar")
    discard(sketched)
    return components(links)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs (doc_id, text).

    component_id is the smallest doc_id that links reach, the row's own included. Rows with
    one doc_id are texts of their own; rows with a NULL doc_id take part and are never the
    smallest, unless their whole component has none. Texts without words are alone.
    See ``link`` for what links. An empty table gives no rows.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("row"), "text")
    found = link(known, words, percent).withColumnRenamed("row", "doc_id")
    least = found.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    return found.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
