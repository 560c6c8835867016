"""Near-duplicate embeddings by NN-descent.

Copies of a vector are one node. A first neighbour graph comes from random hyperplanes: nodes are
ordered by the sides they lie on, and blocks of that order are compared. Then rounds of NN-descent compare the
neighbours of each node with one another and keep the best of each list. Lists that are full of
links are saturated: such nodes are compared with all vectors of their label, in blocks, so
no partner is lost to the length of a list. A fixed query set is compared with all vectors, too; the
share of its links that the graph has found is the audited recall. Where the queries have no links to find,
vectors drawn by hash take their place. While the recall is too low, rounds go on with fresh hyperplanes and
longer lists; if it stays too low, or there are no links to measure it by, all vectors are compared, in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.llm.components import components
from trainlake.session import materialise

LIST = 12
TREES = 6
LEAF = 96
BLOCK = 192
WIDE_BLOCK = 512
MAX_ROUNDS = 6
#: Nodes drawn for the audit, about, where the queries have no links.
AUDITED = 2_000
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("cos", pa.float64())])
EDGES = "u long, v long, cos double"


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """row, grp and unit of the vectors that can link; unit holds the doubles of the vector of length one."""
    valid = "label IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)"
    schema = pa.schema([("row", pa.int64()), ("grp", pa.string()), ("unit", pa.binary())])

    def scale(batches):
        for b in batches:
            units = []
            for values in b.column(2):
                x = np.array(values.as_py(), np.float64)
                x = x / np.abs(x).max()
                units.append((x / np.sqrt((x * x).sum())).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(units, pa.binary())], schema=schema)

    grp = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string")).alias("grp")
    return vectors.filter(F.expr(valid)).select("row", grp, F.col("embedding").cast("array<double>")).mapInArrow(scale, "row long, grp string, unit binary")


def _matrix(units) -> np.ndarray:
    return np.stack([np.frombuffer(u, np.float64) for u in units])


def _edges(u, v, cos) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(u), pa.int64()), pa.array(np.asarray(v), pa.int64()), pa.array(np.asarray(cos), pa.float64())], schema=_EDGE)


def _best(ids: np.ndarray, cos: np.ndarray, k: int) -> pa.RecordBatch:
    """The k nearest others of each row of a square of cosines."""
    np.fill_diagonal(cos, -2)
    k = min(k, len(ids) - 1)
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    return _edges(np.repeat(ids, k), ids[near].ravel(), np.take_along_axis(cos, near, 1).ravel())


def _first_graph(nodes: DataFrame, planes: int, first: int = 0, length: int = LIST) -> DataFrame:
    """Edges between nodes that lie in one block of a random order of hyperplane sides; first is the number of the first tree."""
    keys = pa.schema([("tree", pa.int32()), ("grp", pa.string()), ("side", pa.int64()), ("along", pa.float64()), ("node", pa.int64()), ("unit", pa.binary())])

    def place(batches):
        for b in batches:
            size = np.array([len(u) for u in b.column(2).to_pylist()], int) // 8
            for dims in np.unique(size):
                at = np.flatnonzero(size == dims)
                part = b.take(pa.array(at))
                x = _matrix(part.column(2).to_pylist())
                for tree in range(first, first + TREES):
                    normal = np.random.default_rng((7, tree, int(dims))).standard_normal((dims, planes + 1))
                    seen = x @ normal
                    side = (seen[:, :planes] > 0) @ (1 << np.arange(planes, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), tree), pa.int32()), part.column(1), pa.array(side, pa.int64()), pa.array(seen[:, planes]), part.column(0), part.column(2)], schema=keys)

    def compare(batches):
        held: list[tuple] = []
        key = None

        def block():
            if len(held) > 1:
                x = _matrix([h[1] for h in held])
                yield _best(np.array([h[0] for h in held]), x @ x.T, length)

        for b in batches:
            columns = [b.column(k).to_pylist() for k in range(6)]
            for tree, grp, side, _, node, unit in zip(*columns, strict=True):
                if (tree, grp) != key or len(held) >= BLOCK:
                    yield from block()
                    held = held[-BLOCK // 4 :] if (tree, grp) == key else []
                    key = tree, grp
                held.append((node, unit))
        yield from block()

    placed = nodes.select("node", "grp", "unit").mapInArrow(place, "tree int, grp string, side long, along double, node long, unit binary")
    # Blocks cross from one side to the next where a side has few nodes, and cut it where it has very many.
    order = ("tree", "grp", "side", "along", "node")
    return materialise(placed, "placed").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, EDGES)


def _lists(edges: DataFrame, length: int = LIST) -> DataFrame:
    """The best different neighbours of each node."""
    per = edges.groupBy("u", "v").agg(F.max("cos").alias("cos"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("cos", "v")), asc=False), 1, length)
    return per.groupBy("u").agg(best.alias("best")).select("u", F.explode("best").alias("e")).select("u", "e.v", "e.cos")


def _descend(lists: DataFrame, nodes: DataFrame, length: int = LIST) -> DataFrame:
    """Edges between neighbours of one node: of each node its list, and as many of the best of those that list it."""
    back = _lists(lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "cos"), length)
    around = lists.select("u", "v").unionByName(back.select("u", "v")).unionByName(lists.select("u", F.col("u").alias("v"))).distinct()
    given = around.join(nodes.select(F.col("node").alias("v"), "unit"), "v")
    meeting = given.groupBy("u").agg(F.collect_list(F.struct("v", "unit")).alias("met"))  # at most 2 length + 1

    def compare(batches):
        for b in batches:
            for met in b.column(0).to_pylist():
                if len(met) > 1:
                    x = _matrix([m["unit"] for m in met])
                    yield _best(np.array([m["v"] for m in met]), x @ x.T, length)

    return meeting.select("met").mapInArrow(compare, EDGES)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes as rows of matrices of at most WIDE_BLOCK vectors of one group."""
    schema = pa.schema([("block", pa.int64()), ("grp", pa.string()), ("ids", pa.binary()), ("copies", pa.binary()), ("asked", pa.binary()), ("units", pa.binary())])

    def build(batches):
        held: dict[str, list] = {}

        def row(grp):
            rows = held.pop(grp)
            ids = np.array([r[0] for r in rows], np.int64)
            values = ids[0], grp, ids.tobytes(), np.array([r[1] for r in rows], np.int64).tobytes(), np.array([r[2] for r in rows], bool).tobytes(), b"".join(r[3] for r in rows)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for b in batches:
            for node, grp, copies, asked, unit in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                held.setdefault(grp, []).append((node, copies, asked, unit))
                if len(held[grp]) >= WIDE_BLOCK:
                    yield row(grp)
        for grp in list(held):
            yield row(grp)

    spread = nodes.select("node", "grp", "copies", "asked", "unit").repartition("grp", F.pmod(F.xxhash64("node"), F.lit(64)))
    return spread.mapInArrow(build, "block long, grp string, ids binary, copies binary, asked binary, units binary")


def _exact(asked: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Of asked nodes against all of their group: node, partner (-1, or one of its component here) and n, the vectors linked.

    For each pair of blocks a node gets the number of vectors that link with it, and links that
    hold together what is linked there; the pairs themselves are not written.
    """
    left, right = materialise(_blocks(asked), "asked"), materialise(_blocks(nodes), "blocks")
    pairs = left.select(F.col("block").alias("a"), "grp").join(right.select(F.col("block").alias("b"), "grp"), "grp").select("a", "b")
    both = pairs.join(left.select(F.col("block").alias("a"), F.col("ids").alias("ids_a"), F.col("copies").alias("copies_a"), F.col("units").alias("units_a")), "a")
    both = both.join(right.select(F.col("block").alias("b"), F.col("ids").alias("ids_b"), F.col("copies").alias("copies_b"), F.col("asked").alias("asked_b"), F.col("units").alias("units_b")), "b")
    schema = pa.schema([("node", pa.int64()), ("partner", pa.int64()), ("n", pa.int64())])

    def compare(batches):
        for b in batches:
            for ids_a, copies_a, units_a, ids_b, copies_b, asked_b, units_b in zip(*(b.column(k).to_pylist() for k in range(7)), strict=True):
                ia, ib = np.frombuffer(ids_a, np.int64), np.frombuffer(ids_b, np.int64)
                ca, cb = np.frombuffer(copies_a, np.int64), np.frombuffer(copies_b, np.int64)
                xa, xb = (np.frombuffer(u, np.float64).reshape(n, -1) for u, n in ((units_a, len(ia)), (units_b, len(ib))))
                linked = (xa @ xb.T >= least) & (ia[:, None] != ib[None, :])
                rows, columns = np.nonzero(linked)
                if not len(rows):
                    continue
                # A node of this block for each row with links, and its first row for each column: together they connect all that is linked here.
                first = np.full(len(ib), -1)
                first[columns[::-1]] = rows[::-1]
                some = np.flatnonzero(linked.any(1))
                joined = linked[some].argmax(1)
                holds = [(ib[c], ia[first[c]]) for c in np.flatnonzero(first >= 0)] + [(ia[r], ib[c]) for r, c in zip(some, joined, strict=True)]
                # Rows that share a column with an earlier row meet it there; the others are joined through all their columns.
                holds += [(ia[r], ia[first[c]]) for r, c in _meetings(rows, columns, first)]
                n_a = linked @ cb
                other = ~np.frombuffer(asked_b, bool)
                n_b = np.where(other, ca @ linked, 0)
                out = [(x, -1, n) for x, n in zip(ia, n_a, strict=True) if n] + [(x, -1, n) for x, n in zip(ib, n_b, strict=True) if n]
                out += [(x, y, 0) for x, y in holds]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*out, strict=True)], schema=schema)

    return both.select("ids_a", "copies_a", "units_a", "ids_b", "copies_b", "asked_b", "units_b").mapInArrow(compare, "node long, partner long, n long")


def _meetings(rows: np.ndarray, columns: np.ndarray, first: np.ndarray):
    """For each row and each different first row of its columns one (row, column): a bounded set with the same components."""
    keys = rows * (first.max() + 1) + first[columns]
    _, at = np.unique(keys, return_index=True)
    return [(rows[k], columns[k]) for k in at if rows[k] != first[columns[k]]]


def near_vectors(vectors: DataFrame, least: float = 0.93, queries: str = "vec_id % 100 = 0", recall: float = 0.95) -> tuple[DataFrame, float]:
    """n_links, component_id and kept of every vector, and the audited recall (1 where all were compared).

    vectors has vec_id, embedding and label; other columns are not looked at. Only vectors with the same
    label and the same length are compared. Vectors without a label, NULL or empty ones, zero ones and
    those with NULL or non-finite components link with nothing. Rows with one vec_id are vectors of
    their own; component_id is the smallest vec_id of the component, and a NULL one where no row has any.
    An empty table gives no rows and recall 1.
    """
    vectors = vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors = materialise(vectors, "vectors")
    units = materialise(unit_vectors(vectors), "units")
    asked = vectors.filter(queries).select("row").withColumn("asked", F.lit(True))
    marked = units.join(asked, "row", "left")
    nodes = materialise(marked.groupBy("grp", "unit").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.coalesce(F.bool_or("asked"), F.lit(False)).alias("asked")), "nodes")
    members = units.join(nodes.select("grp", "unit", "node", "copies"), ["grp", "unit"]).select("row", "node", "copies")
    largest = nodes.groupBy("grp").count().agg(F.max("count")).first()[0] or 0
    planes = max(1, min(40, int(np.ceil(np.log2(max(2, largest / LEAF))))))
    audits: dict[str, DataFrame] = {}

    def audit(name: str, drawn) -> tuple:
        """Links found and links there are, of the drawn nodes that are not full."""
        if name not in audits:
            some = nodes.withColumn("asked", drawn)
            audits[name] = materialise(_exact(some.filter("asked"), some, least).join(some.filter("asked").select("node"), "node").filter("partner = -1").groupBy("node").agg(F.sum("n").alias("n")), "truth")
        open_ = audits[name].join(full.select("node"), "node", "left_anti").join(found, "node", "left")
        return tuple(open_.agg(F.coalesce(F.sum(F.coalesce("found", F.lit(0))), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first())

    n_nodes = nodes.count()
    lists = materialise(_lists(_first_graph(nodes, planes)), "lists")
    turn, length, seen = 0, LIST, 1.0
    while True:
        turn += 1
        lists = materialise(_lists(lists.unionByName(_descend(lists, nodes, length)), length), "lists")
        near = lists.filter(F.col("cos") >= least)
        full = materialise(near.groupBy("u").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= length).select(F.col("u").alias("node"), F.lit(True).alias("full")), "full")
        pairs = near.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(nodes.select(F.col("node").alias("b"), "copies"), "b")
        found = both.groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("found"))
        # Full nodes are compared with all vectors after the rounds; the others have to have their links by then.
        n_open = n_nodes - full.count()
        got, there = audit("queries", F.col("asked"))
        if n_open and not there:
            got, there = audit("drawn", F.pmod(F.xxhash64("node"), F.lit(max(1, n_nodes // AUDITED))) == 0)
        seen = got / there if there else float(not n_open)
        if seen >= recall or turn >= MAX_ROUNDS or not there:
            break
        length *= 2
        lists = materialise(lists.unionByName(_first_graph(nodes, planes, turn * TREES, length)), "lists")
    state = nodes.join(full, "node", "left")
    wide = state.withColumn("asked", F.lit(seen < recall) | F.col("asked") | F.coalesce("full", F.lit(False))).select("node", "grp", "unit", "copies", "asked")
    wide = materialise(wide, "state")
    exact = materialise(_exact(wide.filter("asked"), wide, least), "exact")
    truth = exact.filter("partner = -1").groupBy("node").agg(F.sum("n").alias("n"))
    seen = seen if seen >= recall else 1.0
    # Nodes that were compared with all vectors have exact numbers; links between the others are those of the graph.
    others = wide.filter("NOT asked").select("node")
    plain = both.join(others.select(F.col("node").alias("a")), "a").join(others.select(F.col("node").alias("b")), "b")
    counted = truth.unionByName(plain.groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("n"))).groupBy("node").agg(F.sum("n").alias("n"))
    links = exact.filter("partner >= 0").select(F.col("node").alias("a"), F.col("partner").alias("b")).unionByName(plain.select("a", "b"))
    roots = components(links).withColumnRenamed("root", "top")
    whole = vectors.select("row", "vec_id").join(members, "row", "left").join(counted, "node", "left").join(roots, "node", "left")
    whole = whole.withColumn("top", F.coalesce("top", "node", "row")).withColumn("n_links", F.coalesce("n", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0)))
    whole = materialise(whole.select("row", "vec_id", "top", "n_links"), "whole")
    least_id = whole.groupBy("top").agg(F.min("vec_id").alias("component_id"))
    return whole.join(least_id, "top").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")), seen
