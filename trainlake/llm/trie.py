"""Prefix trie of rebuilt conversations, by union-find over the prefixes that sorted neighbours share.

Each conversation is a key: one fixed-width digest for each turn, so that keys sort by prefix. In sorted order, the
number of turns that two neighbours share is an edge between them. Taking edges by falling depth, each edge joins the
components on its two sides, and every join is a node of the trie at that depth, with what was joined below it.

Sorted keys are ranged over tasks, and each task builds the forest of its range. Only prefixes of its first and last key can go
on in another range: everything else is final. The two keys are handed on with what hangs below each of their prefixes, contracted to
sums, and the same procedure builds the trie of these, over fewer and fewer ranges until one holds all.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trainlake.llm.turns import numbered_turns
from trainlake.session import materialise, scratch_path

#: Characters of a turn's digest in a key: 144 bits in base 64.
UNIT = 24
#: A rebuilt conversation takes less than so many turns from the conversation that opens its hundred.
HEADS = 6
CONVERSATIONS = 50_000
#: Contracted keys and their characters in one task.
KEYS, KEY_CHARS = 1024, 64 << 20
#: Characters of conversation ids in one row, for groups that may go on in another task.
CHUNK = 1 << 20
BROADCAST_ROWS = 500_000
ROWS = 10_000
NOBODY = hashlib.sha256(b"").hexdigest()

_HANGING = "array<struct<depth:long,n:long,first:long,children:long,leaves:long,saved:long,ends:string>>"
PIECES = (
    "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    f"ends_sha256 string, node string, parent string, key string, chars array<long>, hanging {_HANGING}, ids string"
)
_FIELDS = [f.split(" ")[0] for f in PIECES.split(", ")]
_LONGS = set("conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens".split())
_BELOW = pa.struct([*((c, pa.int64()) for c in "depth n first children leaves saved".split()), ("ends", pa.string())])
_PIECE = pa.schema([(c, pa.int64() if c in _LONGS else pa.list_(pa.int64()) if c == "chars" else pa.list_(_BELOW) if c == "hanging" else pa.string()) for c in _FIELDS])


@dataclass
class Below:
    """What hangs at a depth of a key besides other keys of the task: conversations, and sums over subtrees.

    ``ends`` is the digest of the conversations that end there, None if there are none, empty if other tasks may have more.
    """

    depth: int
    n: int = 0
    first: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None

    def add(self, n: int, first: int | None, children: int, leaves: int, saved: int, ends: str | None) -> None:
        self.n += n
        if first is not None:
            self.first = first if self.first is None else min(self.first, first)
        self.children += children
        self.leaves += leaves
        self.saved += saved
        self.ends = ends if self.ends is None else self.ends if ends is None else ""


@dataclass
class Node:
    depth: int
    key: int
    own: Below
    kids: list[Node] = field(default_factory=list)
    parent: Node | None = None
    #: What is handed on for the node, if keys of other tasks may start with its prefix.
    open: Below | None = None
    n: int = 0
    first: int = 0
    leaves: int = 0
    saved: int = 0


@dataclass
class Key:
    text: str
    chars: list[int]
    hanging: list[Below]

    @property
    def depth(self) -> int:
        return len(self.chars)


def name(prefix: str) -> str:
    return hashlib.blake2b(prefix.encode(), digest_size=16).hexdigest()


def shared(a: str, b: str) -> int:
    """Turns that two keys share at their start."""
    low, high = 0, min(len(a), len(b)) // UNIT
    while low < high:
        middle = (low + high + 1) // 2
        if a[low * UNIT : middle * UNIT] == b[low * UNIT : middle * UNIT]:
            low = middle
        else:
            high = middle - 1
    return low


def forest(keys: list[Key]) -> tuple[list[Node], dict[int, Node]]:
    """Nodes at every depth where keys part or something hangs, kids before parents, and the node of each whole key."""
    events: dict[int, list[tuple[int, Below | None]]] = defaultdict(list)
    for k in range(len(keys) - 1):
        events[shared(keys[k].text, keys[k + 1].text)].append((k, None))
    for k, key in enumerate(keys):
        for below in key.hanging:
            events[below.depth].append((k, below))
    events[0].append((0, Below(0)))
    above = list(range(len(keys)))
    tops: list[list[Node]] = [[] for _ in keys]

    def find(k: int) -> int:
        while above[k] != k:
            above[k] = above[above[k]]
            k = above[k]
        return k

    nodes, leaves = [], {}
    for depth in sorted(events, reverse=True):
        for k, below in events[depth]:
            if below is None:
                a, b = find(k), find(k + 1)
                if len(tops[a]) < len(tops[b]):
                    a, b = b, a
                above[b] = a
                tops[a] += tops[b]
                tops[b] = []
        here: dict[int, Node] = {}
        for k, below in events[depth]:
            root = find(k)
            if root not in here:
                here[root] = Node(depth, k, Below(depth), tops[root])
                tops[root] = [here[root]]
                nodes.append(here[root])
            if below is not None:
                if depth == keys[k].depth:
                    leaves[k] = here[root]
                here[root].own.add(below.n, below.first, below.children, below.leaves, below.saved, below.ends)
        for node in here.values():
            node.n, node.leaves, node.saved = node.own.n, node.own.leaves, node.own.saved
            firsts = [kid.first for kid in node.kids] + ([] if node.own.first is None else [node.own.first])
            node.first = min(firsts) if firsts else 0
            for kid in node.kids:
                kid.parent = node
                node.n += kid.n
                node.leaves += kid.leaves
                node.saved += saved_above(kid, depth, keys)
            if not node.kids and not node.own.children:
                node.leaves = 1
    return nodes, leaves


def saved_above(node: Node, depth: int, keys: list[Key]) -> int:
    """Code points saved in the subtree of a node and on the way down to it from a depth, that depth left out."""
    return node.saved + (node.n - 1) * sum(keys[node.key].chars[depth : node.depth])


def _row(**values) -> dict:
    return dict.fromkeys(_FIELDS) | values


def pieces(keys: list[Key], whole: bool, named: bool) -> Iterator[dict]:
    """Final nodes of sorted keys, and the contracted first and last key unless this is the whole trie.

    A node whose parent is not final has the parent's name instead of its conversation; ``named`` nodes tell their own.
    """
    if not keys:
        return
    nodes, leaves = forest(keys)
    if not whole:
        for side in dict.fromkeys((0, len(keys) - 1)):
            path, at = [], leaves[side]
            while at is not None and at.open is None:
                at.open = Below(at.depth)
                at.open.add(at.own.n, at.own.first, at.own.children, at.own.leaves, at.own.saved, at.own.ends)
                path.append(at)
                at = at.parent
            keys[side].hanging = [node.open for node in path]
        for node in nodes:
            if node.open is None and node.parent.open is not None:
                node.parent.open.add(node.n, node.first, 1, node.leaves, saved_above(node, node.parent.depth, keys), None)
        for side in dict.fromkeys((0, len(keys) - 1)):
            # Nothing is left for a last key that equals the first.
            if hanging := [vars(b) for b in keys[side].hanging if b.n]:
                yield _row(kind="key", key=keys[side].text, chars=keys[side].chars, hanging=hanging)
    for node in nodes:
        if node.open is None:
            yield from _expanded(node, keys, named)


def _expanded(node: Node, keys: list[Key], named: bool) -> Iterator[dict]:
    """A final node and those on the way down to it, which have the same conversations and one child each."""
    key, above = keys[node.key], node.parent.depth if node.parent else -1
    final_parent = node.parent is not None and node.parent.open is None
    saved, children, ends = node.saved, len(node.kids) + node.own.children, NOBODY if node.own.ends is None else node.own.ends or None
    for depth in range(node.depth, above, -1):
        saved += (node.n - 1) * key.chars[depth - 1] if depth else 0
        values = {"conv_id": node.first, "depth": depth, "n_convs": node.n, "n_children": children, "n_leaves": node.leaves, "saved_tokens": saved, "ends_sha256": ends}
        if depth == node.depth and (named or ends is None):
            values["node"] = name(key.text[: depth * UNIT])
        if depth - 1 > above:
            values["parent_conv_id"] = node.first
        elif final_parent:
            values["parent_conv_id"] = node.parent.first
        elif depth:
            values["parent"] = name(key.text[: above * UNIT])
        yield _row(kind="node", **values)
        children, ends = 1, NOBODY


def _batches(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=_PIECE)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema=_PIECE)


def _first_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of sorted conversations; equal ones are one key, whose conversation ids are hashed as they pass by."""

    def rows():
        keys: list[Key] = []
        text, ids, digest, start, first = None, [], None, 0, 0
        size = 0

        def chunk():
            return _row(kind="ids", node=name(text), conv_id=start, ids=",".join(ids))

        def close():
            keys[-1].hanging[0].ends = digest.hexdigest()

        for batch in batches:
            for conv_id, key, chars in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if key != text:
                    if keys:
                        close()
                        if len(keys) == 1:
                            keys[0].hanging[0].ends = ""
                            yield chunk()
                    text, ids, digest, start, size = key, [], hashlib.sha256(), conv_id, 0
                    keys.append(Key(key, chars, [Below(len(chars), 0, conv_id)]))
                    digest.update(str(conv_id).encode())
                else:
                    digest.update(b",%d" % conv_id)
                if not ids:
                    start = conv_id
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
                keys[-1].hanging[0].n += 1
                if size >= CHUNK:
                    yield chunk()
                    ids, size = [], 0
        if keys:
            keys[-1].hanging[0].ends = ""
            yield chunk()
        yield from pieces(keys, whole=False, named=False)

    yield from _batches(rows())


def _later_pieces(whole: bool):
    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = [
            Key(key, chars, [Below(**b) for b in hanging])
            for batch in batches
            for key, chars, hanging in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
        ]
        yield from _batches(pieces(keys, whole, named=True))

    return build


def _digest_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each group, whose chunks come in order."""
    node, digest = None, None
    for batch in batches:
        found = []
        for of, _, ids in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if of != node:
                if node is not None:
                    found.append((node, digest.hexdigest()))
                node, digest = of, hashlib.sha256()
            elif ids:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], names=["node", "sha"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["node", "sha"])


def _write(spark: SparkSession, df: DataFrame, build) -> DataFrame:
    path = scratch_path(spark, "trie")
    found = df.mapInArrow(build, PIECES)
    found.write.partitionBy("kind").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, key, chars of every conversation as it is rebuilt.

    The first h turns come from the conversation that opens the hundred (none if it is not there), the others are
    the conversation's own after its first h; h is the crc32 of the decimal conv_id modulo 6. Rows without a
    conv_id are left out. Turns are ordered by turn, NULL first, then by role and text.
    """
    digest = F.base64(F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, UNIT * 3 // 4))
    numbered = numbered_turns(conversations.filter("conv_id IS NOT NULL"))
    turns = numbered.select("conv_id", "at", digest.alias("digest"), F.length("text").cast("long").alias("chars"))
    own_heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    # Every conversation has a turn 0.
    opened = turns.filter("at = 0").select("conv_id", own_heads.alias("h"), F.expr("conv_id - conv_id % 100").alias("base"))
    heads = turns.filter(F.col("at") < HEADS - 1).select(F.col("conv_id").alias("base"), "at", "digest", "chars")
    turn = F.struct("at", "digest", "chars")
    begun = opened.join(heads, "base").filter("at < h").select("conv_id", turn.alias("turn"))
    went_on = turns.filter(F.col("at") >= own_heads).select("conv_id", turn.alias("turn"))
    none = opened.select("conv_id", F.lit(None).cast(went_on.schema["turn"].dataType).alias("turn"))
    gathered = begun.unionByName(went_on).unionByName(none).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return gathered.select("conv_id", F.array_join("turns.digest", "").alias("key"), F.col("turns.chars").alias("chars"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each distinct sequence of first turns of the rebuilt conversations, from the empty one on.

    conversations needs conv_id, turn, role and text; other columns are not looked at. NULL roles and texts are empty; rows without a
    conv_id belong to no conversation and are left out; repeated rows are turns of their own. An empty table gives
    no rows. A conversation's digests, 24 characters a turn, have to fit one row.

    conv_id is the smallest conversation that starts with the sequence, parent_conv_id that of the sequence without its last
    turn, n_convs, n_children and n_leaves count conversations, longer sequences by one turn and sequences that no
    conversation goes on from; saved_tokens adds up, over the subtree, the code points of last turns that need not be
    repeated for further conversations; ends_sha256 tells which conversations end there.
    """
    spark = conversations.sparkSession
    whole = materialise(rebuilt(conversations), "rebuilt")
    tasks = max(1, -(-whole.count() // CONVERSATIONS))
    first = _write(spark, whole.select("conv_id", "key", "chars").repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id"), _first_pieces)
    found, upper = first.filter("kind = 'node'"), None
    keys = first.filter("kind = 'key'").select("key", "chars", "hanging")
    while True:
        n, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("key")), F.lit(0))).first()
        tasks = max(1, -(-n // KEYS), -(-size // KEY_CHARS))
        last = tasks == 1 or tasks > n // 4
        ranged = keys.coalesce(1) if last else keys.repartitionByRange(tasks, "key")
        later = _write(spark, ranged.sortWithinPartitions("key"), _later_pieces(last))
        nodes = later.filter("kind = 'node'")
        upper = nodes if upper is None else upper.unionByName(nodes)
        if last:
            break
        keys = later.filter("kind = 'key'").select("key", "chars", "hanging")

    # Groups of equal conversations at the ends of tasks: at most two for each task.
    ends = first.filter("kind = 'ids'").select("node", "conv_id", "ids").join(F.broadcast(upper.filter("ends_sha256 IS NULL").select("node")), "node", "left_semi")
    digests = ends.select("node", "conv_id", "ids").repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(_digest_ids, "node string, sha string")
    named = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent")).filter("parent IS NOT NULL")
    if upper.count() <= BROADCAST_ROWS:
        named = F.broadcast(named)
    parts = found.unionByName(upper).join(F.broadcast(digests), "node", "left").join(named, "parent", "left")
    return parts.select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "of_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", "sha").alias("ends_sha256"),
    )
