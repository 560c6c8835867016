"""Connected components by alternating stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.session import materialise


def _hook(pairs: DataFrame, both_ways: bool) -> DataFrame:
    """Every node takes the smallest node next to it; its neighbours are linked with that one.

    both_ways (large star) looks at all neighbours and links the larger ones; else (small star) a node
    looks at its smaller neighbours and links them and itself.
    """
    towards = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))  # v < u
    if both_ways:
        around = towards.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = around.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = towards.groupBy("u").agg(F.min("v").alias("m"))
        linked = towards.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        linked = linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return linked.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of all nodes with a link.

    links has two columns of long numbers, one link in each row, in any direction and as often as it
    likes; NULLs and links to itself are left out. Each round is written to the shared folder;
    the number of rounds grows with the logarithm of the longest path. A node with very many
    links only meets in partial minima and in joins, which adaptive execution splits.
    """
    x, y = (F.col(c).cast("long") for c in links.columns[:2])
    pairs = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter("a <> b").distinct()
    pairs, seen = materialise(pairs, "links"), None
    while True:
        state = tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        pairs = materialise(_hook(_hook(pairs, True), False), "links")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
