import math

import numpy as np
import pytest
from pyspark.sql import types as T

from trainlake.llm import neighbours

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType())])


def brute(rows, least):
    n, root = [0] * len(rows), list(range(len(rows)))
    unit = [None if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v) else np.array(v, np.float32).astype(float) for _, v, _, _ in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                n[a] += 1
                n[b] += 1
                root[top(a)] = top(b)
    ids = {}
    for k, r in enumerate(rows):
        ids.setdefault(top(k), []).append(r[0])
    return sorted((r[0], n[k], min(ids[top(k)])) for k, r in enumerate(rows))


def test_groups_copies_and_chains(spark):
    rng = np.random.default_rng(1)
    rows = []
    for group in range(12):
        centre = rng.standard_normal(16)
        for _ in range([1, 2, 3, 60][group % 4]):
            rows.append((len(rows), (centre + 0.17 * rng.standard_normal(16)).astype(np.float32).tolist(), group % 2, "x"))
    rows += [(len(rows) + k, rows[5][1], rows[5][2], "x") for k in range(30)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 16, [nan] * 16, [inf] + [0.0] * 15, [None] + [1.0] * 15]
    rows += [(1000 + k, v, 0, "x") for k, v in enumerate(bad)] + [(2000, rows[5][1], None, "x"), (2001, rows[5][1][:8], 1, "x")]
    found, recall = neighbours.near_vectors(spark.createDataFrame(rows, SCHEMA), queries="vec_id % 10 = 0")
    assert recall >= 0.9
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found.collect()) == brute(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.collect())


@pytest.mark.parametrize("queries", ["vec_id % 10 = 0", "vec_id < 0"])
@pytest.mark.parametrize("rounds", [1, 3])
def test_no_link_is_lost_where_the_graph_is_poor(spark, monkeypatch, queries, rounds):
    for name, value in (("TREES", 1), ("BLOCK", 4), ("LEAF", 2), ("MAX_ROUNDS", rounds)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((150, 16))
    rows = [(k, (centres[k // 2] + 0.15 * rng.standard_normal(16)).astype(np.float32).tolist(), 0, "x") for k in range(300)]
    found, recall = neighbours.near_vectors(spark.createDataFrame(rows, SCHEMA), queries=queries, recall=1.0)
    assert recall == 1.0
    audited = sorted((r.vec_id, r.n_links, r.component_id) for r in found.collect())
    if rounds == 1 or queries == "vec_id < 0":
        assert audited == brute(rows, 0.93)


def test_no_vectors(spark):
    found, recall = neighbours.near_vectors(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and recall == 1.0
