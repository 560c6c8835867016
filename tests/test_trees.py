import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trainlake.operators import boosting, models, trees
from trainlake.operators.evaluate import feature_importance
from trainlake.operators.features import Roles
from trainlake.operators.models import fit_pipeline

ROLES = Roles(("s", "t"), ("x", "z"))


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(2000).select(
        i, (i % 6).cast("string").alias("s"), (i * 7 % 4).cast("string").alias("t"), (i * 13 % 101).cast("double").alias("x"), (i % 3).cast("double").alias("z"),
    ).withColumn("y", F.col("x") / 5 + F.when(F.col("s") == "3", 9).otherwise(F.col("z")) + (F.col("id") * 31 % 17) / 10).withColumn(
        "labels", (F.col("y") > 11).cast("double")
    ).cache()


ESTIMATORS = {
    "tree": lambda: models.tree("y", maxDepth=4), "forest": lambda: models.forest("y", numTrees=4, maxDepth=4),
    "boosted": lambda: models.boosted("y", maxIter=3, maxDepth=3), "classifier": lambda: models.boosted_classifier("labels", maxIter=3),
}


@pytest.mark.parametrize("name", ESTIMATORS)
def test_parts_add_up_to_the_prediction(rows, name):
    fitted = fit_pipeline(rows, ROLES, ESTIMATORS[name]())
    scored = fitted.model.transform(rows)
    nodes = trees.node_table(fitted.model.stages[-1])
    assert nodes.filter("node = 0").count() == (1 if name == "tree" else 4 if name == "forest" else 3)
    found = trees.contributions(nodes, scored, fitted.inputs)
    whole = F.col("base") + sum((F.col(f"contributions.{c}") for c in fitted.inputs), F.lit(0.0))
    target = vector_to_array("rawPrediction")[1] if name == "classifier" else F.col("prediction")
    assert found.agg(F.max(F.abs(whole - target))).first()[0] < 1e-9
    assert found.count() == rows.count() and found.columns == [*scored.columns, "contributions", "base"]


@pytest.mark.parametrize("name", ["tree", "forest", "boosted"])
def test_importance_is_that_of_spark_ml(rows, name):
    fitted = fit_pipeline(rows, ROLES, ESTIMATORS[name]())
    ours = {r.feature: r.importance for r in trees.importance(trees.node_table(fitted.model.stages[-1]), fitted.inputs, None, name != "boosted").collect()}
    theirs = {r.feature: r.importance for r in feature_importance(fitted.model, fitted.inputs, None).collect()}
    assert ours == pytest.approx(theirs, abs=1e-9) and len(ours) == 4


def test_a_tree_without_a_split(spark):
    flat = spark.range(50).select((F.col("id") % 5).cast("double").alias("x"), F.lit(2.0).alias("y"))
    fitted = fit_pipeline(flat, Roles((), ("x",)), models.tree("y"))
    nodes = trees.node_table(fitted.model.stages[-1])
    assert [tuple(r) for r in trees.importance(nodes, ["x"]).collect()] == [("x", 0.0)]
    row = trees.contributions(nodes, fitted.model.transform(flat), ["x"]).first()
    assert (row.contributions.x, row.base) == (0.0, 2.0)


def brute_tree(data, margins, most, least_rows):
    """Best-first growth over all cuts of all features, in plain Python; the cells of the tree and their steps."""
    import math

    grads = [(1 / (1 + math.exp(-m)) - r["y"], 1 / (1 + math.exp(-m)) * (1 - 1 / (1 + math.exp(-m)))) for r, m in zip(data, margins)]

    def total(rows):
        return sum(grads[i][0] for i in rows), sum(grads[i][1] for i in rows)

    def best(rows):
        found = None
        g, h = total(rows)
        for f, c in enumerate("abx"):
            sums = {}
            for i in rows:
                sums.setdefault(data[i][c], []).append(i)
            keys = sorted(sums, key=(lambda k: (total(sums[k])[0] / total(sums[k])[1], k)) if c != "x" else (lambda k: k))
            left = []
            for k in keys[:-1]:
                left += sums[k]
                right = [i for i in rows if i not in set(left)]
                (gl, hl), (gr, hr) = total(left), total(right)
                if len(left) < least_rows or len(right) < least_rows or hl < 1e-3 or hr < 1e-3:
                    continue
                gain = gl**2 / hl + gr**2 / hr - g**2 / h
                if gain > 0 and (found is None or gain > found[0] + 1e-12):
                    found = (gain, list(left), right)
        return found

    leaves = [list(range(len(data)))]
    while len(leaves) < most:
        cuts = [(best(rows), -k) for k, rows in enumerate(leaves)]
        ready = [(c[0], k, c) for c, k in cuts if c]
        if not ready:
            break
        _, k, cut = max(ready, key=lambda t: t[:2])
        leaves[-k] = cut[1]
        leaves.append(cut[2])
    out = [0] * len(data)
    for number, rows in enumerate(leaves):
        g, h = total(rows)
        for i in rows:
            out[i] = (number, -0.1 * g / h)
    return out


def test_leafwise_trees_equal_brute_force(spark):
    import math

    data = [{"a": i * 5 % 4, "b": i * 3 % 5, "x": float(i * 11 % 13), "y": float((i * 7 + i // 9) % 5 < 2 + (i * 5 % 4 == 1))} for i in range(300)]
    table = spark.createDataFrame([(i, str(r["a"]), str(r["b"]), r["x"], r["y"]) for i, r in enumerate(data)], "id int, a string, b string, x double, y double")
    model = boosting.fit_leafwise(table, Roles(("a", "b"), ("x",)), "y", leaves=5, rounds=3, least_rows=10)
    found = {r.id: r for r in model.transform(table).collect()}
    positive = sum(r["y"] for r in data)
    margins = [math.log(positive / (len(data) - positive))] * len(data)
    for tree in range(3):
        steps = brute_tree(data, margins, 5, 10)
        assert [found[i].leafPrediction[tree] for i in range(len(data))] == [number for number, _ in steps]
        margins = [m + s for m, (_, s) in zip(margins, steps)]
    assert [found[i].rawPrediction for i in range(len(data))] == pytest.approx(margins)


def test_leafwise_learns_saves_and_explains(spark, rows, tmp_path):
    model = boosting.fit_leafwise(rows, ROLES, "labels")
    scored = model.transform(rows)
    assert scored.filter("prediction = labels").count() > 0.9 * rows.count()
    assert scored.select(F.size("leafPrediction")).distinct().first()[0] == 10
    assert scored.agg(F.max(F.array_max("leafPrediction"))).first()[0] == 4
    whole = F.col("base") + sum((F.col(f"contributions.{c}") for c in model.inputs), F.lit(0.0))
    assert scored.agg(F.max(F.abs(whole - F.col("rawPrediction")))).first()[0] < 1e-9
    model.save(str(tmp_path / "m"))
    again = boosting.LeafwiseModel.load(spark, str(tmp_path / "m")).transform(rows)
    assert again.select("id", "rawPrediction", "leafPrediction").exceptAll(scored.select("id", "rawPrediction", "leafPrediction")).isEmpty()


def test_leafwise_needs_both_classes(spark, rows):
    with pytest.raises(ValueError, match="both classes"):
        boosting.fit_leafwise(rows.filter("labels = 1"), ROLES, "labels")
    one = boosting.fit_leafwise(rows, Roles((), ("z",)), "labels", rounds=1, least_rows=10_000)
    assert one.nodes.count() == 1
