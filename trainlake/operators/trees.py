"""Trees as a table of nodes: importance of features, and each feature's part in a row's prediction."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from trainlake.session import scratch_path

#: One row for each node. A node without a left child is a leaf. Rows go left if the feature's value is at most the
#: threshold or, where `left_values` is set, among those. `value` is what the node would predict, `rows` what it was
#: fitted on (their weights), `gain` the loss that its split saves, by unit of rows.
NODES = (
    "tree int, tree_weight double, node int, value double, rows double, gain double, left int, right int, "
    "feature int, threshold double, left_values array<double>"
)


def node_table(model: Model) -> DataFrame:
    """The nodes of a fitted Spark ML tree, forest or boosted ensemble, as the model saves them.

    A forest is the mean of its trees, boosting their weighted sum.
    """
    spark = SparkSession.active()
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    if "nodeData" in stored.columns:
        # Three columns: the tree, its parameters, its weight.
        trees = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "params", "tree_weight").drop("params")
        share = F.lit(model.getNumTrees) if "Forest" in type(model).__name__ else F.lit(1)
        nodes = stored.join(trees, "treeID").select("treeID", (F.col("tree_weight") / share).alias("tree_weight"), "nodeData.*")
    else:
        nodes = stored.select(F.lit(0).alias("treeID"), F.lit(1.0).alias("tree_weight"), "*")
    inner = F.col("leftChild") >= 0
    values = F.col("split.leftCategoriesOrThreshold")
    nominal = F.col("split.numCategories") >= 0
    return nodes.select(
        F.col("treeID").cast("int").alias("tree"), F.col("tree_weight").cast("double").alias("tree_weight"), F.col("id").cast("int").alias("node"),
        F.col("prediction").alias("value"), F.col("impurityStats")[0].alias("rows"), F.when(inner, F.col("gain")).alias("gain"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & ~nominal, F.get(values, F.lit(0))).alias("threshold"), F.when(inner & nominal, values).alias("left_values"),
    )


def importance(nodes: DataFrame, inputs: Sequence[str], k: int | None = 10, by_tree: bool = True) -> DataFrame:
    """(feature, importance): the loss that splits on a feature save, as a share of what all save; the largest first.

    by_tree takes the shares within each tree and averages them, as is usual for forests; without it large
    savings of early trees count for more, as for boosting. Features that no split uses have 0.
    """
    spark = nodes.sparkSession
    names = spark.createDataFrame(list(enumerate(inputs)), "feature int, name string")
    saved = nodes.filter("feature IS NOT NULL").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("saved"))
    if by_tree:
        whole = saved.groupBy("tree").agg(F.sum("saved").alias("whole")).filter("whole > 0")
        saved = saved.join(whole, "tree").withColumn("saved", F.col("saved") / F.col("whole"))
    by_feature = saved.groupBy("feature").agg(F.sum("saved").alias("share"))
    total = by_feature.agg(F.sum("share").alias("total"))
    shares = by_feature.crossJoin(F.broadcast(total)).select("feature", (F.col("share") / F.col("total")).alias("importance"))  # one row
    found = names.join(shares, "feature", "left").select(F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
    ranked = found.orderBy(F.desc("importance"), "feature")
    return ranked if k is None else ranked.limit(k)


class Walk:
    """Expressions over an array of feature values that walk down trees.

    The nodes are collected: they are as many as the model has, which Spark ML holds on the driver as well.
    """

    def __init__(self, nodes: DataFrame, n_features: int):
        self.n_features = n_features
        self.trees: dict[int, dict[int, Row]] = {}
        for row in nodes.collect():
            self.trees.setdefault(row["tree"], {})[row["node"]] = row

    def _leaves(self, tree: dict[int, Row], node: int, at: list[float], leaves: list[tuple[Row, list[float]]], x: Column) -> Column:
        """Which of the leaves a row falls into; leaves gets each with the parts of the way to it."""
        here = tree[node]
        if here["left"] is None:
            leaves.append((here, at))
            return F.lit(len(leaves) - 1)
        value = F.get(x, F.lit(here["feature"]))
        goes_left = value.isin(here["left_values"]) if here["left_values"] is not None else value <= here["threshold"]
        sides = []
        for child in (here["left"], here["right"]):
            parts = list(at)
            parts[here["feature"]] += here["tree_weight"] * (tree[child]["value"] - here["value"])
            sides.append(self._leaves(tree, child, parts, leaves, x))
        return F.when(goes_left, sides[0]).otherwise(sides[1])

    def _looked_up(self, x: Column, of: Callable[[Row, list[float]], object]) -> list[Column]:
        """What each tree has for the leaf that a row falls into."""
        found = []
        for _, tree in sorted(self.trees.items()):
            leaves: list[tuple[Row, list[float]]] = []
            leaf = self._leaves(tree, 0, [0.0] * self.n_features, leaves, x)
            found.append(F.get(F.lit([of(*known) for known in leaves]), leaf))
        return found

    def prediction(self, x: Column) -> Column:
        return sum(self._looked_up(x, lambda row, _: row["tree_weight"] * row["value"]), F.lit(0.0))

    def leaves(self, x: Column) -> Column:
        """The number of each tree's leaf, from the column `leaf` of the nodes."""
        return F.array(*self._looked_up(x, lambda row, _: row["leaf"]))

    def base(self) -> float:
        """What is predicted before any split."""
        return sum(tree[0]["tree_weight"] * tree[0]["value"] for tree in self.trees.values())

    def contributions(self, x: Column) -> Column:
        """Each feature's part in a prediction, which is their sum and base().

        A split's part is the step from the node's value to the child's, on the row's own path.
        """
        parts = self._looked_up(x, lambda _, parts: parts)
        none = F.lit([0.0] * self.n_features)
        return F.aggregate(F.array(*parts), none, lambda total, tree: F.zip_with(total, tree, lambda a, b: a + b))


def contributions(nodes: DataFrame, rows: DataFrame, inputs: Sequence[str], features: str = "features", base: float = 0.0) -> DataFrame:
    """rows with `contributions`, a struct of a number for each input, and `base`; together they are the prediction.

    Inputs have one slot each in the features vector, as for importance. Boosted classifiers give parts of
    their margin; base is what they add to their trees. No row is moved.
    """
    walk = Walk(nodes, len(inputs))
    found = rows.withColumn("_parts", walk.contributions(vector_to_array(features)))
    named = F.struct(*(F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(inputs)))
    return found.select(*rows.columns, named.alias("contributions"), F.lit(base + walk.base()).alias("base"))
