"""Boosted binary classification with trees that grow leaf by leaf.

Feature values are binned once. Every split of a tree is one aggregation: gradients and curvatures of the rows in the
newest leaves, summed by leaf, feature and bin, so a task sends at most that many rows however many it reads. The
best cut of each leaf is found among these sums, and the leaf with the best cut is split next.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainlake.operators.features import Roles
from trainlake.operators.models import fit_features
from trainlake.operators.trees import NODES, Walk, contributions

LEAVES, ROUNDS, RATE = 5, 10, 0.1
BINS = 255
LEAST_ROWS, LEAST_CURVATURE = 20, 1e-3
QUANTILE_ERROR = 1e-3


@dataclass(frozen=True)
class LeafwiseModel:
    """Feature stages, the nodes of all trees (with the number of each leaf) and the margin before the first tree."""

    features: PipelineModel
    inputs: tuple[str, ...]
    nodes: DataFrame
    base: float

    def transform(self, rows: DataFrame) -> DataFrame:
        """rows with features, rawPrediction (the margin), probability, prediction, leafPrediction, contributions and base."""
        found = contributions(self.nodes, self.features.transform(rows), self.inputs, base=self.base)
        walk, x = Walk(self.nodes, len(self.inputs)), vector_to_array("features")
        scored = found.withColumn("rawPrediction", self.base + walk.prediction(x)).withColumn("leafPrediction", walk.leaves(x))
        return scored.withColumn("probability", _probability(F.col("rawPrediction"))).withColumn("prediction", (F.col("rawPrediction") > 0).cast("double"))

    def save(self, path: str) -> None:
        self.features.write().save(f"{path}/features")
        self.nodes.coalesce(1).write.parquet(f"{path}/nodes")
        described = self.nodes.sparkSession.createDataFrame([(list(self.inputs), self.base)], "inputs array<string>, base double")
        described.coalesce(1).write.json(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LeafwiseModel:
        (row,) = spark.read.schema("inputs array<string>, base double").json(f"{path}/model").collect()
        return cls(PipelineModel.load(f"{path}/features"), tuple(row.inputs), spark.read.parquet(f"{path}/nodes"), row.base)


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


@dataclass
class _Leaf:
    """A leaf while its tree grows: its sums, its number, its node, the rows that fall into it, and its best cut."""

    number: int
    node: int
    inside: Column
    gradient: float
    curvature: float
    rows: int
    cut: dict | None = None


def _binned(rows: DataFrame, label: str, n_nominal: int, n_inputs: int, bins: int) -> tuple[DataFrame, list[list[float]]]:
    """(y, bins) of the labelled rows, and the thresholds of each number; values below a threshold lie in the bins before it."""
    labelled = rows.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), vector_to_array("features").alias("x"))
    numbers = [f"n{i}" for i in range(n_nominal, n_inputs)]
    flat = labelled.select("y", *(F.col("x")[i].cast("int").alias(f"c{i}") for i in range(n_nominal)), *(F.col("x")[int(c[1:])].alias(c) for c in numbers))
    found = flat.approxQuantile(numbers, [k / bins for k in range(1, bins)], QUANTILE_ERROR) if numbers else []
    thresholds = [sorted(set(values)) for values in found]
    for name, cuts in zip(numbers, thresholds, strict=True):
        flat = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=name, outputCol=f"{name}_bin").transform(flat) if cuts else flat.withColumn(f"{name}_bin", F.lit(0))
    binned = flat.select("y", F.array(*(F.col(f"c{i}") for i in range(n_nominal)), *(F.col(f"{c}_bin").cast("int") for c in numbers)).alias("bins"))
    return binned, thresholds


def _best_cuts(rows: DataFrame, leaves: Sequence[_Leaf], margin: Column, n_nominal: int, least_rows: int) -> dict[int, dict]:
    """The best cut of each leaf that has one; the sums of all leaves with a row in them."""
    leaf = F.coalesce(*(F.when(one.inside, F.lit(one.number)) for one in leaves))
    p = _probability(margin)
    spread = rows.select(leaf.alias("leaf"), (p - F.col("y")).alias("g"), (p * (1 - p)).alias("h"), "bins").filter("leaf IS NOT NULL")
    sums = (
        spread.select("leaf", "g", "h", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
    )
    # Levels are cut in the order of the step that each would take for itself, numbers in their own.
    nominal = F.col("feature") < n_nominal
    order = [F.when(nominal, F.col("g") / F.col("h")).otherwise(F.col("bin")), F.col("bin")]
    left = Window.partitionBy("leaf", "feature").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("leaf", "feature")
    cuts = sums.select(
        "leaf", "feature", "bin", nominal.alias("nominal"), F.when(nominal, F.collect_list("bin").over(left)).alias("left_bins"),
        *(F.sum(c).over(left).alias(f"left_{c}") for c in "ghn"), *(F.sum(c).over(whole).alias(c) for c in "ghn"),
    )
    right = {c: F.col(c) - F.col(f"left_{c}") for c in "ghn"}
    enough = (F.col("left_n") >= least_rows) & (right["n"] >= least_rows) & (F.col("left_h") >= LEAST_CURVATURE) & (right["h"] >= LEAST_CURVATURE)
    gain = F.col("left_g") ** 2 / F.col("left_h") + right["g"] ** 2 / right["h"] - F.col("g") ** 2 / F.col("h")
    valid = cuts.filter(enough).withColumn("gain", gain).filter("gain > 0")
    best = valid.groupBy("leaf").agg(F.max_by(F.struct("*"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("cut"))
    return {row.leaf: row.cut.asDict() for row in best.collect()}  # one row for each leaf


def fit_leafwise(
    train: DataFrame, roles: Roles, label: str, leaves: int = LEAVES, rounds: int = ROUNDS, rate: float = RATE,
    bins: int = BINS, least_rows: int = LEAST_ROWS, **options,
) -> LeafwiseModel:
    """Boosted trees of at most `leaves` leaves for a label of 0 and 1; rows without a label are left out.

    Starts from the log odds of all rows. A split saves GL^2/HL + GR^2/HR - G^2/H, a leaf steps by -rate G/H. The left child keeps
    the number of its leaf, the right one takes the next. A tree that finds no cut has one leaf.
    """
    spark = train.sparkSession
    fitted = fit_features(train, roles, one_hot=False, label=label, bins=bins, wide_levels=options.pop("wide_levels", bins), **options)
    n_nominal, n_inputs = len(roles.categorical), len(fitted.inputs)
    binned, thresholds = _binned(fitted.model.transform(train), label, n_nominal, n_inputs, bins)
    rows = binned.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, positive = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
        if not n or not 0 < positive < n:
            raise ValueError("the label needs rows of both classes")
        base = math.log(positive / (n - positive))
        margin, nodes = F.lit(base), []
        for tree in range(rounds):
            grown, step = _grow(rows, margin, tree, leaves, rate, n_nominal, thresholds, least_rows, n)
            nodes += grown
            margin = margin + step
    finally:
        rows.unpersist()
    return LeafwiseModel(fitted.model, fitted.inputs, spark.createDataFrame(nodes, NODES + ", leaf int"), base)


def _grow(
    rows: DataFrame, margin: Column, tree: int, most: int, rate: float, n_nominal: int, thresholds: list[list[float]], least_rows: int, n: int
) -> tuple[list[tuple], Column]:
    """The nodes of one tree and its step as an expression over binned rows."""
    p = _probability(margin)
    g, h = rows.agg(F.sum(p - F.col("y")), F.sum(p * (1 - p))).first()
    root = _Leaf(0, 0, F.lit(True), g, h, n)
    leaves, nodes, fresh = [root], {}, [root]

    def node(at: _Leaf, **split) -> None:
        values = {"gain": None, "left": None, "right": None, "feature": None, "threshold": None, "left_values": None, "leaf": None} | split
        nodes[at.node] = (
            tree, rate, at.node, -at.gradient / at.curvature, float(at.rows), values["gain"], values["left"], values["right"],
            values["feature"], values["threshold"], values["left_values"], values["leaf"],
        )

    while len(leaves) < most:
        found = _best_cuts(rows, fresh, margin, n_nominal, least_rows)
        for leaf in fresh:
            leaf.cut = found.get(leaf.number)
        ready = [leaf for leaf in leaves if leaf.cut]
        if not ready:
            break
        best = max(ready, key=lambda leaf: (leaf.cut["gain"], -leaf.number))
        cut, value = best.cut, F.get("bins", F.lit(best.cut["feature"]))
        goes_left = value.isin(cut["left_bins"]) if cut["nominal"] else value <= cut["bin"]
        at = len(nodes) + len(leaves)
        left = _Leaf(best.number, at, best.inside & goes_left, cut["left_g"], cut["left_h"], cut["left_n"])
        right = _Leaf(len(leaves), at + 1, best.inside & ~goes_left, cut["g"] - cut["left_g"], cut["h"] - cut["left_h"], cut["n"] - cut["left_n"])
        # A number lies in the bins up to a cut if it is below the next threshold.
        threshold = None if cut["nominal"] else math.nextafter(thresholds[cut["feature"] - n_nominal][cut["bin"]], -math.inf)
        node(
            best, gain=cut["gain"] / best.rows, left=left.node, right=right.node, feature=cut["feature"], threshold=threshold,
            left_values=[float(b) for b in cut["left_bins"]] if cut["nominal"] else None,
        )
        leaves[leaves.index(best)] = left
        leaves.append(right)
        fresh = [left, right]
    for leaf in leaves:
        node(leaf, leaf=leaf.number)
    step = F.coalesce(*(F.when(leaf.inside, F.lit(-rate * leaf.gradient / leaf.curvature)) for leaf in leaves))
    return [nodes[k] for k in sorted(nodes)], step
