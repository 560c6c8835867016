"""Tree models fitted to sums over the cells of their bins, for cross-validation of many rows.

A regression tree sees nothing of a row but the bin of each feature, and takes nothing from the rows of a node but their number and
the sums of the label and of its square. So rows that agree in all bins, a cell, count for a fit only by these three sums. There are
at most as many cells as the product of the bins, whatever the values and however many rows. Where that is far less than the rows, one scan sums up the
cells of all folds, for each tree of a forest with the weights of its own bootstrap sample of the rows. Spark ML fits single trees and boosted ones
to two weighted points for each cell that have the same sums; it cannot weigh the trees of a forest apart, so these are grown here as it grows them, with
the same features drawn for a node, the trees of all forests and folds together. No fit keeps the rows, or passes over them for each level of each tree.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.operators.evaluate import METRICS, regression_metrics
from trainlake.operators.models import SEED, Fitted
from trainlake.session import materialise

#: Fewer rows are left to Spark ML as they are: they fit into memory.
FEW_ROWS = 2_000_000
#: Rows for each cell and fold, at least, for cells to be worth their while.
ROWS_PER_CELL = 8
#: Bootstrap samples that are summed up in one scan.
SAMPLES_PER_SCAN = 11
#: Bytes of a row of cell and label in a shuffle.
ROW_BYTES = 24
#: Sums that a task holds at a time while trees grow.
SUMS_PER_TASK = 8_000_000
#: Rows that Spark ML looks at for the bins of a number, if they are more than the square of the bins.
ROWS_FOR_BINS = 10_000

#: How many of so many features a node of a forest may be split by, as Spark ML has it.
SUBSETS = {
    "all": lambda n: n, "onethird": lambda n: math.ceil(n / 3), "sqrt": lambda n: math.ceil(math.sqrt(n)),
    "log2": lambda n: max(1, math.ceil(math.log(n) / math.log(2))),
}
SUBSETS["auto"] = SUBSETS["onethird"]

#: Below which of 2^64 hashes a row is not in a bootstrap sample, is in it once at most, and so on, by Poisson's distribution with mean 1.
POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(18)]
POISSON = [min(round(share * 2.0**64) - 2**63, 2**63 - 1) for share in POISSON]

FOLD, CELL, LABEL, WEIGHT = "_fold", "_cell", "_label", "_weight"
#: A bootstrap sample: seed and number of the tree; none stands for all rows once.
Sample = tuple[int, int] | None


def can_fit(estimators: Sequence[Estimator]) -> bool:
    """Whether the sums of cells are all that the fits take from the rows."""
    return all(
        type(e) in (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor)
        and not e.isSet("weightCol")
        and e.getMinWeightFractionPerNode() == 0
        and (not e.hasParam("subsamplingRate") or e.getOrDefault("subsamplingRate") == 1)
        and (not isinstance(e, RandomForestRegressor) or e.getFeatureSubsetStrategy() in SUBSETS)
        and (not isinstance(e, GBTRegressor) or (e.getLossType() == "squared" and not e.isSet("validationIndicatorCol")))
        and e.getMaxBins() == estimators[0].getMaxBins() and e.getLabelCol() == estimators[0].getLabelCol()
        for e in estimators
    )


# --- bins and cells -------------------------------------------------------------


def thresholds(values: Sequence[float], bins: int) -> list[float]:
    """Where Spark ML cuts a number into bins, by a sample: between all different values, or so that bins have about as many rows."""
    counts: dict[float, int] = {}
    for value in values:
        counts[value] = counts.get(value, 0) + 1
    levels = sorted(counts)
    cuts = [(low + high) / 2 for low, high in zip(levels, levels[1:])]
    if len(cuts) < bins:
        return cuts
    stride = len(values) / bins
    kept, seen, target = [], counts[levels[0]], stride
    for cut, level in zip(cuts, levels[1:]):
        before, seen = seen, seen + counts[level]
        if abs(before - target) < abs(seen - target):
            kept.append(cut)
            target += stride
    return kept


@dataclass(frozen=True)
class Cells:
    """Rows with their fold, cell and label; how many bins each feature has, and what Spark ML knows of the features."""

    rows: DataFrame
    sizes: Sequence[int]
    categorical: frozenset[int]
    about: Mapping
    n: int
    folds: int
    mean: float

    def features(self) -> Column:
        """The bins of a cell as a vector."""
        bins, below = [], F.col(CELL)
        for size in reversed(self.sizes):
            bins.insert(0, F.pmod(below, F.lit(size)).cast("double"))
            below = F.floor(below / size)
        return array_to_vector(F.array(*bins)).alias("features", metadata=dict(self.about))


def find_cells(train: DataFrame, features: Fitted, estimators: Sequence[Estimator], folds: int, fold: str) -> Cells | None:
    """The cells of the rows; None if they would not be much fewer than the rows, or do not hold all that a fit needs.

    Numbers are cut into bins by a sample of all rows, as the other feature stages are fitted on all rows.
    """
    if not can_fit(estimators) or features.model.stages[-1].getHandleInvalid() == "keep" or (n := train.count()) < FEW_ROWS:
        return None
    label, most = estimators[0].getLabelCol(), estimators[0].getMaxBins()
    found = features.model.transform(train)
    about = found.schema["features"].metadata
    kinds = about.get("ml_attr", {}).get("attrs", {})
    levels = {a["idx"]: len(a["vals"]) for a in kinds.get("nominal", []) if "vals" in a}
    numbers = {k: c for k, c in enumerate(features.inputs) if k not in levels}
    if len(numbers) + len(levels) != len(features.inputs) or {a["idx"] for a in kinds.get("numeric", [])} != set(numbers):
        return None
    least = math.prod(levels.values()) * folds * ROWS_PER_CELL
    if not 0 < least <= n or max([*levels.values(), 0]) > most:
        return None
    y = F.col(label).cast("double")
    odd = [~F.coalesce(F.abs(c) < math.inf, F.lit(False)) | F.isnan(c) for c in (y, *(F.col(c).cast("double") for c in numbers.values()))]
    seen = found.agg(F.count_if(odd[0]).alias("odd"), *(F.count_if(o).alias(f"odd_{i}") for i, o in enumerate(odd[1:])), F.avg(y).alias("mean")).first()
    if any(v for k, v in seen.asDict().items() if k != "mean"):
        return None  # Spark ML has its own words for these
    needed, cuts = max(most * most, ROWS_FOR_BINS), {}
    if numbers:
        some = found.select(*numbers.values()).sample(min(1.0, needed / n), SEED).toArrow()
        cuts = {k: thresholds(some[c].to_pylist(), most) for k, c in numbers.items()}
    sizes = [levels[k] if k in levels else len(cuts[k]) + 1 for k in range(len(features.inputs))]
    if math.prod(sizes) * folds * ROWS_PER_CELL > n:
        return None
    cell, cut = F.lit(0).cast("bigint"), [k for k in numbers if cuts[k]]
    if cut:  # a value that equals a cut is below it
        edges = [[-math.inf, *np.nextafter(cuts[k], math.inf).tolist(), math.inf] for k in cut]
        found = Bucketizer(splitsArray=edges, inputCols=[numbers[k] for k in cut], outputCols=[f"_bin{k}" for k in cut]).transform(found)
    for k, (name, size) in enumerate(zip(features.inputs, sizes)):
        own = F.col(name) if k in levels else F.col(f"_bin{k}") if k in cut else F.lit(0)
        cell = cell * size + own.cast("bigint")
    # Rows of no fold among these are never held out.
    number = F.when(F.col(fold).between(0, folds - 1), F.col(fold)).otherwise(folds).cast("int")
    rows = found.filter(F.col(fold).isNotNull()).select(number.alias(FOLD), cell.alias(CELL), y.alias(LABEL))
    rows = materialise(rows, "cell-rows")  # read to sum them up, once or more, and to score
    return Cells(rows, sizes, frozenset(levels), about, n, folds, seen["mean"])


# --- sums -----------------------------------------------------------------------


def poisson(row: Column, seed: int, number: int) -> Column:
    """How often a bootstrap sample holds the row: a draw from Poisson's distribution with mean 1, by a hash of the row's number."""
    drawn, found = F.xxhash64(row, F.lit(seed), F.lit(number)), None
    for k, edge in enumerate(POISSON):
        found = (F if found is None else found).when(drawn < edge, float(k))
    return found.otherwise(float(len(POISSON)))


def samples_of(estimator: Estimator) -> list[Sample]:
    """The sample of each tree of a forest; all rows for a tree, for boosting and for a forest without bootstrap."""
    if not isinstance(estimator, RandomForestRegressor):
        return [None]
    seeded = estimator.getBootstrap()
    return [(estimator.getSeed(), k) if seeded else None for k in range(estimator.getNumTrees())]


def sums(cells: Cells, samples: Sequence[Sample]) -> list[tuple[dict[Sample, int], DataFrame]]:
    """Tables (fold, cell, rows, and for each sample rows, sum of the label, sum of its square), of at most SAMPLES_PER_SCAN samples each.

    Labels are taken from their mean, so that sums of squares keep their digits. The rows are summed up where they are, unless the
    sums of all tasks would be more than the rows themselves: then the rows of a cell are brought together first.
    """
    made, parts, groups = [], cells.rows.rdd.getNumPartitions(), math.prod(cells.sizes) * (cells.folds + 1)
    label = F.col(LABEL)
    for start in range(0, len(samples), SAMPLES_PER_SCAN):
        mine = samples[start : start + SAMPLES_PER_SCAN]
        rows = cells.rows.select(FOLD, CELL, (label - F.lit(cells.mean)).alias(LABEL), F.monotonically_increasing_id().alias("_row"))
        if parts * min(groups, cells.n // parts) * len(mine) * 24 > cells.n * ROW_BYTES:
            rows = rows.repartition(FOLD, CELL)
        weights = [(F.lit(1.0) if s is None else poisson(F.col("_row"), *s)).alias(f"w{k}") for k, s in enumerate(mine)]
        totals = [F.count(F.lit(1)).alias("rows")]
        for k in range(len(mine)):
            w = F.col(f"w{k}")
            totals += [F.sum(w).alias(f"n{k}"), F.sum(w * label).alias(f"s{k}"), F.sum(w * label * label).alias(f"q{k}")]
        total = rows.select(FOLD, CELL, LABEL, *weights).groupBy(FOLD, CELL).agg(*totals)
        made.append(({s: k for k, s in enumerate(mine)}, materialise(total, "cells")))
    return made


def points(cells: Cells, table: DataFrame, k: int, held_out: int) -> DataFrame:
    """Features, label and weight: for each cell of the other folds two points with its sums in sample k."""
    n, mean = F.col(f"n{k}"), F.col(f"s{k}") / F.col(f"n{k}")
    spread = F.sqrt(F.greatest(F.col(f"q{k}") / n - mean * mean, F.lit(0.0)))
    both = [F.struct((F.lit(cells.mean) + mean + d).alias(LABEL), (n / 2).alias(WEIGHT)) for d in (-spread, spread)]
    known = table.filter((F.col(FOLD) != held_out) & (n > 0))
    return known.select(cells.features(), F.inline(F.array(*both)))


# --- forests ----------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number: feature (-1: a leaf), number of the left child (the right one is next), bins that go left, mean label."""

    feature: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    left: list[np.ndarray] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    level: list[int] = field(default_factory=list)

    def add(self, level: int, value: float, bins: int) -> int:
        for own, what in ((self.feature, -1), (self.child, -1), (self.left, np.zeros(bins, bool)), (self.value, value), (self.level, level)):
            own.append(what)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.child), np.array(self.left), np.array(self.value)


def node_of(arrays: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """The node without children that each column of bins comes to."""
    feature, child, left, _ = arrays
    node = np.zeros(bins.shape[1], np.int64)
    while (at := np.flatnonzero(feature[node] >= 0)).size:
        here = node[at]
        node[at] = child[here] + ~left[here, bins[feature[here], at]]
    return node


def bins_of(cell: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """The bins of cells, a row for each feature."""
    bins = []
    for size in reversed(sizes):
        cell, bin_ = np.divmod(cell, size)
        bins.insert(0, bin_)
    return np.array(bins)


def impurity(n, s, q):
    return (q - s * s / n) / n


def best_split(sums_: np.ndarray, subset: Sequence[int], cells: Cells, least: int, least_gain: float):
    """(gain, feature, bins that go left, sums left, sums right) of a node by its sums (3 x features of the subset x bins); None if no split is valid.

    Of equal gains the first counts. Categories are ordered by mean label.
    """
    best = None
    for j, f in enumerate(subset):
        own = sums_[:, j, : cells.sizes[f]]
        order = np.arange(cells.sizes[f])
        if f in cells.categorical:
            order = np.argsort(np.where(own[0] > 0, own[1] / np.maximum(own[0], 1), np.inf), kind="stable")
        left = np.cumsum(own[:, order], axis=1)
        total, left = left[:, -1:], left[:, :-1]
        right = total - left
        valid = (left[0] >= least) & (right[0] >= least)
        if not valid.any():
            continue
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = impurity(*total) - (left[0] * impurity(*left) + right[0] * impurity(*right)) / total[0]
        gain = np.where(valid & (gain >= least_gain), gain, -np.inf)
        at = int(np.argmax(gain))
        if gain[at] > (best[0] if best else -np.inf):
            goes = np.zeros(max(cells.sizes), bool)
            goes[order[: at + 1]] = True
            best = gain[at], f, goes, left[:, at], right[:, at]
    return best


class Forest:
    """A forest that grows on the cells of all folds but one, each tree on its sample, in the order in which Spark ML does."""

    def __init__(self, spark: SparkSession, cells: Cells, estimator: RandomForestRegressor, held_out: int):
        self.spark, self.cells, self.estimator, self.held_out = spark, cells, estimator, held_out
        self.samples, self.features = samples_of(estimator), len(cells.sizes)
        strategy = "all" if len(self.samples) == 1 and estimator.getFeatureSubsetStrategy() == "auto" else estimator.getFeatureSubsetStrategy()
        self.wanted = SUBSETS[strategy](self.features)
        self.rng = spark._jvm.java.util.Random(estimator.getSeed())
        self.trees = [Tree() for _ in self.samples]
        for tree in self.trees:
            tree.add(0, 0.0, max(cells.sizes))
        self.stack = [(t, 0) for t in range(len(self.trees))]
        self.seconds = 0.0

    def subset(self) -> list[int]:
        """The features of a node: a reservoir sample, drawn by the generators that Spark ML uses."""
        if self.wanted == self.features:
            return list(range(self.features))
        kept = list(range(self.wanted))
        drawn = self.spark._jvm.org.apache.spark.util.random.XORShiftRandom(self.rng.nextLong())
        for f in range(self.wanted, self.features):
            at = int(drawn.nextDouble() * (f + 1))
            if at < self.wanted:
                kept[at] = f
        return kept

    def next_nodes(self) -> list[tuple[int, int, list[int]]]:
        """(tree, node, features) of the nodes to split next."""
        nodes = [(t, node, self.subset()) for t, node in reversed(self.stack)]
        self.stack = []
        return nodes

    def split(self, nodes: Sequence[tuple[int, int, list[int]]], found: Mapping[tuple[int, int], np.ndarray]) -> None:
        """Split the nodes by their sums; the children are next, unless they are leaves."""
        e, width = self.estimator, max(self.cells.sizes)
        for t in _as_in_a_map(self.spark, [t for t, _, _ in nodes]):
            tree = self.trees[t]
            for node, subset in [(node, subset) for u, node, subset in nodes if u == t]:
                sums_, level = found[t, node], tree.level[node]
                n, s, _ = sums_[:, 0].sum(axis=1)
                if level == 0 and n:
                    tree.value[node] = s / n
                best = best_split(sums_, subset, self.cells, e.getMinInstancesPerNode(), e.getMinInfoGain()) if e.getMaxDepth() else None
                if best is None or best[0] <= 0:
                    continue
                _, tree.feature[node], tree.left[node], *children = best
                tree.child[node] = len(tree.feature)
                for n, s, q in children:
                    number = tree.add(level + 1, s / n, width)
                    if level + 1 < e.getMaxDepth() and abs(impurity(n, s, q)) >= 2.0**-52:
                        self.stack.append((t, number))


def _as_in_a_map(spark: SparkSession, keys: Sequence[int]) -> list[int]:
    """Numbers in the order of a Scala map, in which Spark ML goes through the trees."""
    found = spark._jvm.PythonUtils.toScalaMap(dict.fromkeys(sorted(set(keys)), 0)).keysIterator()
    order = []
    while found.hasNext():
        order.append(found.next())
    return order


def grow(forests: Sequence[Forest], tables: Sequence[tuple[dict[Sample, int], DataFrame]]) -> None:
    """Grow all forests together, level by level: for each, one pass over the cells sums up the bins of the nodes that are to be split."""
    while any(f.stack for f in forests):
        started = time.monotonic()
        nodes = [f.next_nodes() for f in forests]
        wanted = [(i, t, node, subset) for i, mine in enumerate(nodes) for t, node, subset in mine]
        found = [{} for _ in forests]
        for columns, table in tables:
            here = [w for w in wanted if forests[w[0]].samples[w[1]] in columns]
            size = 3 * max(forests[0].cells.sizes) * max((len(subset) for *_, subset in here), default=1)
            step = max(1, SUMS_PER_TASK // size)
            for some in (here[k : k + step] for k in range(0, len(here), step)):
                for (i, t, node, _), sums_ in zip(some, _sums_of_bins(forests, some, columns, table)):
                    found[i][t, node] = sums_
        for f, mine, own in zip(forests, nodes, found):
            f.split(mine, own)
            f.seconds += (time.monotonic() - started) * len(mine) / len(wanted)


def _sums_of_bins(forests: Sequence[Forest], nodes: Sequence[tuple], columns: Mapping[Sample, int], table: DataFrame) -> np.ndarray:
    """For each node (forest, tree, node, features) the sums by feature and bin: nodes x 3 x features x bins."""
    sizes = forests[0].cells.sizes
    shape = (len(nodes), 3, max(len(subset) for *_, subset in nodes), max(sizes))
    trees = {}
    for slot, (i, t, node, subset) in enumerate(nodes):
        trees.setdefault((i, t), []).append((node, slot, subset))
    jobs = [(forests[i].held_out, columns[forests[i].samples[t]], forests[i].trees[t].arrays(), mine) for (i, t), mine in trees.items()]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            of = {name: column.to_numpy(zero_copy_only=False) for name, column in zip(batch.schema.names, batch.columns)}
            all_bins = bins_of(of[CELL], sizes)
            for held_out, k, arrays, mine in jobs:
                rows = np.flatnonzero((of[FOLD] != held_out) & (of[f"n{k}"] > 0))
                bins = all_bins[:, rows]
                at = node_of(arrays, bins)
                place = np.full(len(arrays[0]), -1)
                place[[node for node, _, _ in mine]] = range(len(mine))
                at = place[at]
                kept = np.flatnonzero(at >= 0)
                at, bins, rows = at[kept], bins[:, kept], rows[kept]
                features = np.array([subset for *_, subset in mine])
                slots = np.array([slot for _, slot, _ in mine])
                for j in range(features.shape[1]):
                    index = at * shape[3] + bins[features[at, j], np.arange(len(at))]
                    for what, name in enumerate("nsq"):
                        own = np.bincount(index, of[f"{name}{k}"][rows], len(mine) * shape[3])
                        total[slots, what, j] += own.reshape(len(mine), shape[3])
        flat = total.ravel()
        places = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(flat[places])], ["place", "total"])

    found = table.mapInArrow(summed, "place bigint, total double").groupBy("place").agg(F.sum("total").alias("total")).toArrow()
    whole = np.zeros(shape)
    whole.ravel()[found["place"].to_numpy()] = found["total"].to_numpy()
    return whole


# --- fits and scores --------------------------------------------------------------


def on_points(estimator: Estimator, rows: float, n_points: int) -> Estimator:
    """The estimator for weighted points: how many of the rows a node needs becomes a share of the weight.

    The values of the points are bins already, all of which are kept: with so many bins Spark ML finds them from all points, not a part.
    """
    changes = {"labelCol": LABEL, "weightCol": WEIGHT, "minInstancesPerNode": 1, "maxBins": max(estimator.getMaxBins(), math.isqrt(n_points) + 1)}
    if estimator.getMinInstancesPerNode() > 1:
        changes["minWeightFractionPerNode"] = (estimator.getMinInstancesPerNode() - 0.5) / rows
    return estimator.copy({estimator.getParam(name): value for name, value in changes.items()})


def predicted(cells: Cells, table: DataFrame, models: Sequence[Sequence[Model | Forest]]) -> DataFrame:
    """(fold, cell, p0, p1, ...): predictions for the cells of each fold by the models that were fitted without it."""
    names = [f"p{i}" for i in range(len(models[0]))]
    schema = f"{FOLD} int, {CELL} bigint, " + ", ".join(f"{name} double" for name in names)
    return reduce(DataFrame.unionByName, [_predicted(cells, table.filter(F.col(FOLD) == k), mine, schema) for k, mine in enumerate(models)])


def _predicted(cells: Cells, found: DataFrame, models: Sequence[Model | Forest], schema: str) -> DataFrame:
    found = found.select(FOLD, CELL, cells.features())
    for i, model in enumerate(models):
        if not isinstance(model, Forest):
            named = model.copy()
            named.setPredictionCol(f"p{i}")
            found = named.transform(found)
    forests = {f"p{i}": [tree.arrays() for tree in model.trees] for i, model in enumerate(models) if isinstance(model, Forest)}
    sizes, mean, names = cells.sizes, cells.mean, [FOLD, CELL, *(f"p{i}" for i in range(len(models)))]

    def with_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = bins_of(batch.column(CELL).to_numpy(), sizes)
            own = {p: pa.array(mean + sum(a[3][node_of(a, bins)] for a in trees) / len(trees)) for p, trees in forests.items()}
            yield pa.RecordBatch.from_arrays([own[name] if name in own else batch.column(name) for name in names], names)

    found = found.drop("features")
    return found.mapInArrow(with_forests, schema) if forests else found.select(*names)


def scores(cells: Cells, predictions: DataFrame, count: int) -> list[list[dict]]:
    """The metrics of each fold and model over the rows themselves, one scan for all."""
    scored = cells.rows.join(predictions, [FOLD, CELL])
    each = F.inline(F.array(*(F.struct(F.lit(i).alias("trial"), F.col(f"p{i}").alias("p")) for i in range(count))))
    found = regression_metrics(scored.select(FOLD, LABEL, each), LABEL, "p", by=[FOLD, "trial"]).collect()  # a row for each fold and model
    by_place = {(r[FOLD], r["trial"]): {m: r[m] for m in ("n", *METRICS)} for r in found}
    return [[by_place.get((k, i), {"n": 0, **dict.fromkeys(METRICS)}) for i in range(count)] for k in range(cells.folds)]
