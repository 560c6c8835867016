import math

import pytest
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from trainlake.operators import automl, cells, models, tune
from trainlake.operators.features import Roles
from trainlake.operators.models import enough_bins, fit_features
from trainlake.operators.trees import node_table

ROLES = Roles(("a", "b"), ("x", "z"))
METRICS = ("n", "rmse", "mse", "mae", "r2")


@pytest.fixture(scope="module")
def rows(spark):
    """4,000 rows in 120 cells, with copies, and a label that is not the same in a cell."""
    key = F.col("id")
    hashed = [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(m)) for k, m in enumerate((3, 2, 5, 4, 100))]
    a, b, x, z, noise = hashed
    found = spark.range(4000).select(
        "id", F.concat(F.lit("a"), a).alias("a"), F.concat(F.lit("b"), b).alias("b"), (x * x).cast("double").alias("x"), z.cast("double").alias("z"),
        (key % 3).cast("int").alias("fold"), (x * x * 3 - z * (a + 1) * 2 + b * 5 + noise / 10).cast("double").alias("y"),
    )
    return found.cache()


def validated(rows, estimators, monkeypatch, few, **options):
    monkeypatch.setattr(cells, "FEW_ROWS", few)
    return tune.cross_validate(rows, ROLES, estimators, 3, **options)


def both(rows, estimators, monkeypatch, **options):
    """Trials by cells, and by Spark ML over the rows."""
    by_cells = validated(rows, estimators, monkeypatch, 0, **options)
    plain = validated(rows, estimators, monkeypatch, math.inf, **options)
    assert [(t["trial_id"], t["fold"]) for t in by_cells] == [(t["trial_id"], t["fold"]) for t in plain]
    return by_cells, plain


def assert_equal(by_cells, plain, rel=1e-9):
    for mine, theirs in zip(by_cells, plain):
        assert [mine[m] for m in METRICS] == pytest.approx([theirs[m] for m in METRICS], rel=rel)


@pytest.mark.parametrize("mode", ["skip", "keep"])
def test_trees_of_cells_are_those_of_the_rows(rows, monkeypatch, mode):
    listed = [models.tree("y", maxDepth=4), models.tree("y", minInstancesPerNode=200), models.tree("y", minInfoGain=2.0), models.boosted("y", maxIter=4, maxDepth=3)]
    some = rows.withColumn("a", F.when(F.col("id") % 40 != 7, F.col("a")))  # NULL levels are dropped or one more
    by_cells, plain = both(some, listed, monkeypatch, on_unknown=mode)
    assert_equal(by_cells, plain)
    assert sum(t["n"] for t in by_cells) == len(listed) * (4000 if mode == "keep" else 3900)


@pytest.mark.parametrize("subset", ["auto", "sqrt", "all"])
def test_forests_of_cells_draw_the_features_of_spark_ml(rows, monkeypatch, subset):
    forest = {"bootstrap": False, "featureSubsetStrategy": subset}
    listed = [models.forest("y", numTrees=7, maxDepth=4, **forest), models.forest("y", numTrees=1, maxDepth=3, **forest), models.forest("y", numTrees=3, maxDepth=2, minInstancesPerNode=300, **forest)]
    assert_equal(*both(rows, listed, monkeypatch))


def test_forests_of_cells_have_a_sample_of_the_rows_for_each_tree(rows, spark, monkeypatch):
    by_cells, plain = both(rows, [models.forest("y", numTrees=30, maxDepth=4)], monkeypatch)
    assert [t["rmse"] for t in by_cells] == pytest.approx([t["rmse"] for t in plain], rel=0.25)
    assert by_cells[0]["rmse"] != plain[0]["rmse"]
    w = [cells.poisson(F.col("id"), 42, k) for k in (0, 1)]
    drawn = spark.range(200_000).select(w[0].alias("v"), w[1].alias("w"))
    found = drawn.agg(F.avg("v"), F.var_samp("v"), F.avg(F.exp(-F.col("v"))), F.corr("v", "w")).first()
    assert found[:3] == pytest.approx((1, 1, math.exp(math.exp(-1) - 1)), rel=0.02) and abs(found[3]) < 0.01
    # many samples take several scans, and rows of a cell may have to be brought together; draws go by the order of files that are written again
    monkeypatch.setattr(cells, "SAMPLES_PER_SCAN", 7)
    monkeypatch.setattr(cells, "ROW_BYTES", 0)
    again = validated(rows, [models.forest("y", numTrees=30, maxDepth=4)], monkeypatch, 0)
    assert [t["n"] for t in again] == [t["n"] for t in by_cells]
    assert [t["rmse"] for t in again] == pytest.approx([t["rmse"] for t in by_cells], rel=0.25)


def test_no_fit_gets_more_than_two_points_for_each_cell(rows, monkeypatch):
    seen = []
    fit = tune.timed_fit
    monkeypatch.setattr(tune, "timed_fit", lambda e, points: seen.append(points.count()) or fit(e, points))
    monkeypatch.setattr(cells, "FEW_ROWS", 0)
    board = automl.sweep(rows, ROLES, "y", max_models=3, folds=3, on_unknown="skip").leaderboard.collect()
    assert {r.algo for r in board} == {"boosted", "forest", "tree"}
    assert len(seen) == 6 and max(seen) <= 2 * 2 * 120  # of 2,667 rows; forests are grown together
    grown = []
    grow = cells._sums_of_bins
    monkeypatch.setattr(cells, "_sums_of_bins", lambda *given: grown.append(given[3].count()) or grow(*given))
    result = tune.grid_cv(rows, ROLES, models.forest("y"), tune.grid(maxDepth=[2, 5], numTrees=[2, 3]), folds=3)
    assert result.trials.count() == 12 and result.params["maxDepth"] == 5
    assert len(grown) <= 5 and max(grown) <= 3 * 120  # a pass for each level, whatever the fits
    assert len(seen) == 6


def test_numbers_are_cut_as_spark_ml_cuts_them(spark):
    rows = spark.range(3000).select((F.xxhash64("id") % 1000 / 7).alias("x"), (F.xxhash64("id", "id") % 1000).cast("double").alias("y"))
    values = [r.x for r in rows.collect()]
    assert cells.thresholds([3.0, 1.0, 1.0, 2.0], 3) == [1.5, 2.5] and cells.thresholds([1.0], 3) == []
    cuts = cells.thresholds(values, 32)
    deep = fit_features(rows, Roles((), ("x",)), False)
    tree = DecisionTreeRegressor(labelCol="y", maxDepth=12, maxBins=32, minInstancesPerNode=1).fit(deep.model.transform(rows))
    used = {float(line.split("<=")[1].strip(" )")) for line in tree.toDebugString.splitlines() if "<=" in line}
    assert used == set(cuts) and len(cuts) in (30, 31)
    assert node_table(tree).count() == 2 * len(cuts) + 1


def test_a_value_that_equals_a_cut_is_below_it(rows, monkeypatch):
    monkeypatch.setattr(cells, "FEW_ROWS", 0)
    monkeypatch.setattr(cells, "thresholds", lambda values, bins: [4.0, 9.5])
    features = fit_features(rows, Roles((), ("x",)), False)
    found = cells.find_cells(rows, features, [models.tree("y")], 3, "fold")
    counts = {r[cells.CELL]: r["count"] for r in found.rows.groupBy(cells.CELL).count().collect()}
    assert counts == {0: rows.filter("x <= 4").count(), 1: rows.filter("x = 9").count(), 2: rows.filter("x = 16").count()}


def test_what_sums_of_cells_do_not_hold_is_left_to_spark_ml(rows, monkeypatch):
    monkeypatch.setattr(cells, "FEW_ROWS", 0)
    features = fit_features(rows, ROLES, False)

    def has_cells(rows, *estimators):
        return cells.find_cells(rows, features, [enough_bins(e, features.model) for e in estimators], 3, "fold") is not None

    assert has_cells(rows, models.tree("y"), models.forest("y"), models.boosted("y"))
    assert not has_cells(rows, models.boosted("y", lossType="absolute"))
    assert not has_cells(rows, models.forest("y", subsamplingRate=0.5))
    assert not has_cells(rows, models.tree("y", weightCol="x"))
    assert not has_cells(rows, models.linear("y"))
    assert not has_cells(rows.filter("id < 1000"), models.tree("y"))  # hardly more rows than cells
    assert not has_cells(rows.withColumn("y", F.when(F.col("id") != 5, F.col("y"))), models.tree("y"))
    assert not has_cells(rows.withColumn("x", F.when(F.col("id") == 5, math.inf).otherwise(F.col("x"))), models.tree("y"))
    monkeypatch.setattr(cells, "FEW_ROWS", 4001)
    assert not has_cells(rows, models.tree("y"))


def test_rows_of_no_fold_are_dropped_and_others_of_another_fold_stay_in_training(rows, monkeypatch):
    odd = rows.withColumn("fold", F.when(F.col("id") % 10 == 0, 7).when(F.col("id") % 10 != 1, F.col("fold")))
    assert_equal(*both(odd, [models.tree("y", maxDepth=3)], monkeypatch))


def test_a_grid_by_cells_has_the_trials_and_the_best_of_the_rows(rows, monkeypatch):
    found = []
    for few in (0, math.inf):
        monkeypatch.setattr(cells, "FEW_ROWS", few)
        result = tune.grid_cv(rows, ROLES, models.forest("y", bootstrap=False), tune.grid(maxDepth=[2, 5], numTrees=[2, 5]), folds=3)
        found.append((result.params, [tuple(r) for r in tune.cv_summary(result.trials).collect()]))
    assert result.best.model.stages[-1].getNumTrees == result.params["numTrees"]  # refitted on the rows
    assert found[0][0] == found[1][0] and [t[:2] for t in found[0][1]] == [t[:2] for t in found[1][1]]
    assert [t[2] for t in found[0][1]] == pytest.approx([t[2] for t in found[1][1]], rel=1e-9)
