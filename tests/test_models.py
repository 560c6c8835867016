import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tests.conftest import SMALL
from trainlake.catalog.metrics import signal
from trainlake.operators import automl, models, tune
from trainlake.operators.evaluate import (
    feature_importance, metrics_of, permutation_importance, regression_metrics, score_models,
)
from trainlake.operators.features import Roles, column_roles
from trainlake.operators.models import enough_bins, fit_features, fit_pipeline
from trainlake.operators.split import fold_column, hash_split
from trainlake.session import spread_rows

ROLES = Roles(("l_returnflag", "l_linestatus"), ("l_quantity", "l_discount"))


@pytest.fixture(scope="module")
def rows(spark):
    return fold_column(signal(spark, SMALL), F.col("row_key"), 3).cache()


def r2(fitted, test):
    return regression_metrics(fitted.model.transform(test), "y").first()["r2"]


def test_models_learn_the_signal(rows):
    train, test = hash_split(rows, F.col("row_key"), [0.8, 0.2])
    assert r2(fit_pipeline(train, ROLES, models.linear("y"), one_hot=True), test) > 0.999
    assert r2(fit_pipeline(train, ROLES, models.glm("y"), one_hot=True), test) > 0.999
    assert r2(fit_pipeline(train, ROLES, models.forest("y", numTrees=5)), test) > 0.8
    assert r2(fit_pipeline(train, ROLES, models.boosted("y", maxIter=5)), test) > 0.9


def test_bins_follow_the_widest_category(spark):
    df = spark.range(600).select((F.col("id") % 60).cast("string").alias("s"), F.col("id").cast("double").alias("y"))
    roles = column_roles(df, "y")
    features = fit_features(df, roles, one_hot=False)
    assert enough_bins(models.forest("y"), features.model).getMaxBins() == 61
    assert enough_bins(models.forest("y", maxBins=100), features.model).getMaxBins() == 100
    fit_pipeline(df, roles, models.forest("y", numTrees=2))


def test_classifier_gives_leaves_and_margins(rows):
    labelled = rows.withColumn("labels", (F.col("y") > 60).cast("double"))
    fitted = fit_pipeline(labelled, ROLES, models.boosted_classifier("labels"))
    assert fitted.model.stages[-1].getNumTrees == 10
    out = fitted.model.transform(labelled)
    assert {"rawPrediction", "leafPrediction"} <= set(out.columns)
    assert out.filter("prediction = labels").count() > 0.95 * out.count()


def test_metrics_skip_rows_without_prediction_and_flat_labels(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 1.0, 5.0), (1.0, None, 5.0)], "y double, p double, q double")
    found = metrics_of(df, "y", {"a": "p", "b": "q"})
    assert found["a"]["n"] == 2 and found["a"]["mae"] == 0.5 and found["a"]["r2"] is None
    assert found["b"]["n"] == 3 and found["b"]["rmse"] == 4.0


def test_variance_is_stable_for_large_labels(spark):
    df = spark.range(1000).select((F.lit(1e9) + F.col("id") % 2).alias("y"), F.lit(1e9 + 0.5).alias("p"))
    assert regression_metrics(df, "y", "p").first()["r2"] == pytest.approx(0.0, abs=1e-6)


def test_several_models_in_one_pass(rows):
    features = fit_features(rows, ROLES, one_hot=False)
    data = features.model.transform(rows).select("features", "y")
    fits = [models.tree("y", maxDepth=d).fit(data) for d in (1, 4)]
    both = score_models(fits, data, "y")
    alone = [regression_metrics(m.transform(data), "y").first()["rmse"] for m in fits]
    assert [m["rmse"] for m in both] == pytest.approx(alone)


def test_importance_finds_the_quantity(rows):
    fitted = fit_pipeline(rows, ROLES, models.forest("y", numTrees=5))
    top = feature_importance(fitted.model, fitted.inputs, k=2).collect()
    assert top[0].feature == "l_quantity" and len(top) == 2
    columns = [*ROLES.categorical, *ROLES.numeric]
    gain = permutation_importance(fitted.model, rows, "y", columns, F.col("row_key"), rows_per_bucket=500)
    by_feature = {r.feature: r.rmse_gain for r in gain.collect()}
    assert max(by_feature, key=by_feature.get) == "l_quantity"
    assert by_feature["l_quantity"] > 10 and abs(by_feature["l_linestatus"]) < 1


@pytest.mark.parametrize("scope", ["estimator", "pipeline"])
def test_grid_picks_the_deeper_tree(rows, scope):
    grid = tune.grid(maxDepth=[1, 4], minInstancesPerNode=[1])
    result = tune.grid_cv(rows, ROLES, models.tree("y"), grid, folds=3, scope=scope)
    assert result.params == {"maxDepth": 4, "minInstancesPerNode": 1}
    trials = result.trials.collect()
    assert len(trials) == 6 and sum(t.n for t in trials) == 2 * rows.count()
    assert tune.cv_summary(result.trials).columns == ["trial_id", "n_folds", "mean_rmse"]


def test_equal_trials_go_to_the_first(spark):
    rows = [{"trial_id": t, "fold": f, "n": 1, "rmse": 2.0, "mse": 4.0, "mae": 1.0, "r2": 0.0, "fit_seconds": 0.0}
            for t in (1, 0) for f in (0, 1)]
    assert tune.cv_summary(tune.trial_table(spark, rows)).first()["trial_id"] == 0


def test_grid_is_the_cross_product():
    assert tune.grid(a=[1, 2], b=[3, 4]) == [{"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]


def test_proposals_stay_in_their_range_and_repeat():
    space = {"d": tune.Quantised(2, 5), "t": tune.Quantised(10, 100, 5)}
    for how in ("random", lambda s, h, r: tune.propose_parzen(s, h, r, startup=3)):
        runs = [tune.search(lambda p: (p["d"] - 4) ** 2 + p["t"] / 100, space, 12, 42, how) for _ in range(2)]
        assert runs[0] == runs[1]
        for params, _ in runs[0]:
            assert params["d"] in (2, 3, 4, 5) and 10 <= params["t"] <= 100 and params["t"] % 5 == 0


def test_parzen_prefers_the_good_region():
    space = {"x": tune.Quantised(0, 100)}
    history = [({"x": float(v)}, abs(v - 80.0)) for v in range(0, 101, 4)]
    rng = random.Random(3)
    draws = [tune.propose_parzen(space, history, rng)["x"] for _ in range(50)]
    assert sum(60 <= d <= 100 for d in draws) > 40


def test_search_refits_the_best(rows):
    parts = hash_split(rows, F.col("row_key"), [0.6, 0.2, 0.2])
    space = {"maxDepth": tune.Quantised(1, 4), "numTrees": tune.Quantised(2, 4)}
    seen = []
    result = tune.search_validated(
        *parts, ROLES, models.forest("y"), space, evaluations=3, on_trial=lambda p, loss: seen.append(loss)
    )
    assert len(seen) == 3 == result.trials.count()
    assert result.params == min(result.trials.collect(), key=lambda t: t.rmse).params
    assert result.test_metrics.first()["n"] == parts[2].count()
    assert result.best.model.stages[-1].getNumTrees == result.params["numTrees"]


def test_candidates_go_round_the_families():
    for asked in (10, 25):
        found = automl.candidates("y", ["linear", "glm"], asked)
        assert len({c.model_id for c in found}) == asked
    ids = [c.model_id for c in automl.candidates("y", ["linear", "glm"], 4)]
    assert ids == ["boosted_1", "forest_1", "tree_1", "boosted_2"]
    with pytest.raises(ValueError, match="unknown families"):
        automl.candidates("y", ["deep"])


def test_sweep_ranks_linear_first_on_a_linear_label(rows):
    result = automl.sweep(rows, ROLES, "y", exclude=["boosted", "forest"], max_models=3, folds=2 + 1)
    board = result.leaderboard.collect()
    assert [b.rmse for b in board] == sorted(b.rmse for b in board) and len(board) == 3
    assert result.best_id == board[0].model_id and board[0].algo in ("linear", "glm")
    by_r2 = automl.leaderboard(result.leaderboard, "r2").first()["model_id"]
    assert by_r2 == result.best_id


@pytest.mark.parametrize("mode", ["skip", "keep"])
@pytest.mark.parametrize("others", [Roles(("a",), ()), Roles(("a", "b"), ("x", "z"))])
def test_a_wide_linear_model_has_no_slot_for_each_level(spark, tmp_path, monkeypatch, others, mode):
    a = F.when(F.col("id") % 50 != 7, (F.xxhash64("id") % 300).cast("string"))
    b, x, z = F.when(F.col("id") % 3 == 0, "u").otherwise("v"), (F.col("id") * F.col("id") % 17).cast("double"), (F.col("id") % 11).cast("double")
    rows = spark.range(2000).select("id", a.alias("a"), b.alias("b"), x.alias("x"), z.alias("z"))
    rows = rows.withColumn("y", F.coalesce(F.col("a").cast("double"), F.lit(5.0)) / 10 + 3 * F.col("x") - 2 * F.col("z") + (F.xxhash64("id", "x") % 100) / 100)
    linear = models.linear("y", tol=1e-13, maxIter=1000)
    fitted = fit_pipeline(rows, others, linear, one_hot=True, wide_levels=100, on_unknown=mode)
    scored = fitted.model.transform(rows)
    assert len(scored.schema["features"].metadata["ml_attr"].get("attrs", {}).get("binary", [])) <= 2
    fitted.model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model")).transform(rows)
    assert again.select("id", "prediction").exceptAll(scored.select("id", "prediction")).isEmpty()
    monkeypatch.setattr(models, "FEW_SLOTS", -1)  # all slots in one vector
    whole = fit_pipeline(rows, others, linear, one_hot=True, wide_levels=100, on_unknown=mode).model.transform(rows)
    both = scored.select("id", "prediction").join(whole.select("id", F.col("prediction").alias("p")), "id", "full")
    found = both.agg(F.count("prediction"), F.count("p"), F.max(F.abs(F.col("p") - F.col("prediction")))).first()
    assert found[0] == found[1] == (2000 if mode == "keep" else 1960) and found[2] < 1e-4


def test_fits_share_the_cluster_as_far_as_their_rows_stay_in_memory(spark):
    assert tune.fits_at_a_time(spark, 1000, 8) == 8 and tune.fits_at_a_time(spark, 0, 8) == 8
    assert tune.fits_at_a_time(spark, 10**12, 8) == 1


def test_rows_of_a_fit_are_spread_by_their_number(spark):
    few = spark.range(0, 1000, 1, 2)
    assert spread_rows(few, 1000) is few
    spread = spread_rows(few, 1000, most=100)
    assert max(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()) < 200 and spread.count() == 1000
