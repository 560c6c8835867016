import random
from multiprocessing.pool import ThreadPool

import pytest
from pyspark import inheritable_thread_target
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from trainlake.operators.features import Roles
from trainlake.operators.models import fit_pipeline, linear
from trainlake.plans import training, trends
from trainlake.sources.listing import HOUSING, read_listing
from trainlake.streaming.score import read_stream, score_stream_registered
from trainlake.tracking import registry, runs
from trainlake.tracking.runs import TableStore


@pytest.fixture(scope="module")
def houses(spark, tmp_path_factory):
    rng = random.Random(5)
    lines = ["address,zip_code,city,price,living_area,plot_size,rooms"]
    for i in range(600):
        area, rooms = rng.randint(40, 200), rng.choice(["", 2, 3, 4])
        price = f'"${area * 3000:,.2f}"' if i % 50 else "on request"
        plot = "" if i % 10 == 0 else area * 2
        lines.append(f'"street {i}, no 1",{1000 + i % 30},{rng.choice(["Aa", "Bb", "Cc"])},{price},{area},{plot},{rooms}')
    path = tmp_path_factory.mktemp("csv") / "houses.csv"
    path.write_text("\n".join(lines) + "\n")
    return read_listing(spark, str(path))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_preparation_is_complete_and_fits_on_train_only(houses):
    rows = training.stage_rows(houses, HOUSING)
    assert rows.count() == 588
    data = training.prepare(rows, HOUSING, [0.8, 0.2])
    assert sum(p.count() for p in data.parts) == 588
    assert all(p.filter("rooms is null or plot_size is null").isEmpty() for p in data.parts)
    assert set(data.roles.categorical) == {"address", "city"}
    assert {"living_area", "rooms_na"} <= set(data.roles.numeric)
    assert data.roles.excluded["row_key"] == "on request"
    assert "PartitionFilters: [isnotnull(decile" in plan_of(data.parts[1])
    everything = training.prepare(rows, HOUSING, [0.8, 0.2], fit_scope="all", strategy="mean")
    assert sum(p.count() for p in everything.parts) == 588


def test_all_jobs_log_register_and_score(spark, houses, tmp_path, monkeypatch):
    monkeypatch.setattr(training, "FOREST_SPACE", {"maxDepth": training.tune.Quantised(2, 3)})
    monkeypatch.setattr(training, "FOREST_GRID", {"maxDepth": [2], "numTrees": [3, 5]})
    store = TableStore(spark, str(tmp_path / "store"))
    rows = training.stage_rows(houses.drop("address"), training.ListingSpec(
        keep=("city", "price", "living_area", "plot_size", "rooms"), impute=HOUSING.impute))
    spec = training.ListingSpec(keep=("city", "price", "living_area", "plot_size", "rooms"), impute=HOUSING.impute)
    halves, thirds = training.prepare(rows, spec, [0.8, 0.2]), training.prepare(rows, spec, [0.6, 0.2, 0.2])
    linear = training.train_simple(store, halves, "linear", "linear")
    training.train_forest_cv(store, halves, folds=2)
    searched = training.train_forest_search(store, thirds, evaluations=2)
    training.train_automl(store, halves, max_models=1, folds=2)
    assert training.register_in_stage(store, linear, "prices", "Staging") == 1
    assert training.register_in_stage(store, searched, "prices", "Production") == 2

    found = runs.search_runs(store.read("runs"), store.read("metrics"), store.read("params"), training.EXPERIMENT)
    by_name = {r.run_name: r for r in found.collect()}
    assert set(by_name) == {"linear", "forest_grid_cv", "forest_search_trial", "forest_search", "automl"}
    assert by_name["linear"]["metrics.r2"] > 0.99
    assert by_name["linear"]["metrics.n_test"] == halves.parts[1].count()
    assert by_name["forest_search"]["params.RandomForestRegressionModel.numTrees"] == "20"
    names = {r.name for r in store.read("artifacts").collect()}
    assert {"model", "model_input_example", "feature_importance", "cv_trials", "leaderboard"} <= names
    example = store.read("artifacts").filter("name = 'model_input_example'").first()["path"]
    assert spark.read.json(example).count() == 5

    test_rows = halves.parts[1]
    scored = training.score_with(store, "models:/prices/Production", test_rows, ["row_key"])
    assert scored.count() == test_rows.count()
    registry.transition(store, "prices", 2, "Archived")
    with pytest.raises(LookupError, match="Production"):
        registry.resolve(store, "models:/prices/Production")
    assert registry.resolve(store, "models:/prices/Staging").endswith(f"{linear}/model")


def test_all_jobs_as_configured_on_the_housing_layout(spark, houses, tmp_path):
    """Grid, space, models and folds as they are, with a column of addresses of which no test row's is known."""
    store = training.run_all(spark, houses.limit(250), HOUSING, str(tmp_path / "all"))
    found = runs.search_runs(store.read("runs"), store.read("metrics"), experiment=training.EXPERIMENT, metric_keys=["rmse", "r2", "n_test"]).collect()
    by_name = {r.run_name: r for r in found}
    assert set(by_name) == {"linear", "forest_grid_cv", "forest_search_trial", "forest_search", "automl"} and len(found) == 8
    assert all(r["metrics.n_test"] > 20 for name, r in by_name.items() if name != "forest_search_trial")
    leaderboard = store.read("artifacts").filter("name = 'leaderboard'").first()["path"]
    assert spark.read.parquet(leaderboard).count() == 10
    rows = training.prepare(training.stage_rows(houses, HOUSING), HOUSING, [1.0]).parts[0]
    assert training.score_with(store, "models:/listing_forest/Production", rows, ["row_key"]).count() == rows.count()


def test_registry_refuses_what_it_does_not_know(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "r"))
    with pytest.raises(LookupError):
        registry.resolve(store, "models:/forest/Production")
    with pytest.raises(ValueError, match="has no model"):
        registry.register(store, "m", "no-run")
    with pytest.raises(ValueError, match="unknown stage"):
        registry.transition(store, "m", 1, "Live")
    with pytest.raises(ValueError, match="no version"):
        registry.transition(store, "m", 1, "Staging")
    with pytest.raises(ValueError, match="models:/"):
        registry.parse_model_uri("runs:/x")


def test_later_values_and_stages_win(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "w"))
    run = runs.start_run(store, "e", "r")
    runs.log_metrics(store, run, {"rmse": 2.0})
    runs.log_metrics(store, run, {"rmse": 1.0, "r2": 0.5})
    row = runs.search_runs(store.read("runs"), store.read("metrics")).first()
    assert row["metrics.rmse"] == 1.0 and row["metrics.r2"] == 0.5
    assert runs.list_experiments(store.read("runs")).first()["n_runs"] == 1


def test_several_writers_get_versions_of_their_own(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "writers"))
    found = [runs.start_run(store, "e", str(i)) for i in range(4)]
    store.append("artifacts", [(run, "model", "model", f"path of {run}", runs.now()) for run in found])
    with ThreadPool(4) as pool:
        versions = pool.map(inheritable_thread_target(spark)(lambda run: registry.register(store, "m", run)), found)
    assert sorted(versions) == [1, 2, 3, 4]
    rows = store.read("model_versions").collect()
    assert {(r.version, r.run_id) for r in rows} == set(zip(versions, found))
    assert registry.register(store, "other/name", found[0]) == 1 and registry.register(store, "m", found[0]) == 5


def test_event_numbers_rise_and_break_ties(spark):
    with ThreadPool(8) as pool:
        numbers = pool.map(lambda _: runs.next_event(), range(2000))
    assert len(set(numbers)) == 2000
    events = spark.createDataFrame([("m", 1, s, None, e) for e, s in ((5, "Staging"), (7, "Archived"), (6, "Production"))] + [("m", 2, "None", None, 1)], runs.SCHEMAS["stage_events"])
    assert {tuple(r) for r in registry.current_stages(events).collect()} == {("m", 1, "Archived"), ("m", 2, "None")}


def test_last_values_need_no_sorted_aggregate(spark):
    logged = spark.createDataFrame([("r", k, v, None, e) for e, (k, v) in enumerate([("a", 1.0), ("b", 5.0), ("a", 3.0), ("a", 2.0)])], runs.SCHEMAS["metrics"])
    params = logged.withColumn("value", F.col("value").cast("string"))
    found = runs.search_runs(spark.createDataFrame([("r", "e", "", None), ("s", "e", "", None)], runs.SCHEMAS["runs"]), logged, params)
    assert {tuple(r)[4:] for r in found.collect()} == {(2.0, 5.0, "2.0", "5.0"), (None,) * 4}
    events = spark.createDataFrame([], runs.SCHEMAS["stage_events"])
    for df in (found, registry.current_stages(events), registry.resolve_all(events)):
        assert "SortAggregate" not in plan_of(df)
    with pytest.raises(ValueError, match="more than 1 "):
        runs.logged_keys(logged, most=1)


def test_stream_follows_the_registry(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, y double")
    for factor in (1, 10):
        run_id = runs.start_run(store, "e")
        runs.log_model(store, run_id, fit_pipeline(df.withColumn("y", F.col("y") * factor), Roles((), ("x",)), linear("y")).model)
        registry.register(store, "m", run_id)
    source, out, progress = (str(tmp_path / n) for n in ("source", "out", "progress"))

    def batch(x):
        spark.createDataFrame([(x,)], "x double").write.mode("append").parquet(source)
        stream = read_stream(spark, source, "x double")
        score_stream_registered(store, "models:/m/Production", stream, ["x"], out, progress).awaitTermination()

    registry.transition(store, "m", 1, "Production")
    batch(3.0)
    registry.transition(store, "m", 2, "Production")
    batch(4.0)
    registry.transition(store, "m", 2, "Archived")
    batch(5.0)
    found = {r.x: (r.prediction, r.batch) for r in spark.read.parquet(out).collect()}
    assert {x: round(p) for x, (p, _) in found.items()} == {3.0: 6, 4.0: 80, 5.0: 10}
    assert sorted(b for _, b in found.values()) == [0, 1, 2]


def test_stage_parameters(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double")
    fitted = fit_pipeline(df, Roles((), ("x",)), DecisionTreeRegressor(labelCol="y", maxDepth=3))
    params = runs.stage_params(fitted.model.stages)
    assert params["DecisionTreeRegressionModel.maxDepth"] == "3"


def test_trend_job(spark, tmp_path):
    (tmp_path / "docs.json").write_text('{"text": "Spark lakes"}\n{"text": "spark http://x.y"}\n{"other": 1}\n')
    out = trends.run_trends(spark, "Sample.json", str(tmp_path / "docs.json"), str(tmp_path / "out"))
    assert out.endswith("trends-sample")
    assert [(r.word, r["count"]) for r in spark.read.parquet(out).orderBy("word").collect()] == [("lakes", 1), ("spark", 2)]
    with pytest.raises(ValueError):
        trends.run_trends(spark, "unknown", str(tmp_path), str(tmp_path))
