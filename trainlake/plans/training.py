"""Listing jobs: prepare, train with tracking, register, score.

    python -m trainlake.plans.training --listing housing --source <csv> --store <folder>
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.operators import automl, models, tune
from trainlake.operators.clean import clean_listing
from trainlake.operators.evaluate import feature_importance, regression_metrics
from trainlake.operators.features import Roles, column_roles
from trainlake.operators.impute import fit_imputation
from trainlake.operators.models import Fitted, fit_pipeline
from trainlake.operators.score import score
from trainlake.operators.split import bucket_folds, bucket_split, with_buckets
from trainlake.session import get_session, materialise
from trainlake.sources.listing import HOUSING, SHORT_STAY, ListingSpec, read_listing
from trainlake.tracking import registry, runs
from trainlake.tracking.runs import TableStore

EXPERIMENT = "listing_prices"
LISTINGS = {"housing": HOUSING, "short_stay": SHORT_STAY}

# The tuning ranges.
FOREST_GRID = {"maxDepth": [2, 5], "numTrees": [5, 10]}
FOREST_SPACE = {"maxDepth": tune.Quantised(2, 5), "numTrees": tune.Quantised(10, 100)}


@dataclass(frozen=True)
class Prepared:
    """Clean listing rows with a row key, their split, and the roles of the columns.

    on_unknown says what becomes of rows with a level that the training rows lack: "skip" drops them, "keep"
    counts them as one more level, so that columns such as addresses do not drop all rows.
    """

    parts: list[DataFrame]
    spec: ListingSpec
    roles: Roles
    key: str = "row_key"
    on_unknown: str = "skip"


def content_key(df: DataFrame) -> Column:
    """A hash of the whole row, for listings without a key of their own."""
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)


def stage_rows(
    raw: DataFrame, spec: ListingSpec, key: Column | None = None, seed: int = 42
) -> DataFrame:
    """Clean listing rows with a row_key and split buckets, written once.

    Every later pass (fill values, checks, each fit) reads this table, not the
    CSV text, and of it the columns and deciles it needs. Copies of a row without
    a key of its own share their key.
    """
    keyed = raw.withColumn("row_key", content_key(raw) if key is None else key)
    rows = with_buckets(clean_listing(keyed, spec, key=["row_key"]), F.col("row_key"), seed)
    return materialise(rows.hint("rebalance", "decile"), "listing", partition_by=["decile"])


def prepare(
    rows: DataFrame,
    spec: ListingSpec,
    weights: Sequence[float],
    strategy: str = "median",
    fit_scope: str = "train",
    relative_error: float | None = None,
    on_unknown: str = "skip",
) -> Prepared:
    """Split staged rows and impute.

    Fill values come from the first part, the training rows, unless fit_scope is
    "all".
    """
    parts = bucket_split(rows, weights)
    fit_rows = {"train": parts[0], "all": rows}[fit_scope]
    fill = fit_imputation(fit_rows, spec.impute, strategy, relative_error)
    filled = [fill.apply(part) for part in parts]
    roles = column_roles(filled[0], spec.label, exclude=["row_key", "bucket"])
    return Prepared(filled, spec, roles, on_unknown=on_unknown)


def _evaluate(fitted: Fitted, test: DataFrame, label: str) -> dict[str, float]:
    return _logged(regression_metrics(fitted.model.transform(test), label))


def _logged(metrics: DataFrame) -> dict[str, float]:
    """What is logged of test metrics; rows with unknown levels are not in n_test."""
    row = metrics.first()
    if not row["n"]:
        raise ValueError("no test row has levels known from the training rows")
    values = {"rmse": row["rmse"], "r2": row["r2"], "n_test": row["n"]}
    return {k: v for k, v in values.items() if v is not None}


def _log(
    store: TableStore, run_id: str, fitted: Fitted, metrics: dict, train: DataFrame, key: str,
    importance: bool = False,
) -> None:
    runs.log_metrics(store, run_id, metrics)
    runs.autolog(store, run_id, fitted.model)
    runs.log_model(store, run_id, fitted.model, runs.input_example(train, key))
    if importance:
        table = feature_importance(fitted.model, fitted.inputs, k=10)
        runs.log_table(store, run_id, table, "feature_importance")


def train_simple(store: TableStore, data: Prepared, algo: str, name: str, **params) -> str:
    """One estimator with given parameters; the run id."""
    make, one_hot = automl.FAMILIES[algo][0], algo in automl.LINEAR_FAMILIES
    train, test = data.parts
    run_id = runs.start_run(store, EXPERIMENT, name)
    fitted = fit_pipeline(train, data.roles, make(data.spec.label, **params), one_hot, on_unknown=data.on_unknown)
    runs.log_params(store, run_id, {"label": data.spec.label, "features": "all_features"})
    metrics = _evaluate(fitted, test, data.spec.label)
    _log(store, run_id, fitted, metrics, train, data.key, importance=not one_hot)
    return run_id


def train_forest_cv(store: TableStore, data: Prepared, folds: int = 3, scope: str = "estimator") -> str:
    """Forest with its grid cross-validated; the run id."""
    train, test = data.parts
    run_id = runs.start_run(store, EXPERIMENT, "forest_grid_cv")
    result = tune.grid_cv(
        bucket_folds(train, folds), data.roles, models.forest(data.spec.label),
        tune.grid(**FOREST_GRID), folds, scope=scope, on_unknown=data.on_unknown,
    )
    runs.log_params(store, run_id, {f"best.{k}": v for k, v in result.params.items()})
    runs.log_table(store, run_id, result.trials, "cv_trials")
    metrics = _evaluate(result.best, test, data.spec.label)
    _log(store, run_id, result.best, metrics, train, data.key, importance=True)
    return run_id


def train_forest_search(
    store: TableStore, data: Prepared, evaluations: int = 4, propose: str = "random"
) -> str:
    """Forest with a search on the validation rows, one run for each trial; the run id."""
    train, validation, test = data.parts
    result = tune.search_validated(
        train, validation, test, data.roles, models.forest(data.spec.label), FOREST_SPACE,
        evaluations, propose=propose, on_unknown=data.on_unknown,
    )
    for trial in result.trials.orderBy("trial_id").collect():  # one row for each evaluation
        trial_run = runs.start_run(store, EXPERIMENT, "forest_search_trial")
        runs.log_params(store, trial_run, trial["params"])
        runs.log_metrics(store, trial_run, {"rmse": trial["rmse"]})
    run_id = runs.start_run(store, EXPERIMENT, "forest_search")
    runs.log_params(store, run_id, {f"best.{k}": v for k, v in result.params.items()})
    metrics = _logged(result.test_metrics)
    _log(store, run_id, result.best, metrics, train, data.key, importance=True)
    return run_id


def train_automl(
    store: TableStore, data: Prepared, max_models: int = 10, folds: int = 3, sort_metric: str = "rmse"
) -> str:
    """Sweep over the tree families; the run id."""
    train, test = data.parts
    run_id = runs.start_run(store, EXPERIMENT, "automl")
    result = automl.sweep(
        bucket_folds(train, folds), data.roles, data.spec.label,
        max_models=max_models, folds=folds, sort_metric=sort_metric,
    )
    runs.log_table(store, run_id, result.leaderboard, "leaderboard")
    runs.log_params(store, run_id, {"best_model": result.best_id})
    _log(store, run_id, result.best, _evaluate(result.best, test, data.spec.label), train, data.key)
    return run_id


def register_in_stage(store: TableStore, run_id: str, name: str, stage: str) -> int:
    """Register the model of a run and move the version to a stage; the version."""
    version = registry.register(store, name, run_id)
    registry.transition(store, name, version, stage)
    return version


def score_with(store: TableStore, uri: str, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Score rows with the model that a name and stage stand for."""
    return score(registry.load_model(store, uri), rows, keep)


def run_all(
    spark: SparkSession, raw: DataFrame, spec: ListingSpec, root: str, key: Column | None = None, on_unknown: str = "keep"
) -> TableStore:
    """All training jobs one after the other, the searched forest going to production."""
    store = TableStore(spark, root)
    rows = stage_rows(raw, spec, key)
    halves = prepare(rows, spec, [0.8, 0.2], on_unknown=on_unknown)
    thirds = prepare(rows, spec, [0.6, 0.2, 0.2], on_unknown=on_unknown)
    linear_run = train_simple(store, halves, "linear", "linear")
    train_forest_cv(store, halves)
    searched_run = train_forest_search(store, thirds)
    train_automl(store, halves)
    register_in_stage(store, linear_run, "listing_linear", "Staging")
    register_in_stage(store, searched_run, "listing_forest", "Production")
    return store


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train models on a listing table.")
    parser.add_argument("--listing", choices=sorted(LISTINGS), default="housing")
    parser.add_argument("--source", required=True, help="path of the CSV listing")
    parser.add_argument("--store", required=True, help="folder for runs and models")
    parser.add_argument("--on-unknown", choices=("keep", "skip"), default="keep", help="rows with levels not seen in training")
    args = parser.parse_args(argv)
    spark = get_session("training")
    raw = read_listing(spark, args.source)
    run_all(spark, raw, LISTINGS[args.listing], args.store, on_unknown=args.on_unknown)


if __name__ == "__main__":
    main()
