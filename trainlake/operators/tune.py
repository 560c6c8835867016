"""Grid search by cross-validation, and sequential search."""

from __future__ import annotations

import itertools
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, partial
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.operators import cells
from trainlake.operators.evaluate import METRICS, SMALLER_IS_BETTER, regression_metrics, score_models
from trainlake.operators.features import Roles
from trainlake.operators.models import Fitted, enough_bins, fit_features, fit_on_features, fit_pipeline, needed_by, uses_label
from trainlake.operators.split import combine
from trainlake.session import discard, materialise, spread_rows

Params = Mapping[str, float]
FOLD = "fold"
#: Fits that share the cluster at a time.
PARALLELISM = 8


def grid(**values: Sequence) -> list[dict]:
    """Every combination of the values, the last name varying fastest."""
    return [dict(zip(values, combo)) for combo in itertools.product(*values.values())]


def with_params(estimator: Estimator, params: Params) -> Estimator:
    """A copy with the parameters set; whole floats are fine for integer parameters."""
    named = {estimator.getParam(name): value for name, value in params.items()}
    return estimator.copy({p: p.typeConverter(value) for p, value in named.items()})


def in_pool(spark: SparkSession, tasks: Sequence[Callable[[], object]], parallelism: int) -> list:
    """Results of tasks that start Spark jobs, in order; several share the cluster at a time, so that the short
    last stages of one do not leave it idle."""

    @inheritable_thread_target(spark)
    def run(task: Callable[[], object]) -> object:
        return task()

    if not tasks:
        return []
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(run, tasks, chunksize=1)


#: What a row takes while a fit of trees keeps it.
ROW_BYTES = 200


def fits_at_a_time(spark: SparkSession, rows: int, parallelism: int) -> int:
    """How many fits may share the cluster so that the rows each of them keeps stay in memory; one at least.

    Fits of many rows fill the cluster by themselves; together they would only push each other's rows to disk and read them back
    for each level of each tree.
    """
    status, memory = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), 0
    while status.hasNext():
        memory += int(status.next()._1())
    return max(1, min(parallelism, int(0.8 * memory // (ROW_BYTES * max(rows, 1)))))


def timed_fit(estimator: Estimator, rows: DataFrame) -> tuple[Model, float]:
    """The fitted model and the seconds it took."""
    started = time.monotonic()
    return estimator.fit(rows), time.monotonic() - started


# --- cross-validation ---------------------------------------------------------


def cross_validate(
    train: DataFrame,
    roles: Roles,
    estimators: Sequence[Estimator],
    folds: int,
    one_hot: bool = False,
    scope: str = "estimator",
    parallelism: int = PARALLELISM,
    fold: str = FOLD,
    features: Fitted | None = None,
    **options,
) -> list[dict]:
    """One row for each estimator and fold: trial_id, fold, n, the metrics, fit_seconds.

    `train` has its fold number in a column. With scope "estimator" the feature
    stages are fitted once, on all folds (or given, if they are already), unless they use the label; with
    "pipeline" again for each fold, without its rows. The feature rows are kept in memory or on local disk while
    the fits run. The fits of all folds share one pool, and one scan scores all models of a fold.
    """
    if scope not in ("estimator", "pipeline"):
        raise ValueError(f"scope is 'estimator' or 'pipeline', not {scope!r}")
    whole, label = train, estimators[0].getLabelCol()
    if scope == "pipeline":
        features = None
    else:
        features = features or fit_features(train, roles, one_hot, **{**needed_by(estimators[0]), **options})
    if features is not None and uses_label(features):
        features = None  # levels grouped by mean label would tell a fold's own labels
    if features is not None:
        estimators = [enough_bins(e, features.model) for e in estimators]
        found = cells.find_cells(train, features, estimators, folds, fold)
        if found is not None:
            return cross_validate_cells(found, estimators, parallelism)
        train = features.model.transform(train).select("features", label, fold)
    else:
        train = train.select(*dict.fromkeys([*roles.categorical, *roles.numeric, label, fold]))  # no more is kept
    spark, n = train.sparkSession, whole.count()
    train = spread_rows(train, n).persist(StorageLevel.MEMORY_AND_DISK)
    parallelism = fits_at_a_time(spark, n - n // max(folds, 1), parallelism)
    try:
        fit_rows, held_out = ([train.filter(how(F.col(fold), number)) for number in range(folds)] for how in (Column.__ne__, Column.__eq__))
        preps = [features] * folds
        if features is None:
            wanted = {**needed_by(estimators[0]), **options}
            preps = in_pool(spark, [partial(fit_features, rows, roles, one_hot, **wanted) for rows in fit_rows], parallelism)
            fit_rows, held_out = (
                [prep.model.transform(part).select("features", label) for prep, part in zip(preps, parts)] for parts in (fit_rows, held_out)
            )
        fits = in_pool(
            spark, [partial(timed_fit, enough_bins(e, preps[k].model), fit_rows[k]) for k in range(folds) for e in estimators], parallelism
        )
        by_fold = [fits[k * len(estimators) : (k + 1) * len(estimators)] for k in range(folds)]
        scores = in_pool(
            spark, [partial(score_models, [model for model, _ in mine], held_out[k], label) for k, mine in enumerate(by_fold)], parallelism
        )
    finally:
        train.unpersist()
    return [
        {"trial_id": trial, "fold": k, **scores[k][trial], "fit_seconds": seconds}
        for k, mine in enumerate(by_fold) for trial, (_, seconds) in enumerate(mine)
    ]


def cross_validate_cells(found: cells.Cells, estimators: Sequence[Estimator], parallelism: int = PARALLELISM) -> list[dict]:
    """cross_validate() of trees over the sums of cells: rows are read to sum them up and to score all models, however many fits there are."""
    spark, tables = found.rows.sparkSession, []
    try:
        tables = cells.sums(found, list(dict.fromkeys(sample for e in estimators for sample in cells.samples_of(e))))
        places = [(k, trial) for k in range(found.folds) for trial in range(len(estimators))]
        forests = {(k, trial): cells.Forest(spark, found, e, k) for k, trial in places if isinstance(e := estimators[trial], RandomForestRegressor)}
        tasks, rest = [partial(cells.grow, [*forests.values()], tables)], [p for p in places if p not in forests]
        if rest:
            columns, table = next((columns, table) for columns, table in tables if None in columns)
            sizes = {r[cells.FOLD]: r for r in table.groupBy(cells.FOLD).agg(F.sum("rows").alias("rows"), (2 * F.count(F.lit(1))).alias("points")).collect()}
            for k, trial in rest:
                rows, n_points = (sum(r[what] for f, r in sizes.items() if f != k) for what in ("rows", "points"))
                tasks.append(partial(timed_fit, cells.on_points(estimators[trial], rows, n_points), cells.points(found, table, columns[None], k)))
            parallelism = fits_at_a_time(spark, sum(r["points"] for r in sizes.values()), parallelism)
        fits = dict(zip(rest, in_pool(spark, tasks, parallelism)[1:])) | {p: (forest, forest.seconds) for p, forest in forests.items()}
        models = [[fits[k, trial][0] for trial in range(len(estimators))] for k in range(found.folds)]
        predictions = materialise(cells.predicted(found, tables[0][1], models), "predictions")
        scores = cells.scores(found, predictions, len(estimators))
        discard(predictions)
    finally:
        discard(found.rows, *(table for _, table in tables))
    return [{"trial_id": trial, "fold": k, **scores[k][trial], "fit_seconds": fits[k, trial][1]} for k, trial in places]


TRIAL_SCHEMA = "trial_id int, fold int, n bigint, " + ", ".join(
    f"{m} double" for m in (*METRICS, "fit_seconds")
)


def trial_table(spark: SparkSession, trials: Sequence[Mapping]) -> DataFrame:
    return spark.createDataFrame([dict(t) for t in trials], TRIAL_SCHEMA)


def cv_summary(trials: DataFrame, metric: str = "rmse", by: Sequence[str] = ("trial_id",)) -> DataFrame:
    """(by..., n_folds, mean_<metric>): the mean over folds, the best first, equals by trial."""
    mean = f"mean_{metric}"
    order = F.asc(mean) if SMALLER_IS_BETTER[metric] else F.desc(mean)
    return (
        trials.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_folds"), F.avg(metric).alias(mean))
        .orderBy(order, *by)
    )


@dataclass(frozen=True)
class GridResult:
    """The trials and the best parameters; `best` is fitted when it is first asked for."""

    refit: Callable[[], Fitted]
    params: Params
    trials: DataFrame

    @cached_property
    def best(self) -> Fitted:
        return self.refit()


def grid_cv(
    train: DataFrame,
    roles: Roles,
    estimator: Estimator,
    param_grid: Sequence[Params],
    folds: int = 3,
    metric: str = "rmse",
    one_hot: bool = False,
    scope: str = "estimator",
    parallelism: int = PARALLELISM,
    **options,
) -> GridResult:
    """The parameters with the best mean metric over the folds, refitted on all rows."""
    candidates = [with_params(estimator, p) for p in param_grid]
    features = fit_features(train, roles, one_hot, **{**needed_by(estimator), **options})
    rows = cross_validate(
        train, roles, candidates, folds, one_hot, scope, parallelism, features=features, **options
    )
    trials = trial_table(train.sparkSession, rows)
    best = cv_summary(trials, metric).first()["trial_id"]
    return GridResult(partial(fit_on_features, train, features, candidates[best]), param_grid[best], trials)


# --- sequential search --------------------------------------------------------


@dataclass(frozen=True)
class Quantised:
    """Evenly distributed over low..high, rounded to multiples of step."""

    low: float
    high: float
    step: float = 1.0

    def round(self, value: float) -> float:
        stepped = round(value / self.step) * self.step
        return min(max(stepped, self.low), self.high)

    def draw(self, rng: random.Random) -> float:
        return self.round(rng.uniform(self.low, self.high))


Space = Mapping[str, Quantised]
History = Sequence[tuple[Params, float]]


def propose_random(space: Space, history: History, rng: random.Random) -> dict:
    return {name: dim.draw(rng) for name, dim in space.items()}


def propose_parzen(
    space: Space, history: History, rng: random.Random,
    startup: int = 20, gamma: float = 0.25, candidates: int = 24,
) -> dict:
    """Tree-structured Parzen proposal (Bergstra et al. 2011), by dimension.

    The history is split into its best part and the rest; of some draws from a
    density over the best part, the one that part makes likeliest wins.
    """
    if len(history) < startup:
        return propose_random(space, history, rng)
    ordered = sorted(history, key=lambda trial: trial[1])
    cut = max(1, math.ceil(gamma * math.sqrt(len(ordered))))
    good, rest = ordered[:cut], ordered[cut:]
    chosen = {}
    for name, dim in space.items():
        near = [p[name] for p, _ in good]
        far = [p[name] for p, _ in rest]
        draws = [_draw_parzen(near, dim, rng) for _ in range(candidates)]
        chosen[name] = max(draws, key=lambda v: _density(v, near, dim) / _density(v, far, dim))
    return chosen


def _width(points: Sequence[float], dim: Quantised) -> float:
    return max((dim.high - dim.low) / (1 + len(points)), dim.step / 2)


def _draw_parzen(points: Sequence[float], dim: Quantised, rng: random.Random) -> float:
    """From the even prior or around one of the points, each as likely."""
    centre = rng.choice([None, *points])
    return dim.draw(rng) if centre is None else dim.round(rng.gauss(centre, _width(points, dim)))


def _density(value: float, points: Sequence[float], dim: Quantised) -> float:
    width = _width(points, dim)
    prior = 1 / (dim.high - dim.low)
    bells = [math.exp(-0.5 * ((value - p) / width) ** 2) / (width * math.sqrt(2 * math.pi)) for p in points]
    return (prior + sum(bells)) / (1 + len(points))


PROPOSERS = {"random": propose_random, "parzen": propose_parzen}


def search(
    objective: Callable[[Params], float],
    space: Space,
    evaluations: int = 4,
    seed: int = 42,
    propose: str | Callable[[Space, History, random.Random], dict] = "random",
) -> list[tuple[dict, float]]:
    """Evaluate proposals one after the other; the history in order.

    The proposals are a few numbers on the driver; the work is in the objective,
    which fits and scores with Spark.
    """
    proposer = PROPOSERS[propose] if isinstance(propose, str) else propose
    rng, history = random.Random(seed), []
    for _ in range(evaluations):
        params = proposer(space, history, rng)
        history.append((params, objective(params)))
    return history


def best_of(history: History) -> Params:
    """Parameters of the smallest loss, the first of equals."""
    return min(history, key=lambda trial: trial[1])[0]


@dataclass(frozen=True)
class SearchResult:
    """The trials and the best parameters; what follows from a refit is made when it is first asked for."""

    refit: Callable[[], tuple[Fitted, DataFrame]]
    params: Params
    trials: DataFrame

    @cached_property
    def _refitted(self) -> tuple[Fitted, DataFrame]:
        return self.refit()

    @property
    def best(self) -> Fitted:
        return self._refitted[0]

    @property
    def test_metrics(self) -> DataFrame:
        return self._refitted[1]


def search_validated(
    train: DataFrame,
    validation: DataFrame,
    test: DataFrame,
    roles: Roles,
    estimator: Estimator,
    space: Space,
    evaluations: int = 4,
    seed: int = 42,
    propose: str = "random",
    on_trial: Callable[[Params, float], None] | None = None,
    one_hot: bool = False,
    **options,
) -> SearchResult:
    """Search on the validation error; the best is refitted on both sets and tested once."""
    label = estimator.getLabelCol()
    features = fit_features(train, roles, one_hot, **{**needed_by(estimator), **options})
    fit_rows, held_out = (
        spread_rows(features.model.transform(rows).select("features", label), rows.count()).persist(StorageLevel.MEMORY_AND_DISK)
        for rows in (train, validation)
    )

    def objective(params: Params) -> float:
        model = enough_bins(with_params(estimator, params), features.model).fit(fit_rows)
        loss = score_models([model], held_out, label)[0]["rmse"]
        if on_trial:
            on_trial(params, loss)
        return loss

    try:
        history = search(objective, space, evaluations, seed, propose)
    finally:
        fit_rows.unpersist()
        held_out.unpersist()
    best = best_of(history)
    refit = partial(refit_best, train, validation, test, roles, with_params(estimator, best), one_hot, **options)
    trials = train.sparkSession.createDataFrame(
        [(i, {k: float(v) for k, v in p.items()}, loss) for i, (p, loss) in enumerate(history)],
        "trial_id int, params map<string,double>, rmse double",
    )
    return SearchResult(refit, best, trials)


def refit_best(
    train: DataFrame, validation: DataFrame, test: DataFrame, roles: Roles, estimator: Estimator,
    one_hot: bool = False, **options,
) -> tuple[Fitted, DataFrame]:
    """Fit on train and validation together; the metrics over the test rows."""
    fitted = fit_pipeline(combine(train, validation), roles, estimator, one_hot, **options)
    return fitted, regression_metrics(fitted.model.transform(test), estimator.getLabelCol())
