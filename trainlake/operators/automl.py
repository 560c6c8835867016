"""A sweep over candidate models with a leaderboard."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.operators import models
from trainlake.operators.evaluate import METRICS, SMALLER_IS_BETTER
from trainlake.operators.features import Roles
from trainlake.operators.models import Fitted, fit_features, fit_on_features, needed_by
from trainlake.operators.tune import PARALLELISM, cross_validate

# Tree ensembles first, as they win most often on tabular data; each family goes
# from its default to deeper and larger settings.
FAMILIES: dict[str, tuple[Callable[..., Estimator], tuple[dict, ...]]] = {
    "boosted": (models.boosted, ({"maxIter": 10}, {"maxIter": 20, "maxDepth": 3}, {"maxIter": 20, "stepSize": 0.3})),
    "forest": (models.forest, ({}, {"numTrees": 40}, {"numTrees": 20, "maxDepth": 8})),
    "tree": (models.tree, ({}, {"maxDepth": 3}, {"maxDepth": 8})),
    "linear": (models.linear, ({}, {"regParam": 0.1}, {"regParam": 0.1, "elasticNetParam": 0.5})),
    "glm": (models.glm, ({}, {"regParam": 0.1})),
}
LINEAR_FAMILIES = ("linear", "glm")


@dataclass(frozen=True)
class Candidate:
    model_id: str
    algo: str
    estimator: Estimator


def _drawn(algo: str, number: int) -> dict:
    """Settings number 1, 2, ... of a family beyond its listed ones: drawn, always the same."""
    draw = random.Random(f"{algo} {number}")
    if algo in LINEAR_FAMILIES:
        drawn = {"regParam": round(10 ** draw.uniform(-4, 1), 6)}
        return drawn | ({"elasticNetParam": round(draw.random(), 3)} if algo == "linear" else {})
    drawn = {"maxDepth": draw.randint(2, 10), "minInstancesPerNode": draw.randint(1, 20)}
    if algo == "forest":
        return drawn | {"numTrees": draw.randint(10, 100)}
    return drawn | ({"maxIter": draw.randint(5, 40), "stepSize": round(draw.uniform(0.05, 0.5), 3)} if algo == "boosted" else {})


def candidates(label: str, exclude: Sequence[str] = (), max_models: int = 10) -> list[Candidate]:
    """The first settings of each family, then the second ones, and so on; then seeded ones until there are enough."""
    unknown = set(exclude) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown families {sorted(unknown)}; known: {sorted(FAMILIES)}")

    def in_rounds() -> Iterator[Candidate]:
        for round_ in range(max(len(settings) for _, settings in FAMILIES.values())):
            for algo, (make, settings) in FAMILIES.items():
                if algo not in exclude and round_ < len(settings):
                    yield Candidate(f"{algo}_{round_ + 1}", algo, make(label, **settings[round_]))
        used = [algo for algo in FAMILIES if algo not in exclude]
        for more in itertools.count(1) if used else ():
            for algo in used:
                make, settings = FAMILIES[algo]
                yield Candidate(f"{algo}_{len(settings) + more}", algo, make(label, **_drawn(algo, more)))

    return [c for c, _ in zip(in_rounds(), range(max_models))]


@dataclass(frozen=True)
class SweepResult:
    """The leaderboard; `best` is fitted when it is first asked for."""

    refit: Callable[[], Fitted]
    best_id: str
    leaderboard: DataFrame

    @cached_property
    def best(self) -> Fitted:
        return self.refit()


def sweep(
    train: DataFrame,
    roles: Roles,
    label: str,
    exclude: Sequence[str] = LINEAR_FAMILIES,
    max_models: int = 10,
    sort_metric: str = "rmse",
    folds: int = 3,
    parallelism: int = PARALLELISM,
    **options,
) -> SweepResult:
    """Cross-validate the candidates over the fold column and refit the best.

    Levels unknown at fit time count as one more level, so no row is dropped.
    """
    options = {"on_unknown": "keep", **options}
    listed = candidates(label, exclude, max_models)
    if not listed:
        raise ValueError("no candidate is left")
    rows, features = [], {}
    for one_hot in (True, False):
        group = [c for c in listed if (c.algo in LINEAR_FAMILIES) == one_hot]
        if not group:
            continue
        features[one_hot] = fit_features(train, roles, one_hot, **{**needed_by(group[0].estimator), **options})
        trials = cross_validate(
            train, roles, [c.estimator for c in group], folds, one_hot,
            parallelism=parallelism, features=features[one_hot], **options,
        )
        for i, candidate in enumerate(group):
            mine = [t for t in trials if t["trial_id"] == i]
            means = [sum(t[m] for t in mine) / len(mine) for m in (*METRICS, "fit_seconds")]
            rows.append((candidate.model_id, candidate.algo, *means))
    schema = "model_id string, algo string, " + ", ".join(f"{m} double" for m in METRICS) + ", fit_seconds double"
    board = leaderboard(train.sparkSession.createDataFrame(rows, schema), sort_metric)
    best_id = board.first()["model_id"]
    winner = next(c for c in listed if c.model_id == best_id)
    refit = partial(fit_on_features, train, features[winner.algo in LINEAR_FAMILIES], winner.estimator)
    return SweepResult(refit, best_id, board)


def leaderboard(scores: DataFrame, sort_metric: str = "rmse") -> DataFrame:
    """Candidates, the best first."""
    order = F.asc(sort_metric) if SMALLER_IS_BETTER[sort_metric] else F.desc(sort_metric)
    return scores.orderBy(order, "model_id")
