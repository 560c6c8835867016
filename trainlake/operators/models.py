"""Pipelines over Spark ML: features from roles, then an estimator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.operators.features import Roles, fit_groups, fit_index
from trainlake.operators.wide import IndexLookup, fit_wide_linear
from trainlake.session import ensure_checkpoint_dir, materialise, spread_rows

SEED = 42
MAX_BINS = 40
#: Columns with more levels are looked up in an index table; others are indexed by Spark ML, which holds levels on the driver.
WIDE_LEVELS = 10_000
#: A linear model of one wide column is solved apart from its levels if its other features have no more slots.
FEW_SLOTS = 100


# --- estimators --------------------------------------------------------------


def linear(label: str, **params) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol="features", **params)


def glm(label: str, **params) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(labelCol=label, featuresCol="features", **params)


def tree(label: str, **params) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, **{"maxBins": MAX_BINS, "seed": SEED, **params})


def forest(label: str, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, **{"maxBins": MAX_BINS, "seed": SEED, **params})


def boosted(label: str, **params) -> GBTRegressor:
    return GBTRegressor(labelCol=label, **{"maxBins": MAX_BINS, "seed": SEED, **params})


def boosted_classifier(label: str, **params) -> GBTClassifier:
    """Binary; ten rounds of trees with up to eight leaves, leaf numbers as output."""
    settings = {"maxIter": 10, "maxDepth": 3, "leafCol": "leafPrediction", "maxBins": MAX_BINS, "seed": SEED}
    return GBTClassifier(labelCol=label, **{**settings, **params})


#: Their fits keep all rows as objects in memory or on local disk.
HELD_IN_MEMORY = (DecisionTreeRegressor, RandomForestRegressor, GBTRegressor, GBTClassifier)


# --- features ----------------------------------------------------------------


def preflight(train: DataFrame, roles: Roles, on_null: str = "error") -> dict[str, int]:
    """Check the features in one pass before anything is fitted; about how many levels each string column has.

    Raises for features with missing numbers, unless on_null says what to do with
    them. No column is left out unasked: name it in ``column_roles(exclude=...)``.
    """
    checks = [F.approx_count_distinct(c).alias(f"levels_{i}") for i, c in enumerate(roles.categorical)]
    checks += [
        F.count_if(F.col(c).isNull() | F.isnan(c)).alias(f"nulls_{i}")
        for i, c in enumerate(roles.numeric)
    ]
    if not checks:
        raise ValueError("no feature columns")
    row = train.agg(F.count(F.lit(1)).alias("n"), *checks).first()
    holes = [c for i, c in enumerate(roles.numeric) if row[f"nulls_{i}"]]
    if holes and on_null == "error":
        raise ValueError(f"feature columns with missing values: {holes}; impute them or set on_null")
    return {c: row[f"levels_{i}"] for i, c in enumerate(roles.categorical)}


def feature_stages(
    roles: Roles, one_hot: bool, on_unknown: str = "skip", on_null: str = "error", suffix: str = "Index",
    lookup: IndexLookup | None = None,
) -> tuple[list[Estimator | Transformer], list[str]]:
    """Indexer, encoder for one-hot, assembler; and the assembler's inputs.

    The columns of a lookup stage are indexed by it. Their one-hot form has a slot for the last level, too: which level is
    the last means nothing among many, and a solver for many slots gets on better without that gap.
    """
    stages: list[Estimator | Transformer] = []
    wide = lookup.columns if lookup else []
    narrow = [c for c in roles.categorical if c not in wide]
    inputs = [c + suffix for c in roles.categorical]
    if narrow:
        indexed = [c + suffix for c in narrow]
        stages.append(StringIndexer(inputCols=narrow, outputCols=indexed, handleInvalid=on_unknown))
    if lookup:
        stages.append(lookup)
    if one_hot:
        for some, drop_last in ((narrow, True), (wide, False)):
            if some:
                indexed, encoded = [c + suffix for c in some], [c + "OHE" for c in some]
                stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=drop_last))
        inputs = [c + "OHE" for c in roles.categorical]
    inputs = inputs + list(roles.numeric)
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid=on_null))
    return stages, inputs


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, the roles it uses and the columns its features come from."""

    model: PipelineModel
    roles: Roles
    inputs: tuple[str, ...]


def fit_features(
    train: DataFrame, roles: Roles, one_hot: bool, wide_levels: int | None = None,
    on_unknown: str = "skip", on_null: str = "error", label: str | None = None, bins: int = MAX_BINS,
) -> Fitted:
    """Fit the feature stages only.

    String columns with more than wide_levels levels (WIDE_LEVELS, for trees with a label as many as there are bins) are looked up in an index table, which no machine holds whole. For
    trees (not one_hot) with a label their levels are ordered by mean label and cut into at most `bins` groups, so that no tree needs a
    bin for each level.
    """
    levels = preflight(train, roles, on_null)
    # Of a tree's bins, one is left for levels that are not known.
    groups = None if one_hot or label is None else max(2, bins - (on_unknown == "keep"))
    if wide_levels is None:
        wide_levels = groups or WIDE_LEVELS
    wide, lookup = [c for c in roles.categorical if levels[c] > wide_levels], None
    if wide:
        index = fit_groups(train, wide, label, groups) if groups else fit_index(train, wide)
        lookup = IndexLookup(index, wide, on_unknown=on_unknown)
    stages, inputs = feature_stages(roles, one_hot, on_unknown, on_null, lookup=lookup)
    return Fitted(Pipeline(stages=stages).fit(train), roles, tuple(inputs))


def uses_label(features: Fitted) -> bool:
    """Whether the features were fitted to the label, so that rows to be tested on must not have taken part."""
    return any(isinstance(stage, IndexLookup) and stage.index.rank != "idx" for stage in features.model.stages)


def needed_by(estimator: Estimator) -> dict:
    """What fit_features() should know of the estimator that comes behind."""
    bins = {"bins": estimator.getOrDefault("maxBins")} if estimator.hasParam("maxBins") else {}
    return {"label": estimator.getLabelCol(), **bins}


def enough_bins(estimator: Estimator, features: PipelineModel) -> Estimator:
    """Trees need a bin for each level of their widest category that is not grouped."""
    if not estimator.hasParam("maxBins"):
        return estimator
    levels = [
        len(labels) + 1
        for stage in features.stages
        if isinstance(stage, StringIndexerModel)
        for labels in stage.labelsArray
    ]
    levels += [stage.n_values(c) for stage in features.stages if isinstance(stage, IndexLookup) for c in stage.columns]
    needed = max([estimator.getOrDefault("maxBins"), *levels])
    return estimator.copy({estimator.getParam("maxBins"): needed})


def fit_pipeline(
    train: DataFrame, roles: Roles, estimator: Estimator, one_hot: bool = False, **options
) -> Fitted:
    """Fit features and estimator on the training rows.

    Plain least squares over one wide column and a few other slots has a solution that holds a level's slot nowhere but in
    a table; all other estimators get the features as fit_features() makes them.
    """
    if one_hot and plain_least_squares(estimator):
        levels = preflight(train, roles, options.get("on_null", "error"))
        limit = options.get("wide_levels")
        wide = [c for c in roles.categorical if levels[c] > (WIDE_LEVELS if limit is None else limit)]
        narrow = [c for c in roles.categorical if c not in wide]
        if len(wide) == 1 and sum(levels[c] for c in narrow) + len(roles.numeric) <= FEW_SLOTS:
            return _fit_apart(train, roles, narrow, wide[0], estimator, options.get("on_unknown", "skip"), options.get("on_null", "error"))
    features = fit_features(train, roles, one_hot, **{**needed_by(estimator), **options})
    return fit_on_features(train, features, estimator)


def plain_least_squares(estimator: Estimator) -> bool:
    """Whether it is a linear model without penalties, weights or another loss."""
    return (
        isinstance(estimator, LinearRegression) and not estimator.getRegParam()
        and estimator.getLoss() == "squaredError" and not estimator.isSet("weightCol")
    )


def _fit_apart(
    train: DataFrame, roles: Roles, narrow: list[str], wide: str, estimator: LinearRegression, on_unknown: str, on_null: str
) -> Fitted:
    """Features of all columns but the wide one, and a model with an effect for each of its levels."""
    others = Roles(tuple(narrow), roles.numeric, roles.excluded)
    stages, inputs = feature_stages(others, True, on_unknown, on_null)
    features = Pipeline(stages=stages).fit(train)
    rows = features.transform(train).select(wide, "features", estimator.getLabelCol())
    model = fit_wide_linear(rows, wide, estimator, on_unknown)
    return Fitted(PipelineModel([*features.stages, model]), roles, tuple(inputs))


def fit_on_features(train: DataFrame, features: Fitted, estimator: Estimator) -> Fitted:
    """Fit an estimator behind fitted feature stages."""
    if isinstance(estimator, (GBTRegressor, GBTClassifier)):
        ensure_checkpoint_dir(train.sparkSession)  # boosting cuts its lineage every few rounds
    label = estimator.getLabelCol()
    rows = features.model.transform(train).select("features", label)
    if any(isinstance(stage, IndexLookup) for stage in features.model.stages):
        rows = materialise(rows, "feature-rows")  # looked up once, not for each pass of the fit
        rows = spread_rows(rows, rows.count())
    elif isinstance(estimator, HELD_IN_MEMORY):
        rows = spread_rows(rows, train.count())
    model = enough_bins(estimator, features.model).fit(rows)
    stages = [*features.model.stages, model]
    return Fitted(PipelineModel(stages), features.roles, features.inputs)

