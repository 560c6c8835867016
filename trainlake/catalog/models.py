"""Tree models, tuning, sweeps and scoring.

A single unsampled tree deep enough to separate all levels of its one category
predicts the mean label of each level. That gives SQL to check the ensembles,
the cross-validation and the scoring against; the other queries have none.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, table
from trainlake.catalog.listing import KEY, SPEC, raw_listing
from trainlake.catalog.metrics import LABEL, rounded, signal, sql_fold_means, sql_metrics
from trainlake.catalog.splits import SQL_BUCKET, SQL_KEY, keyed_lines
from trainlake.functions.buckets import row_key
from trainlake.operators import automl, boosting, models, trees, tune
from trainlake.operators.evaluate import feature_importance, permutation_importance, regression_metrics
from trainlake.operators.features import Roles, fit_groups
from trainlake.operators.models import Fitted, fit_pipeline
from trainlake.operators.score import score
from trainlake.operators.split import bucket_folds, bucket_split, fold_column, with_buckets
from trainlake.plans import training
from trainlake.session import materialise, scratch_path
from trainlake.sources.listing import ListingSpec
from trainlake.streaming.score import read_stream, score_stream, score_stream_registered
from trainlake.tracking import registry, runs
from trainlake.tracking.runs import TableStore

QUERIES = Queries()
ORACLES: dict[str, str] = {}

FLAG = Roles(("l_returnflag",), ())
FEATURES = Roles(("l_returnflag", "l_linestatus"), ("l_quantity", "l_discount", "l_tax"))

SQL_FLAG_MEAN = (
    "SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key, "
    f"round(avg({LABEL}) OVER (PARTITION BY l_returnflag), 3) AS prediction FROM lineitem"
)


def staged_signal(spark: SparkSession, sf: str) -> DataFrame:
    """The rows with a learnable label, written once: fits read them many times."""
    keyed = with_buckets(signal(spark, sf), F.col("row_key"))
    return materialise(keyed.hint("rebalance", "decile"), "signal", partition_by=["decile"])


def staged_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Key, flag and price of the order lines, written once."""
    return materialise(keyed_lines(spark, sf).select("row_key", "l_returnflag", LABEL), "prices")


def _flag_scores(rows: DataFrame, estimator) -> DataFrame:
    fitted = fit_pipeline(rows, FLAG, estimator)
    return score(fitted.model, rows, ["row_key"]).withColumn("prediction", F.round("prediction", 3))


def one_tree(label: str):
    """A forest of one tree over all rows."""
    return models.forest(label, numTrees=1, maxDepth=2, bootstrap=False)


@QUERIES
def forest_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    """A forest of one tree predicts the means of its category."""
    return _flag_scores(staged_prices(spark, sf), one_tree(LABEL))


@QUERIES
def boosted_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    """So does boosting, whose further trees find no error left."""
    return _flag_scores(staged_prices(spark, sf), models.boosted(LABEL, maxIter=2, maxDepth=2))


ORACLES["forest_group_mean"] = ORACLES["boosted_group_mean"] = SQL_FLAG_MEAN


GROUPS = 8
ORDERS = Roles(("l_orderkey",), ())


def staged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their order as a category of very many levels, and a label of whole numbers, written once."""
    lines = keyed_lines(spark, sf).select("row_key", F.col("l_orderkey").cast("string").alias("l_orderkey"), "l_quantity")
    return materialise(lines, "orders")


def _order_scores(spark: SparkSession, sf: str, estimator, one_hot: bool = False) -> DataFrame:
    rows = staged_orders(spark, sf)
    fitted = fit_pipeline(rows, ORDERS, estimator, one_hot, wide_levels=100)
    return score(fitted.model, rows, ["row_key"]).withColumn("prediction", F.round("prediction", 4))


@QUERIES
def grouped_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by mean quantity, cut into groups of about as many lines."""
    index = fit_groups(staged_orders(spark, sf), ["l_orderkey"], "l_quantity", GROUPS, window_rows=100, partitions=8)
    return index.table.select("level", "freq", F.col("idx").alias("grp"))


SQL_GROUPS = (
    "SELECT level, freq, coalesce(sum(freq) OVER (ORDER BY m, level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
    f"* {GROUPS} // sum(freq) OVER () AS grp FROM (SELECT CAST(l_orderkey AS VARCHAR) AS level, count(*) AS freq, avg(l_quantity) AS m FROM lineitem GROUP BY 1)"
)
ORACLES["grouped_levels"] = f"SELECT level, freq, CAST(grp AS BIGINT) AS grp FROM ({SQL_GROUPS})"


@QUERIES
def forest_wide_category(spark: SparkSession, sf: str) -> DataFrame:
    """A tree over a category of more levels than bins predicts the means of its groups."""
    return _order_scores(spark, sf, models.forest("l_quantity", numTrees=1, maxDepth=7, maxBins=GROUPS, bootstrap=False))


@QUERIES
def boosted_wide_category(spark: SparkSession, sf: str) -> DataFrame:
    """So does boosting."""
    return _order_scores(spark, sf, models.boosted("l_quantity", maxIter=2, maxDepth=7, maxBins=GROUPS))


ORACLES["forest_wide_category"] = ORACLES["boosted_wide_category"] = (
    f"SELECT {SQL_KEY} AS row_key, round(avg(l_quantity) OVER (PARTITION BY grp), 4) AS prediction "
    f"FROM lineitem JOIN ({SQL_GROUPS}) ON level = CAST(l_orderkey AS VARCHAR)"
)


@QUERIES
def linear_wide_category(spark: SparkSession, sf: str) -> DataFrame:
    """A linear fit with a slot for each of very many levels gives the mean of each level."""
    return _order_scores(spark, sf, models.linear("l_quantity", tol=1e-12, maxIter=500), one_hot=True)


ORACLES["linear_wide_category"] = (
    f"SELECT {SQL_KEY} AS row_key, round(avg(l_quantity) OVER (PARTITION BY l_orderkey), 4) AS prediction FROM lineitem"
)


@QUERIES
def classifier_group_odds(spark: SparkSession, sf: str) -> DataFrame:
    """The first round of boosting tells the share of good documents by language."""
    rows = (
        table(spark, sf, "documents")
        .select("doc_id", "lang")
        .join(table(spark, sf, "labels"), "doc_id")
        .withColumn("labels", F.col("quality").cast("double"))
    )
    fitted = fit_pipeline(rows, Roles(("lang",), ()), models.boosted_classifier("labels", maxIter=1))
    margin = vector_to_array("rawPrediction")[1]
    return fitted.model.transform(rows).select(
        "doc_id", F.round(margin, 6).alias("margin"), F.col("prediction").cast("int").alias("prediction")
    )


ORACLES["classifier_group_odds"] = (
    "SELECT d.doc_id, round(avg(2.0::DOUBLE * quality - 1) OVER (PARTITION BY lang), 6) AS margin, "
    "CAST(avg(2.0::DOUBLE * quality - 1) OVER (PARTITION BY lang) > 0 AS INT) AS prediction "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
)


BANDS = Roles(("status", "band"), ())
SQL_BANDS = (
    f"(SELECT {SQL_KEY} AS row_key, l_linestatus AS status, CASE WHEN l_extendedprice > 30000 THEN 'dear' ELSE 'cheap' END AS band, "
    "CAST(l_quantity > 25 AS DOUBLE) AS labels, l_quantity AS y FROM lineitem)"
)


def staged_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with two categories of two levels, a class and a number to predict, written once."""
    band = F.when(F.col("l_extendedprice") > 30000, "dear").otherwise("cheap").alias("band")
    labels = (F.col("l_quantity") > 25).cast("double").alias("labels")
    return materialise(keyed_lines(spark, sf).select("row_key", F.col("l_linestatus").alias("status"), band, labels, F.col("l_quantity").alias("y")), "bands")


@QUERIES
def leafwise_two_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Ten rounds of trees with up to five leaves; margin and class of each line."""
    rows = staged_bands(spark, sf)
    scored = boosting.fit_leafwise(rows, BANDS, "labels", least_rows=1).transform(rows)
    return scored.select("row_key", F.round("rawPrediction", 6).alias("margin"), F.col("prediction").cast("int").alias("prediction"))


def _sql_rounds(cell: str) -> str:
    """Margins of the cells after each round; in each, every cell is a leaf and steps by its own gradient."""
    return (
        "WITH RECURSIVE c AS (SELECT " + cell + f" AS cell, avg(labels) AS y FROM {SQL_BANDS} GROUP BY ALL), "
        f"m AS (SELECT cell, y, 0 AS k, ln((SELECT avg(labels) FROM {SQL_BANDS}) / (1 - (SELECT avg(labels) FROM {SQL_BANDS}))) AS s FROM c "
        "UNION ALL SELECT cell, y, k + 1, s + 0.1 * (y - p) / (p * (1 - p)) FROM (SELECT *, 1 / (1 + exp(-s)) AS p FROM m WHERE k < 10)) "
    )


ORACLES["leafwise_two_categories"] = (
    _sql_rounds("status || band") + "SELECT row_key, round(s, 6) AS margin, CAST(s > 0 AS INT) AS prediction "
    f"FROM {SQL_BANDS} JOIN m ON cell = status || band WHERE k = 10"
)


@QUERIES
def leafwise_leaves(spark: SparkSession, sf: str) -> DataFrame:
    """One category of two levels: margin, leaf of each of ten trees, and the category's part."""
    rows = staged_bands(spark, sf)
    scored = boosting.fit_leafwise(rows, Roles(("band",), ()), "labels").transform(rows)
    return scored.select(
        "row_key", F.round("rawPrediction", 6).alias("margin"), F.array_join(F.col("leafPrediction").cast("array<string>"), ",").alias("leaves"),
        F.round(F.col("contributions.bandIndex") + F.col("base"), 6).alias("explained"),
    )


# The level with more ones steps up, has the smaller gradient and is the left leaf.
ORACLES["leafwise_leaves"] = (
    _sql_rounds("band") + "SELECT row_key, round(s, 6) AS margin, "
    "rtrim(repeat(CASE WHEN m.y = (SELECT max(y) FROM c) THEN '0,' ELSE '1,' END, 10), ',') AS leaves, round(s, 6) AS explained "
    f"FROM {SQL_BANDS} JOIN m ON cell = band WHERE k = 10"
)


def _two_level_tree(rows: DataFrame) -> Fitted:
    return fit_pipeline(rows, BANDS, models.forest("y", numTrees=1, maxDepth=2, bootstrap=False))


@QUERIES
def importance_two_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of the variance that two categories explain, from the table of nodes."""
    fitted = _two_level_tree(staged_bands(spark, sf))
    found = trees.importance(trees.node_table(fitted.model.stages[-1]), fitted.inputs, k=2)
    return found.select("feature", F.round("importance", 8).alias("importance"))


@QUERIES
def importance_spark_ml(spark: SparkSession, sf: str) -> DataFrame:
    """The same as Spark ML tells."""
    fitted = _two_level_tree(staged_bands(spark, sf))
    found = feature_importance(fitted.model, fitted.inputs, k=2)
    return found.select("feature", F.round("importance", 8).alias("importance"))


# The category that explains more comes first in the tree; the other explains what is left between the cells.
_SQL_EXPLAINED = (
    f"r AS (SELECT *, avg(y) OVER () AS m, avg(y) OVER (PARTITION BY status) AS ms, avg(y) OVER (PARTITION BY band) AS mb, "
    f"avg(y) OVER (PARTITION BY status, band) AS mc FROM {SQL_BANDS}), "
    "e AS (SELECT sum((ms - m) ** 2) AS status, sum((mb - m) ** 2) AS band, sum((mc - m) ** 2) AS cells FROM r)"
)
ORACLES["importance_two_categories"] = ORACLES["importance_spark_ml"] = (
    f"WITH {_SQL_EXPLAINED} SELECT 'statusIndex' AS feature, round(CASE WHEN status > band THEN status ELSE cells - band END / cells, 8) AS importance FROM e "
    "UNION ALL SELECT 'bandIndex', round(CASE WHEN status > band THEN cells - status ELSE band END / cells, 8) FROM e"
)


@QUERIES
def contributions_two_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The part of each category in the prediction of each line."""
    rows = staged_bands(spark, sf)
    fitted = _two_level_tree(rows)
    found = trees.contributions(trees.node_table(fitted.model.stages[-1]), fitted.model.transform(rows), fitted.inputs)
    parts = {c: F.col(f"contributions.{c}Index") for c in BANDS.categorical}
    return found.select(
        "row_key", F.round("base", 6).alias("base"), *(F.round(part, 6).alias(c) for c, part in parts.items()),
        (F.abs(F.col("base") + sum(parts.values(), F.lit(0.0)) - F.col("prediction")) < 1e-9).alias("adds_up"),
    )


ORACLES["contributions_two_categories"] = (
    f"WITH {_SQL_EXPLAINED} SELECT row_key, round(m, 6) AS base, round(CASE WHEN e.status > e.band THEN ms - m ELSE mc - mb END, 6) AS status, "
    "round(CASE WHEN e.status > e.band THEN mc - ms ELSE mb - m END, 6) AS band, TRUE AS adds_up FROM r, e"
)


@QUERIES
def grid_cv_trials(spark: SparkSession, sf: str) -> DataFrame:
    """Trials of a grid whose two settings fit the same means."""
    rows = fold_column(keyed_lines(spark, sf), F.col("row_key"), 3)
    grid = [tune.with_params(models.tree(LABEL), p) for p in tune.grid(maxDepth=[2, 3])]
    trials = tune.cross_validate(rows, FLAG, grid, folds=3, scope="pipeline")
    return rounded(tune.trial_table(spark, trials).drop("fit_seconds"), 3)


ORACLES["grid_cv_trials"] = (
    "SELECT CAST(trial_id AS INT) AS trial_id, CAST(fold AS INT) AS fold, count(*) AS n, round(sqrt(avg(e * e)), 3) AS rmse, "
    "round(avg(e * e), 3) AS mse, round(avg(abs(e)), 3) AS mae, round(1 - avg(e * e) / var_pop(y), 3) AS r2 "
    f"FROM (SELECT *, y - p AS e FROM ({sql_fold_means('l_returnflag')})), range(2) t(trial_id) GROUP BY ALL"
)


@QUERIES
def grid_cv_best(spark: SparkSession, sf: str) -> DataFrame:
    """The forest grid, cross-validated; mean errors by trial."""
    rows = bucket_folds(staged_signal(spark, sf), 3)
    result = tune.grid_cv(rows, FEATURES, models.forest("y"), tune.grid(**training.FOREST_GRID), folds=3)
    return tune.cv_summary(result.trials)


def _searched(spark: SparkSession, sf: str, propose) -> tune.SearchResult:
    """A search among trees that all separate the flags, so that each predicts their means."""
    keyed = with_buckets(staged_prices(spark, sf), F.col("row_key"))
    space = {"maxDepth": tune.Quantised(2, 5)}
    return tune.search_validated(
        *bucket_split(keyed, [0.6, 0.2, 0.2]), FLAG, models.tree(LABEL), space, 4, propose=propose
    )


def sql_holdout(fit: str, test: str) -> str:
    """(y, p): labels of the test buckets and means of their flag in the fitted ones."""
    return (
        f"SELECT {LABEL} AS y, p FROM lineitem JOIN (SELECT l_returnflag AS g, avg({LABEL}) AS p FROM lineitem "
        f"WHERE {SQL_BUCKET} {fit} GROUP BY ALL) ON g = l_returnflag WHERE {SQL_BUCKET} {test}"
    )


@QUERIES
def search_trials(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of random proposals on the validation rows."""
    trials = _searched(spark, sf, "random").trials
    return trials.select("trial_id", F.round("rmse", 3).alias("rmse"))


ORACLES["search_trials"] = (
    "SELECT CAST(trial_id AS INT) AS trial_id, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse FROM "
    f"({sql_holdout('< 600', 'BETWEEN 600 AND 799')}), range(4) t(trial_id) GROUP BY trial_id"
)


@QUERIES
def search_refit(spark: SparkSession, sf: str) -> DataFrame:
    """The best guided proposal refitted on train and validation, and its test metrics."""

    def propose(space, history, rng):
        return tune.propose_parzen(space, history, rng, startup=2)

    return rounded(_searched(spark, sf, propose).test_metrics, 3)


ORACLES["search_refit"] = sql_metrics(sql_holdout("< 800", ">= 800"), digits=3)


@QUERIES
def search_forest(spark: SparkSession, sf: str) -> DataFrame:
    """H3 H4: forests with all features over the configured space, four evaluations; proposals and errors."""
    parts = bucket_split(staged_signal(spark, sf), [0.6, 0.2, 0.2])
    return tune.search_validated(*parts, FEATURES, models.forest("y"), training.FOREST_SPACE, 4).trials


@QUERIES
def automl_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """A sweep over three tree models with all features."""
    rows = bucket_folds(staged_signal(spark, sf), 3)
    return automl.sweep(rows, FEATURES, "y", max_models=3).leaderboard


@QUERIES
def automl_flag_means(spark: SparkSession, sf: str) -> DataFrame:
    """A tree, a linear and a generalised model that all predict the flag means."""
    rows = fold_column(staged_prices(spark, sf), F.col("row_key"), 3)
    board = automl.sweep(rows, FLAG, LABEL, exclude=["boosted", "forest"], max_models=3).leaderboard
    # Unknown levels make one slot too many for an exact solution; the squared error shows it.
    return rounded(board.drop("mse", "fit_seconds"), 3)


ORACLES["automl_flag_means"] = (
    "SELECT algo || '_1' AS model_id, algo, round(avg(rmse), 3) AS rmse, "
    "round(avg(mae), 3) AS mae, round(avg(r2), 3) AS r2 FROM (SELECT fold, sqrt(avg(e * e)) AS rmse, "
    "avg(abs(e)) AS mae, 1 - avg(e * e) / var_pop(y) AS r2 "
    f"FROM (SELECT *, y - p AS e FROM ({sql_fold_means('l_returnflag')})) GROUP BY fold), "
    "(VALUES ('tree'), ('linear'), ('glm')) a(algo) GROUP BY algo"
)


def _forest(rows: DataFrame) -> Fitted:
    return fit_pipeline(rows, FEATURES, models.forest("y", numTrees=10))


@QUERIES
def forest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A forest trained on four fifths, tested on the rest."""
    train, test = bucket_split(staged_signal(spark, sf), [0.8, 0.2])
    return regression_metrics(_forest(train).model.transform(test), "y")


@QUERIES
def feature_importance_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Columns by how much they reduce impurity."""
    fitted = _forest(staged_signal(spark, sf))
    return feature_importance(fitted.model, fitted.inputs, k=3)


@QUERIES
def permutation_gain(spark: SparkSession, sf: str) -> DataFrame:
    """Columns by the error their shuffling adds."""
    rows = staged_signal(spark, sf)
    fitted = _forest(rows)
    columns = [*FEATURES.categorical, *FEATURES.numeric]
    return permutation_importance(fitted.model, rows, "y", columns, F.col("row_key"))


@QUERIES
def permutation_flag(spark: SparkSession, sf: str) -> DataFrame:
    """The error when rows borrow the flag of another row."""
    rows = staged_prices(spark, sf)
    fitted = fit_pipeline(rows, FLAG, one_tree(LABEL))
    table_ = permutation_importance(fitted.model, rows, LABEL, ["l_returnflag"], F.col("row_key"))
    return table_.select("feature", F.round("rmse", 3).alias("rmse"), F.round("rmse_gain", 3).alias("rmse_gain"))


ORACLES["permutation_flag"] = f"""
WITH k AS (SELECT {SQL_KEY} AS row_key, l_returnflag AS flag, {LABEL} AS y,
             CAST('0x' || substr(md5('42:' || {SQL_KEY}), 1, 8) AS BIGINT)
               % greatest(1, (SELECT count(*) // 10000 FROM lineitem)) AS bucket FROM lineitem),
w AS (SELECT *, coalesce(lead(flag) OVER (PARTITION BY bucket ORDER BY md5('42/' || row_key), row_key),
        first_value(flag) OVER (PARTITION BY bucket ORDER BY md5('42/' || row_key), row_key)) AS other FROM k),
m AS (SELECT flag AS g, avg(y) AS p FROM k GROUP BY flag),
s AS (SELECT sqrt(avg((y - own.p) * (y - own.p))) AS base, sqrt(avg((y - lent.p) * (y - lent.p))) AS rmse
      FROM w JOIN m own ON own.g = flag JOIN m lent ON lent.g = other)
SELECT 'l_returnflag' AS feature, round(rmse, 3) AS rmse, round(rmse - base, 3) AS rmse_gain FROM s"""


@QUERIES
def score_registered(spark: SparkSession, sf: str) -> DataFrame:
    """A logged model, registered, put in production and found by name."""
    store = TableStore(spark, scratch_path(spark, "registry"))
    rows = staged_prices(spark, sf)
    for estimator in (models.linear(LABEL), one_tree(LABEL)):
        fitted = fit_pipeline(rows, FLAG, estimator)
        run_id = runs.start_run(store, "prices")
        runs.log_model(store, run_id, fitted.model, runs.input_example(rows, "row_key"))
        training.register_in_stage(store, run_id, "flag_means", "Production")
    registry.transition(store, "flag_means", 1, "Archived")
    scored = training.score_with(store, "models:/flag_means/Production", rows, ["row_key"])
    return scored.withColumn("prediction", F.round("prediction", 3))


@QUERIES
def score_stream_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The same model over a stream of files."""
    fitted = fit_pipeline(staged_prices(spark, sf), FLAG, one_tree(LABEL))
    out, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "progress")
    source = table(spark, sf, "lineitem")
    # A pattern, since a stream source takes a folder or a pattern but no single file.
    stream = read_stream(spark, f"{sf}/lineitem.parque[t]", source.schema)
    keyed = stream.withColumn("row_key", row_key(*KEY))
    score_stream(fitted.model, keyed, ["row_key"], out, checkpoint).awaitTermination()
    return spark.read.parquet(out).withColumn("prediction", F.round("prediction", 3))


@QUERIES
def score_stream_registered_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that looks up the model in production for each batch."""
    store = TableStore(spark, scratch_path(spark, "registry"))
    rows = staged_prices(spark, sf)
    for estimator, stage in ((models.linear(LABEL), "Archived"), (one_tree(LABEL), "Production")):
        run_id = runs.start_run(store, "prices")
        runs.log_model(store, run_id, fit_pipeline(rows, FLAG, estimator).model)
        training.register_in_stage(store, run_id, "flag_means", stage)
    out, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "progress")
    stream = read_stream(spark, f"{sf}/lineitem.parque[t]", table(spark, sf, "lineitem").schema).withColumn("row_key", row_key(*KEY))
    score_stream_registered(store, "models:/flag_means/Production", stream, ["row_key"], out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("row_key", F.round("prediction", 3).alias("prediction"))


ORACLES["score_registered"] = ORACLES["score_stream_rows"] = ORACLES["score_stream_registered_rows"] = SQL_FLAG_MEAN


@QUERIES
def training_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Two training jobs over the listing and the runs they logged."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = training.stage_rows(raw_listing(spark, sf).drop("row_key"), SPEC)
    data = training.prepare(rows, SPEC, [0.8, 0.2])
    training.train_simple(store, data, "linear", "linear")
    training.train_simple(store, data, "forest", "forest", numTrees=5)
    found = runs.search_runs(
        store.read("runs"), store.read("metrics"), store.read("params"), training.EXPERIMENT,
        metric_keys=["rmse", "r2"], param_keys=["label", "features"],
    )
    return found.select(
        "run_name",
        F.col("`metrics.rmse`").alias("rmse"),
        F.col("`metrics.r2`").alias("r2"),
        F.col("`params.label`").alias("label"),
    )


FLAG_SPEC = ListingSpec(keep=("price", "returnflag"), impute=())


@QUERIES
def training_flag_means(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs with one category, whose test metrics SQL can tell."""
    store = TableStore(spark, scratch_path(spark, "store"))
    rows = training.stage_rows(raw_listing(spark, sf), FLAG_SPEC, F.col("row_key"))
    data = training.prepare(rows, FLAG_SPEC, [0.8, 0.2])
    for algo in ("linear", "tree"):
        training.train_simple(store, data, algo, algo)
    found = runs.search_runs(
        store.read("runs"), store.read("metrics"), experiment=training.EXPERIMENT, metric_keys=["rmse", "r2"]
    )
    return found.select(
        "run_name", F.round(F.col("`metrics.rmse`"), 3).alias("rmse"), F.round(F.col("`metrics.r2`"), 3).alias("r2")
    )


ORACLES["training_flag_means"] = (
    "SELECT run_name, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, "
    f"round(1 - avg((y - p) * (y - p)) / var_pop(y), 3) AS r2 FROM ({sql_holdout('< 800', '>= 800')}), "
    "(VALUES ('linear'), ('tree')) r(run_name) GROUP BY run_name"
)
