"""Regression metrics and linear models with closed forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, table
from trainlake.catalog.splits import SQL_BUCKET, keyed_lines
from trainlake.operators import models
from trainlake.operators.evaluate import regression_metrics
from trainlake.operators.features import Roles
from trainlake.operators.models import fit_pipeline
from trainlake.operators.score import score
from trainlake.operators.split import fold_column
from trainlake.operators.tune import cv_summary
from trainlake.session import materialise

QUERIES = Queries()
ORACLES: dict[str, str] = {}

LABEL = "l_extendedprice"
ROUNDED = ("rmse", "mse", "mae", "r2")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in df.columns if c in ROUNDED})


def sql_metrics(scored: str, by: str = "", digits: int = 4) -> str:
    keys, d = f"{by}, " if by else "", digits
    return (
        f"SELECT {keys}count(*) AS n, round(sqrt(avg(e * e)), {d}) AS rmse, round(avg(e * e), {d}) AS mse, "
        f"round(avg(abs(e)), {d}) AS mae, round(1 - avg(e * e) / var_pop(y), {d}) AS r2 "
        f"FROM (SELECT *, y - p AS e FROM ({scored})) GROUP BY ALL"
    )


def with_group_mean(rows: DataFrame, group: str, label: str) -> DataFrame:
    """Predict the mean label of the row's group.

    The means are written first: their size is then known, so that the join is a
    broadcast only if they are small, and rows do not move for a few groups.
    """
    means = rows.groupBy(group).agg(F.avg(label).alias("prediction"))
    return rows.join(materialise(means, "means"), group)


@QUERIES
def metrics_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the mean price by return flag."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", LABEL)
    return rounded(regression_metrics(with_group_mean(lines, "l_returnflag", LABEL), LABEL))


ORACLES["metrics_group_mean"] = sql_metrics(
    f"SELECT {LABEL} AS y, avg({LABEL}) OVER (PARTITION BY l_returnflag) AS p FROM lineitem"
)


@QUERIES
def metrics_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    """The same by line status, the mean by quantity as prediction."""
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_linestatus", LABEL)
    scored = with_group_mean(lines, "l_quantity", LABEL)
    return rounded(regression_metrics(scored, LABEL, by=["l_linestatus"]))


ORACLES["metrics_by_segment"] = sql_metrics(
    f"SELECT l_linestatus, {LABEL} AS y, avg({LABEL}) OVER (PARTITION BY l_quantity) AS p FROM lineitem",
    "l_linestatus",
)


@QUERIES
def cv_group_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Two category columns as predictors, cross-validated, the better one first.

    The prediction for a fold is the mean of the group in the other folds. Count,
    mean and variance of each group and fold are enough for the errors of both
    candidates: one scan, combined before its one shuffle.
    """
    candidates = ["l_returnflag", "l_linestatus"]
    rows = fold_column(keyed_lines(spark, sf), F.col("row_key"), 3).select("fold", LABEL, *candidates)
    cells = (
        rows.unpivot(["fold", LABEL], candidates, "candidate", "level")
        .groupBy("candidate", "level", "fold")
        .agg(F.count(LABEL).alias("n"), F.avg(LABEL).alias("m"), F.var_pop(LABEL).alias("v"))
    )
    folds = Window.partitionBy("candidate", "level")  # as many rows as folds
    n, m = F.col("n"), F.col("m")
    others = (F.sum(n * m).over(folds) - n * m) / (F.sum(n).over(folds) - n)
    squares = n * (F.col("v") + F.pow(m - F.col("p"), 2))
    trials = (
        cells.withColumn("p", others)
        .groupBy("candidate", "fold")
        .agg(F.sqrt(F.sum(squares) / F.sum(n)).alias("rmse"))
    )
    summary = cv_summary(trials, by=["candidate"])
    return summary.withColumn("mean_rmse", F.round("mean_rmse", 4))


def sql_fold_means(group: str) -> str:
    """(fold, y, p): the label and the mean of its group in the other folds."""
    return (
        f"SELECT r.fold, r.y, (t.s - c.s) / (t.n - c.n) AS p FROM "
        f"(SELECT {SQL_BUCKET} % 3 AS fold, {group} AS g, {LABEL} AS y FROM lineitem) r "
        f"JOIN (SELECT {SQL_BUCKET} % 3 AS fold, {group} AS g, sum({LABEL}) AS s, count(*) AS n "
        "FROM lineitem GROUP BY ALL) c ON c.g = r.g AND c.fold = r.fold "
        f"JOIN (SELECT {group} AS g, sum({LABEL}) AS s, count(*) AS n FROM lineitem GROUP BY ALL) t ON t.g = r.g"
    )


ORACLES["cv_group_mean"] = (
    "SELECT candidate, count(*) AS n_folds, round(avg(rmse), 4) AS mean_rmse FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS candidate, fold, sqrt(avg((y - p) * (y - p))) AS rmse FROM ({sql_fold_means(c)}) GROUP BY fold"
        for c in ("l_returnflag", "l_linestatus")
    )
    + ") GROUP BY candidate"
)


# --- linear models ------------------------------------------------------------


def signal(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with a label that depends on quantity, discount and flag."""
    bump = F.when(F.col("l_returnflag") == "A", 10.0).otherwise(0.0)
    label = F.col("l_quantity") * 3 - F.col("l_discount") * 50 + bump + F.col("l_tax") * 7
    return keyed_lines(spark, sf).select(
        "row_key", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", label.alias("y")
    )


SQL_SIGNAL = (
    "(SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key, l_quantity, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_quantity * 3 - l_discount * 50 "
    "+ CASE WHEN l_returnflag = 'A' THEN 10.0::DOUBLE ELSE 0.0::DOUBLE END + l_tax * 7 AS y FROM lineitem)"
)


def _coefficients(spark: SparkSession, sf: str, estimator, numeric: tuple[str, ...]) -> DataFrame:
    rows = signal(spark, sf)
    fitted = fit_pipeline(rows, Roles((), numeric), estimator)
    line = fitted.model.stages[-1]
    names = ["intercept", *numeric]
    values = [float(v) for v in (line.intercept, *line.coefficients)]
    scored = fitted.model.transform(rows)
    metrics = regression_metrics(scored, "y")
    return metrics.select(
        *[F.round(F.lit(v), 6).alias(n) for n, v in zip(names, values)], F.round("r2", 6).alias("r2")
    )


@QUERIES
def linreg_univariate(spark: SparkSession, sf: str) -> DataFrame:
    """Intercept and slope."""
    return _coefficients(spark, sf, models.linear("y"), ("l_quantity",))


@QUERIES
def glm_univariate(spark: SparkSession, sf: str) -> DataFrame:
    """The same from the generalised model."""
    return _coefficients(spark, sf, models.glm("y"), ("l_quantity",))


ORACLES["linreg_univariate"] = ORACLES["glm_univariate"] = (
    "SELECT round(regr_intercept(y, l_quantity), 6) AS intercept, round(regr_slope(y, l_quantity), 6) AS l_quantity, "
    f"round(regr_r2(y, l_quantity), 6) AS r2 FROM {SQL_SIGNAL}"
)


@QUERIES
def linreg_bivariate(spark: SparkSession, sf: str) -> DataFrame:
    """G1: two features, against the normal equations."""
    return _coefficients(spark, sf, models.linear("y"), ("l_quantity", "l_discount"))


ORACLES["linreg_bivariate"] = f"""
WITH m AS (SELECT avg(y) my, avg(l_quantity) m1, avg(l_discount) m2, var_pop(l_quantity) v1, var_pop(l_discount) v2,
  covar_pop(l_quantity, l_discount) v12, covar_pop(y, l_quantity) c1, covar_pop(y, l_discount) c2, var_pop(y) vy
  FROM {SQL_SIGNAL}),
b AS (SELECT *, (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM m)
SELECT round(my - b1 * m1 - b2 * m2, 6) AS intercept, round(b1, 6) AS l_quantity, round(b2, 6) AS l_discount,
  round((b1 * c1 + b2 * c2) / vy, 6) AS r2 FROM b"""


@QUERIES
def score_batch_linear(spark: SparkSession, sf: str) -> DataFrame:
    """The fitted line over every row."""
    rows = signal(spark, sf)
    fitted = fit_pipeline(rows, Roles((), ("l_quantity",)), models.linear("y"))
    return score(fitted.model, rows, ["row_key"]).withColumn("prediction", F.round("prediction", 4))


ORACLES["score_batch_linear"] = (
    f"WITH s AS {SQL_SIGNAL}, f AS (SELECT regr_intercept(y, l_quantity) AS a, regr_slope(y, l_quantity) AS b FROM s) "
    "SELECT row_key, round(a + b * l_quantity, 4) AS prediction FROM s, f"
)
