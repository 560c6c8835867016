"""Metrics and feature importance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trainlake.functions.buckets import hash_bucket

METRICS = ("rmse", "mse", "mae", "r2")
SMALLER_IS_BETTER = {"rmse": True, "mse": True, "mae": True, "r2": False}


def metric_struct(label: Column, prediction: Column) -> Column:
    """All regression metrics as one aggregate struct.

    The spread of the label comes from its variance, which Spark merges stably;
    a sum of squares minus a squared sum would lose its digits on large data.
    """
    error = label - prediction
    both = error.isNotNull()
    mse = F.avg(error * error)
    return F.struct(
        F.count(error).alias("n"),
        F.sqrt(mse).alias("rmse"),
        mse.alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - mse / F.nullif(F.var_pop(F.when(both, label)), F.lit(0.0))).alias("r2"),
    )


def regression_metrics(
    scored: DataFrame,
    label: str,
    prediction: str | Column = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """(by..., n, rmse, mse, mae, r2) in one aggregation."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    metrics = metric_struct(F.col(label), p).alias("m")
    return scored.groupBy(*by).agg(metrics).select(*by, "m.*")


def metrics_of(scored: DataFrame, label: str, predictions: Mapping[str, str]) -> dict[str, dict]:
    """Metrics of several prediction columns, one scan for all of them."""
    structs = [metric_struct(F.col(label), F.col(p)).alias(name) for name, p in predictions.items()]
    row = scored.agg(*structs).first()
    return {name: row[name].asDict() for name in predictions}


def score_models(models: Sequence[Model], data: DataFrame, label: str) -> list[dict]:
    """Metrics of several models over the same feature rows, one scan for all."""
    scored = data
    for i, model in enumerate(models):
        renamed = model.copy()
        renamed.setPredictionCol(f"_p{i}")
        scored = renamed.transform(scored)
    found = metrics_of(scored, label, {str(i): f"_p{i}" for i in range(len(models))})
    return [found[str(i)] for i in range(len(models))]


def feature_importance(
    model: PipelineModel, inputs: Sequence[str], k: int | None = 10
) -> DataFrame:
    """(feature, importance), the largest first.

    For tree models whose features are one slot each, so slots pair with inputs;
    the table has one row for each input column.
    """
    weights = model.stages[-1].featureImportances.toArray()
    if len(weights) != len(inputs):
        raise ValueError(f"{len(weights)} feature slots for {len(inputs)} columns")
    rows = [(name, float(w)) for name, w in zip(inputs, weights)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked if k is None else ranked.limit(k)


def permutation_importance(
    model: PipelineModel,
    data: DataFrame,
    label: str,
    features: Sequence[str],
    key: Column,
    seed: int = 42,
    rows_per_bucket: int = 10_000,
) -> DataFrame:
    """(feature, rmse, rmse_gain): how much worse the model gets with one feature
    taken from another row.

    The key must be unique. Rows fall into even buckets by its hash, and within a
    bucket each row borrows from the next in a hashed order: one shuffle, no
    global order. All variants of a row are scored in the same pass.
    """
    buckets = max(1, data.count() // rows_per_bucket)
    in_bucket = Window.partitionBy("_bucket").orderBy(F.md5(F.concat(F.lit(f"{seed}/"), "_key")), "_key")
    whole = in_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    values = F.struct(*features)
    paired = (
        data.select(label, *features, key.cast("string").alias("_key"))
        .withColumn("_bucket", hash_bucket(F.col("_key"), seed, buckets))
        .withColumn(
            "_other", F.coalesce(F.lead(values).over(in_bucket), F.first(values).over(whole))
        )
    )

    def variant(changed: str | None) -> Column:
        columns = [
            (F.col("_other")[f] if f == changed else F.col(f)).alias(f) for f in features
        ]
        return F.struct(F.lit(changed or "").alias("feature"), *columns)

    variants = F.array(variant(None), *[variant(f) for f in features])
    scored = model.transform(paired.select(label, F.inline(variants)))
    by_feature = regression_metrics(scored, label, by=["feature"])
    base = by_feature.filter("feature = ''").select(F.col("rmse").alias("base"))
    return (
        by_feature.filter("feature <> ''")
        .crossJoin(F.broadcast(base))  # one row
        .select("feature", "rmse", (F.col("rmse") - F.col("base")).alias("rmse_gain"))
    )
