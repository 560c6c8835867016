"""Pipeline stages for categories with any number of levels: looked up in an index table, or with an effect for each level."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.operators.features import LevelIndex, apply_index, look_up
from trainlake.operators.ranks import WINDOW_ROWS, positions
from trainlake.session import materialise

#: A number whose variance within levels is a smaller share of its whole variance tells nothing beside the levels.
LEAST_WITHIN = 1e-10


class IndexLookup(Transformer, MLReadable, MLWritable):
    """Adds <column><suffix> from an index table, as a nominal feature of a known number of values.

    The levels stay a table, on disk with the saved model, and are joined; the stage itself knows
    their number. The number of values is in the new column's metadata, so that encoders and trees behind it
    need not look for it. The order of rows is not kept.
    """

    def __init__(self, index: LevelIndex, columns: Sequence[str], suffix: str = "Index", on_unknown: str = "skip"):
        super().__init__()
        self.index, self.columns, self.suffix, self.on_unknown = index, list(columns), suffix, on_unknown

    def n_values(self, column: str) -> int:
        return self.index.n_values(column) + (self.on_unknown == "keep")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = apply_index(dataset, self.index, self.columns, self.on_unknown, self.suffix)
        nominal = {c: {"ml_attr": {"type": "nominal", "name": c + self.suffix, "num_vals": self.n_values(c)}} for c in self.columns}
        return found.select(
            *dataset.columns,
            *(F.col(c + self.suffix).cast("double").alias(c + self.suffix, metadata=nominal[c]) for c in self.columns),
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: IndexLookup):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        stage = self.instance
        extra = {
            "columns": stage.columns, "suffix": stage.suffix, "on_unknown": stage.on_unknown, "rank": stage.index.rank,
            "sizes": dict(stage.index.sizes), "widths": dict(stage.index.widths), "values": dict(stage.index.values),
        }
        DefaultParamsWriter.saveMetadata(stage, path, self.sparkSession, extraMetadata={"lookup": extra})
        table = stage.index.table.filter(F.col("column").isin(*stage.columns))
        table.write.partitionBy("column").parquet(f"{path}/index")


class _Reader(MLReader):
    def load(self, path: str) -> IndexLookup:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        kept = metadata["lookup"]
        # A table without levels has no partition folders to read the schema from.
        schema = "level string, freq bigint, " + ("" if kept["rank"] == "idx" else f"{kept['rank']} bigint, ") + "idx bigint, column string"
        table = self.sparkSession.read.schema(schema).parquet(f"{path}/index")
        index = LevelIndex(table, kept["sizes"], kept["widths"], kept["rank"], kept["values"])
        stage = IndexLookup(index, kept["columns"], kept["suffix"], kept["on_unknown"])
        stage._resetUid(metadata["uid"])
        return stage


class WideLinearModel(Transformer, MLReadable, MLWritable):
    """A linear model of one wide category and a few features: the effect of the row's level and the features times coefficients.

    The effects are a table, on disk with the saved model, and are joined; the order of rows is not kept. Rows with an unknown
    level are dropped ("skip"), or get the effect that rows without a level had, or else the mean one ("keep").
    """

    def __init__(
        self, index: LevelIndex, column: str, coefficients: Sequence[float], other: float,
        on_unknown: str = "skip", features: str = "features", prediction: str = "prediction",
    ):
        super().__init__()
        self.index, self.column, self.coefficients, self.other = index, column, [float(c) for c in coefficients], float(other)
        self.on_unknown, self.features, self.prediction = on_unknown, features, prediction

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = look_up(dataset, self.index, {self.column: "_effect"})
        effect = F.col("_effect")
        if self.on_unknown == "skip":
            found = found.dropna(subset=["_effect"])
        else:
            effect = F.coalesce(effect, F.lit(self.other))
        for k, c in enumerate(self.coefficients):
            effect = effect + F.get(vector_to_array(self.features), F.lit(k)) * F.lit(c)
        return found.withColumn(self.prediction, effect).drop("_effect")

    def write(self) -> MLWriter:
        return _EffectsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EffectsReader()


class _EffectsWriter(MLWriter):
    def __init__(self, instance: WideLinearModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        model = self.instance
        extra = {
            "column": model.column, "coefficients": model.coefficients, "other": model.other, "on_unknown": model.on_unknown,
            "features": model.features, "prediction": model.prediction, "sizes": dict(model.index.sizes), "widths": dict(model.index.widths),
        }
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, extraMetadata={"effects": extra})
        model.index.table.write.parquet(f"{path}/effects")


class _EffectsReader(MLReader):
    def load(self, path: str) -> WideLinearModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        kept = metadata["effects"]
        table = self.sparkSession.read.schema("column string, level string, rank bigint, idx double").parquet(f"{path}/effects")
        index = LevelIndex(table, kept["sizes"], kept["widths"], "rank")
        model = WideLinearModel(
            index, kept["column"], kept["coefficients"], kept["other"], kept["on_unknown"], kept["features"], kept["prediction"]
        )
        model._resetUid(metadata["uid"])
        return model


def fit_wide_linear(
    rows: DataFrame, column: str, estimator: LinearRegression, on_unknown: str = "skip",
    window_rows: int = WINDOW_ROWS, partitions: int | None = None,
) -> WideLinearModel:
    """The least squares fit of the label by the estimator's feature vector, of a few slots, and a slot for each level of a column.

    The slots of levels are not solved for together: within its level, a row's distance from the level's means is what the features have to
    explain, and the effect of a level is what they leave of its mean label. So one grouping by level and sums of products as large as the
    square of the few slots give the exact solution. Features that vary with the level only have the coefficient 0.
    """
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    first = rows.select(features).first()
    width = len(first[0]) if first else 0
    xs = [f"_x{k}" for k in range(width)]
    values = vector_to_array(features)
    flat = rows.select(
        F.col(column).alias("level"), F.col(label).cast("double").alias("_y"), *(F.get(values, F.lit(k)).alias(x) for k, x in enumerate(xs))
    )
    flat = flat.filter("level IS NOT NULL") if on_unknown == "skip" else flat
    names = ["_y", *xs]
    bad = F.col("_y").isNull() | F.isnan("_y") | (F.abs("_y") == float("inf"))
    whole = flat.agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), *(F.avg(c).alias(c) for c in names)).first()
    if not whole["n"] or whole["bad"]:
        raise ValueError(f"{whole['bad']} of {whole['n']} labels are missing or not finite" if whole["n"] else "no rows to fit")
    at = {c: F.col(c) - F.lit(whole[c]) for c in xs}
    levels = flat.groupBy("level").agg(F.count(F.lit(1)).alias("freq"), *(F.avg(c).alias(c) for c in names))
    means = materialise(levels, "level-means")
    beta = np.zeros(width)
    if width:
        centred = [F.col("_y") - F.lit(whole["_y"]), *at.values()]
        products = [(i, j) for i in range(width) for j in range(i + 1)] + [(i, -1) for i in range(width)]
        sums = {p: (centred[p[0] + 1] * centred[p[1] + 1]) for p in products}
        total = flat.agg(*(F.sum(v).alias(f"s{k}") for k, v in enumerate(sums.values()))).first()
        between = means.agg(*(F.sum(F.col("freq") * v).alias(f"s{k}") for k, v in enumerate(sums.values()))).first()
        xx, all_, xy = np.zeros((width, width)), np.zeros(width), np.zeros(width)
        for (i, j), t, b in zip(products, total, between, strict=True):
            if j < 0:
                xy[i] = t - b
            else:
                xx[i, j] = xx[j, i] = t - b
                if i == j:
                    all_[i] = t
        if not np.isfinite(xx).all():
            raise ValueError("features are missing or not finite")
        own = np.flatnonzero(np.diag(xx) > LEAST_WITHIN * all_)
        scale = np.sqrt(np.diag(xx)[own])
        beta[own] = np.linalg.lstsq(xx[np.ix_(own, own)] / np.outer(scale, scale), xy[own] / scale, rcond=LEAST_WITHIN)[0] / scale
    effect = F.col("_y")
    for x, b in zip(xs, beta.tolist(), strict=True):
        effect = effect - F.col(x) * F.lit(b)
    effects = means.select(F.lit(column).alias("column"), "level", "freq", effect.alias("idx"))
    known = effects.filter("level IS NOT NULL")
    without = effects.filter("level IS NULL").first()
    mean = whole["_y"] - sum(b * whole[x] for x, b in zip(xs, beta.tolist(), strict=True))
    n, longest = known.agg(F.count(F.lit(1)), F.max(F.octet_length("level"))).first()
    ranked = positions(known, "column", [F.desc("freq"), F.col("level")], "rank", n, window_rows, partitions)
    table = materialise(ranked.select("column", "level", "rank", "idx"), "effects")
    index = LevelIndex(table, {column: n}, {column: longest or 0}, "rank")
    other = without["idx"] if without else mean
    return WideLinearModel(index, column, beta.tolist(), other, on_unknown, features, estimator.getPredictionCol())
