"""Score rows with a pipeline model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def score(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns and the prediction of each row; of a batch or a stream.

    Rows are scored where they are, there is no shuffle.
    """
    return model.transform(rows).select(*keep, "prediction")
