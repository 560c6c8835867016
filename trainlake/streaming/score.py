"""Score a stream with a pipeline model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trainlake.operators.score import score
from trainlake.tracking import registry
from trainlake.tracking.runs import TableStore


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet", **options: str
) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def score_stream(
    model: PipelineModel,
    stream: DataFrame,
    keep: Sequence[str],
    out: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Append predictions to a table; without state, so restarts go on from the
    checkpoint. available_now works off what is there and stops."""
    writer = (
        score(model, stream, keep)
        .writeStream.format(format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out)


def score_stream_registered(
    store: TableStore,
    uri: str,
    stream: DataFrame,
    keep: Sequence[str],
    out: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append predictions of whatever model stands for the URI when a micro-batch begins.

    A stage change takes effect with the next batch; a model is loaded only when it is another one. Each batch is
    a folder of its own, batch=<number>, which is written anew if the batch is repeated after a failure.
    """
    loaded: dict[str, PipelineModel] = {}

    def score_batch(rows: DataFrame, number: int) -> None:
        path = registry.resolve(store, uri)
        if path not in loaded:
            loaded.clear()
            loaded[path] = PipelineModel.load(path)
        score(loaded[path], rows, keep).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    writer = stream.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
