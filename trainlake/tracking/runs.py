"""A run log of append-only tables below one folder.

    runs       run_id, experiment, run_name, started_at
    params     run_id, key, value, logged_at, event
    metrics    run_id, key, value, logged_at, event
    artifacts  run_id, name, kind, path, logged_at

Logging appends rows. ``event`` numbers what a process logs by rising time, so that the last value is the one
with the greatest number, whatever the clock's resolution. Reading is ordinary DataFrame work; the functions at the
end take any frames of these layouts.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.param import Params
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

SCHEMAS = {
    "runs": "run_id string, experiment string, run_name string, started_at timestamp",
    "params": "run_id string, key string, value string, logged_at timestamp, event bigint",
    "metrics": "run_id string, key string, value double, logged_at timestamp, event bigint",
    "artifacts": "run_id string, name string, kind string, path string, logged_at timestamp",
    "model_versions": "name string, version int, run_id string, path string, registered_at timestamp",
    "stage_events": "name string, version int, stage string, changed_at timestamp, event bigint",
}


@dataclass(frozen=True)
class TableStore:
    """The tables of one root folder."""

    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def append(self, table: str, rows: Sequence[tuple]) -> None:
        """Write rows to a folder of their own, so that writers do not share a commit."""
        frame = self.spark.createDataFrame(list(rows), SCHEMAS[table]).coalesce(1)
        frame.write.parquet(self.path(table, uuid.uuid4().hex))

    def read(self, table: str) -> DataFrame:
        """The table; without rows while nothing was appended."""
        try:
            return self.spark.read.schema(SCHEMAS[table]).option("recursiveFileLookup", True).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[table])


def now() -> datetime:
    return datetime.now(timezone.utc)


_LAST = [0]
_LOCK = threading.Lock()


def next_event() -> int:
    """Microseconds since 1970, but always more than any number given before by this process."""
    with _LOCK:
        _LAST[0] = max(_LAST[0] + 1, time.time_ns() // 1000)
        return _LAST[0]


def start_run(store: TableStore, experiment: str, run_name: str = "") -> str:
    run_id = uuid.uuid4().hex
    store.append("runs", [(run_id, experiment, run_name, now())])
    return run_id


def log_metrics(store: TableStore, run_id: str, metrics: Mapping[str, float]) -> None:
    store.append("metrics", [(run_id, k, float(v), now(), next_event()) for k, v in metrics.items()])


def log_params(store: TableStore, run_id: str, params: Mapping[str, object]) -> None:
    store.append("params", [(run_id, k, str(v), now(), next_event()) for k, v in params.items()])


def stage_params(stages: Sequence[Params]) -> dict[str, str]:
    """'<stage class>.<parameter>' to value, for all that is set or has a default."""
    found = {}
    for stage in stages:
        for param, value in stage.extractParamMap().items():
            found[f"{type(stage).__name__}.{param.name}"] = str(value)
    return found


def autolog(store: TableStore, run_id: str, model: PipelineModel) -> None:
    """Log the parameters of every stage."""
    log_params(store, run_id, stage_params(model.stages))


def log_model(
    store: TableStore, run_id: str, model: PipelineModel, example: DataFrame | None = None, name: str = "model"
) -> str:
    """Save a model, and next to it some rows as an example of its input."""
    path = store.path("artifacts_data", run_id, name)
    model.write().overwrite().save(path)
    rows = [(run_id, name, "model", path, now())]
    if example is not None:
        beside = store.path("artifacts_data", run_id, f"{name}_input_example")
        example.coalesce(1).write.mode("overwrite").json(beside)
        rows.append((run_id, f"{name}_input_example", "json", beside, now()))
    store.append("artifacts", rows)
    return path


def input_example(df: DataFrame, *order: str | Column, n: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(n)


def log_table(store: TableStore, run_id: str, table: DataFrame, name: str) -> str:
    """Keep a result table, such as the most important features, with the run."""
    path = store.path("artifacts_data", run_id, name)
    table.write.mode("overwrite").parquet(path)
    store.append("artifacts", [(run_id, name, "table", path, now())])
    return path


def list_experiments(runs: DataFrame) -> DataFrame:
    """(experiment, n_runs, last_started)."""
    return runs.groupBy("experiment").agg(
        F.count(F.lit(1)).alias("n_runs"), F.max("started_at").alias("last_started")
    )


def search_runs(
    runs: DataFrame,
    metrics: DataFrame,
    params: DataFrame | None = None,
    experiment: str | None = None,
    metric_keys: Sequence[str] | None = None,
    param_keys: Sequence[str] | None = None,
) -> DataFrame:
    """One wide row for each run: metrics.<key> and params.<key> columns, each with
    the value logged last, that is, with the greatest event number.

    Give the keys when they are known; otherwise they are looked up first.
    """
    wide = runs if experiment is None else runs.filter(F.col("experiment") == experiment)
    parts = [("metrics", metrics, metric_keys)]
    if params is not None:
        parts.append(("params", params, param_keys))
    for prefix, logged, keys in parts:
        wide = wide.join(_latest_by_run(logged, prefix, keys or logged_keys(logged)), "run_id", "left")
    return wide


MAX_KEYS = 10_000


def logged_keys(logged: DataFrame, most: int = MAX_KEYS) -> list[str]:
    """The distinct keys, each of which becomes a column; an error if there are more than a table can have."""
    found = [r["key"] for r in logged.select("key").distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} different keys; name the ones that are wanted")
    return sorted(found)


def _latest_by_run(logged: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """The values of the greatest events, by run.

    The greatest number is a hash aggregate; a greatest struct or a value kept beside it, whose width is not fixed, would be sorted
    before and after the shuffle. The second aggregate meets one row for each run and key.
    """
    if not keys:
        return logged.select("run_id").distinct()
    wanted = logged.filter(F.col("key").isin(*keys))
    last = wanted.groupBy("run_id", "key").agg(F.max("event").alias("event"))
    values = wanted.join(last, ["run_id", "key", "event"]).groupBy("run_id").agg(F.collect_list(F.struct("key", "value")).alias("logged"))

    def value(key: str) -> Column:
        # Two processes may give one number; then the greater value counts.
        return F.array_max(F.transform(F.filter("logged", lambda e: e["key"] == key), lambda e: e["value"]))

    return values.select("run_id", *(value(k).alias(f"{prefix}.{k}") for k in keys))
