"""Model names, their versions and stages."""

from __future__ import annotations

import re
import threading

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.tracking.runs import TableStore, next_event, now

# The stages a version can be in.
STAGES = ("None", "Staging", "Production", "Archived")
_WRITING = threading.Lock()


def _claim(store: TableStore, name: str, first: int) -> int:
    """The first number from `first` on that no other writer has for the name.

    Each number is a file that is created only if it is not there, which HDFS and object stores with conditional writes do as one step.
    Local file systems look first, so writers of one process go one after the other.
    """
    jvm = store.spark.sparkContext._jvm
    conf = store.spark.sparkContext._jsc.hadoopConfiguration()
    folder = store.path("model_claims", name.encode().hex())
    number = first
    with _WRITING:
        while True:
            path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{number}")
            if path.getFileSystem(conf).createNewFile(path):
                return number
            number += 1


def register(store: TableStore, name: str, run_id: str, artifact: str = "model") -> int:
    """Give the model of a run the next version of a name; any number of writers at a time."""
    artifacts = store.read("artifacts")
    found = (
        artifacts.filter((F.col("run_id") == run_id) & (F.col("name") == artifact) & (F.col("kind") == "model"))
        .agg(F.max_by("path", "logged_at").alias("path"))
        .first()["path"]
    )
    if found is None:
        raise ValueError(f"run {run_id} has no model {artifact!r}")
    versions = store.read("model_versions").filter(F.col("name") == name)
    version = _claim(store, name, versions.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).alias("v")).first()["v"])
    store.append("model_versions", [(name, version, run_id, found, now())])
    return version


def transition(store: TableStore, name: str, version: int, stage: str) -> None:
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}; known: {STAGES}")
    known = store.read("model_versions").filter((F.col("name") == name) & (F.col("version") == version))
    if known.isEmpty():
        raise ValueError(f"model {name!r} has no version {version}")
    store.append("stage_events", [(name, version, stage, now(), next_event())])


def latest_versions(versions: DataFrame) -> DataFrame:
    """(name, version): the highest version of each name."""
    return versions.groupBy("name").agg(F.max("version").alias("version"))


def current_stages(events: DataFrame) -> DataFrame:
    """(name, version, stage): what the last event of each version says, that is, the one with the greatest number.

    The stage is carried in the number's last place, so the greatest of both is one fixed-width maximum: a
    hash aggregate, and a version with very many events is no hot window.
    """
    known = F.array(*(F.lit(stage) for stage in STAGES))
    coded = F.col("event") * len(STAGES) + F.array_position(known, F.col("stage")) - 1
    last = events.groupBy("name", "version").agg(F.max(coded).alias("last"))
    return last.select("name", "version", F.get(known, (F.col("last") % len(STAGES)).cast("int")).alias("stage"))


def resolve_all(events: DataFrame) -> DataFrame:
    """(name, stage, version): the highest version now in each stage of each name."""
    return current_stages(events).groupBy("name", "stage").agg(F.max("version").alias("version"))


def parse_model_uri(uri: str) -> tuple[str, str]:
    """'models:/<name>/<stage>' to its parts."""
    parts = re.fullmatch(r"models:/([^/]+)/([^/]+)", uri)
    if parts is None:
        raise ValueError(f"not of the form models:/<name>/<stage>: {uri!r}")
    return parts[1], parts[2]


def resolve(store: TableStore, uri: str) -> str:
    """Path of the model that a name and stage stand for now."""
    name, stage = parse_model_uri(uri)
    wanted = resolve_all(store.read("stage_events").filter(F.col("name") == name))
    row = (
        wanted.filter(F.col("stage") == stage)
        .join(store.read("model_versions").filter(F.col("name") == name), ["name", "version"])
        .select("path")
        .first()
    )
    if row is None:
        raise LookupError(f"no version of model {name!r} is in stage {stage!r}")
    return row["path"]


def load_model(store: TableStore, uri: str) -> PipelineModel:
    return PipelineModel.load(resolve(store, uri))
