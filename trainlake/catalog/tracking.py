"""Run logs and model registries, read from order tables laid out as such."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.catalog.common import Queries, table
from trainlake.catalog.metrics import LABEL, with_group_mean
from trainlake.operators.evaluate import regression_metrics
from trainlake.operators.features import Roles, level_counts
from trainlake.operators.models import fit_pipeline, tree
from trainlake.session import scratch_path
from trainlake.tracking import registry, runs
from trainlake.tracking.runs import TableStore

QUERIES = Queries()
ORACLES: dict[str, str] = {}

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]


@QUERIES
def experiments_list(spark: SparkSession, sf: str) -> DataFrame:
    """K7: orders as runs, their priority as experiment."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.lit("").alias("run_name"),
        F.col("o_orderdate").alias("started_at"),
    )
    return runs.list_experiments(orders)


ORACLES["experiments_list"] = (
    "SELECT o_orderpriority AS experiment, count(*) AS n_runs, max(o_orderdate) AS last_started "
    "FROM orders GROUP BY ALL"
)


@QUERIES
def search_runs_wide(spark: SparkSession, sf: str) -> DataFrame:
    """K8: customers as runs; the last order of each priority and status as metric and parameter."""
    run_rows = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("run_id"), F.col("c_mktsegment").alias("experiment")
    )
    orders = table(spark, sf, "orders")
    # Orders are numbered by date and key: seconds, and 28 bits for the key.
    event = (F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * (1 << 28) + F.col("o_orderkey")).alias("event")
    base = [F.col("o_custkey").cast("string").alias("run_id"), event]
    metrics = orders.select(*base, F.col("o_orderpriority").alias("key"), F.col("o_totalprice").alias("value"))
    params = orders.select(
        *base, F.col("o_orderstatus").alias("key"), F.col("o_orderkey").cast("string").alias("value")
    )
    wide = runs.search_runs(
        run_rows, metrics, params, metric_keys=PRIORITIES, param_keys=STATUSES
    )
    return wide.toDF(*[_plain(c) for c in wide.columns])


def _plain(name: str) -> str:
    return name.replace(".", "_").replace("-", "_").replace(" ", "_").lower()


ORACLES["search_runs_wide"] = (
    "SELECT CAST(c_custkey AS VARCHAR) AS run_id, c_mktsegment AS experiment, "
    + ", ".join(
        [
            f"arg_max(o_totalprice, (o_orderdate, o_orderkey)) FILTER (o_orderpriority = '{p}') AS metrics_{_plain(p)}"
            for p in PRIORITIES
        ]
        + [
            f"arg_max(CAST(o_orderkey AS VARCHAR), (o_orderdate, o_orderkey)) FILTER (o_orderstatus = '{s}') "
            f"AS params_{_plain(s)}"
            for s in STATUSES
        ]
    )
    + " FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment"
)


@QUERIES
def run_log_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K1 K2 K3: a run with the metrics of a group mean, logged and read back."""
    store = TableStore(spark, scratch_path(spark, "runs"))
    lines = table(spark, sf, "lineitem").select("l_returnflag", LABEL)
    row = regression_metrics(with_group_mean(lines, "l_returnflag", LABEL), LABEL).first()
    run_id = runs.start_run(store, "prices", "group mean")
    runs.log_metrics(store, run_id, {"rmse": row["rmse"], "n": row["n"]})
    runs.log_params(store, run_id, {"label": LABEL})
    logged = store.read("metrics").select("run_id", "key", F.round("value", 4).cast("string").alias("value"))
    both = logged.unionByName(store.read("params").select("run_id", "key", "value"))
    return store.read("runs").join(both, "run_id").select("experiment", "run_name", "key", "value")


ORACLES["run_log_roundtrip"] = f"""
WITH s AS (SELECT {LABEL} - avg({LABEL}) OVER (PARTITION BY l_returnflag) AS e FROM lineitem)
SELECT 'prices' AS experiment, 'group mean' AS run_name, key, value FROM (
  SELECT 'rmse' AS key, CAST(round(sqrt(avg(e * e)), 4) AS VARCHAR) AS value FROM s UNION ALL
  SELECT 'n', CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) FROM s UNION ALL SELECT 'label', '{LABEL}')"""


@QUERIES
def autolog_params(spark: SparkSession, sf: str) -> DataFrame:
    """K4: what is logged by itself of a fitted pipeline."""
    store = TableStore(spark, scratch_path(spark, "params"))
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_partkey", LABEL)
    rows = lines.select("l_returnflag", (F.col("l_partkey") % 30).cast("string").alias("bucket"), LABEL)
    fitted = fit_pipeline(rows, Roles(("l_returnflag", "bucket"), ()), tree(LABEL, maxDepth=3))
    run_id = runs.start_run(store, "prices")
    runs.autolog(store, run_id, fitted.model)
    wide = runs.search_runs(store.read("runs"), store.read("metrics"), store.read("params"), param_keys=LOGGED)
    values = F.create_map(*(x for k in LOGGED for x in (F.lit(k), F.col(f"`params.{k}`"))))
    return wide.select(F.explode(values).alias("key", "value"))


LOGGED = [
    "StringIndexerModel.inputCols", "StringIndexerModel.handleInvalid", "VectorAssembler.inputCols",
    "DecisionTreeRegressionModel.maxDepth", "DecisionTreeRegressionModel.maxBins", "DecisionTreeRegressionModel.labelCol",
]
# Bins follow the widest category and its unknown level.
ORACLES["autolog_params"] = f"""
SELECT 'StringIndexerModel.inputCols' AS key, '[''l_returnflag'', ''bucket'']' AS value UNION ALL
SELECT 'StringIndexerModel.handleInvalid', 'skip' UNION ALL SELECT 'VectorAssembler.inputCols', '[''l_returnflagIndex'', ''bucketIndex'']' UNION ALL
SELECT 'DecisionTreeRegressionModel.maxDepth', '3' UNION ALL SELECT 'DecisionTreeRegressionModel.labelCol', '{LABEL}' UNION ALL
SELECT 'DecisionTreeRegressionModel.maxBins', CAST(greatest(40, count(DISTINCT l_partkey % 30) + 1) AS VARCHAR) FROM lineitem"""


@QUERIES
def artifact_table(spark: SparkSession, sf: str) -> DataFrame:
    """K6: a result table kept with a run and found through its artifact row."""
    store = TableStore(spark, scratch_path(spark, "artifacts"))
    run_id = runs.start_run(store, "levels")
    counts = level_counts(table(spark, sf, "part"), ["p_brand", "p_type"])
    runs.log_table(store, run_id, counts, "levels")
    found = store.read("artifacts").filter((F.col("run_id") == run_id) & (F.col("name") == "levels"))
    return spark.read.parquet(found.first()["path"])


ORACLES["artifact_table"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS freq FROM part GROUP BY ALL" for c in ("p_brand", "p_type")
)


def stage_events(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as stage changes of part versions by supplier."""
    stage = F.element_at(
        F.create_map(*[F.lit(x) for x in ("A", "Archived", "N", "Staging", "R", "Production")]), F.col("l_returnflag")
    )
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("supplier"), "l_suppkey").alias("name"),
        F.col("l_partkey").alias("version"),
        stage.alias("stage"),
        # Numbered by day, order and line: 40 bits for the order, 3 for the line.
        (F.unix_date(F.to_date("l_shipdate")).cast("bigint") * (1 << 43) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event"),
    )


_SQL_STAGES = """(SELECT 'supplier' || l_suppkey AS name, l_partkey AS version,
    arg_max(CASE l_returnflag WHEN 'A' THEN 'Archived' WHEN 'N' THEN 'Staging' ELSE 'Production' END,
            (l_shipdate, l_orderkey, l_linenumber)) AS stage
    FROM lineitem GROUP BY l_suppkey, l_partkey)"""


@QUERIES
def registry_latest_version(spark: SparkSession, sf: str) -> DataFrame:
    """K9: the highest version of each name."""
    return registry.latest_versions(stage_events(spark, sf))


ORACLES["registry_latest_version"] = (
    "SELECT 'supplier' || l_suppkey AS name, max(l_partkey) AS version FROM lineitem GROUP BY l_suppkey"
)


@QUERIES
def registry_current_stage(spark: SparkSession, sf: str) -> DataFrame:
    """What the last change of each version says."""
    return registry.current_stages(stage_events(spark, sf))


ORACLES["registry_current_stage"] = f"SELECT name, version, stage FROM {_SQL_STAGES}"


@QUERIES
def registry_resolved(spark: SparkSession, sf: str) -> DataFrame:
    """The version that each name and stage stand for."""
    return registry.resolve_all(stage_events(spark, sf))


ORACLES["registry_resolved"] = f"SELECT name, stage, max(version) AS version FROM {_SQL_STAGES} GROUP BY ALL"
