"""Sessions, the shared folder, and tables written to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_S3A = "spark.hadoop.fs.s3a."


def object_store_conf(env: Mapping[str, str]) -> dict[str, str]:
    """S3A settings from environment variables; empty when no key is set."""
    key, secret = env.get("AWS_ACCESS_KEY_ID"), env.get("AWS_SECRET_ACCESS_KEY")
    if not (key and secret):
        return {}
    conf = {
        _S3A + "access.key": key,
        _S3A + "secret.key": secret,
        _S3A + "path.style.access": "true",
        "spark.hadoop.fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    endpoint = env.get("AWS_ENDPOINT_URL_S3") or env.get("AWS_ENDPOINT_URL")
    if endpoint:
        conf[_S3A + "endpoint"] = endpoint
        conf[_S3A + "connection.ssl.enabled"] = str(endpoint.startswith("https")).lower()
    return conf


def get_session(
    app_name: str = "trainlake",
    master: str | None = None,
    packages: Sequence[str] = (),
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session with adaptive execution and UTC; the master may come from SPARK_MASTER."""
    builder = SparkSession.builder.appName(app_name)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **object_store_conf(os.environ),
        **(conf or {}),
    }
    if packages:
        settings["spark.jars.packages"] = ",".join(packages)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir.

    A local session without the setting gets a temporary folder, once. A
    cluster session without it is an error, since a machine-local folder
    would lose its content with the machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="trainlake-"))
    return sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make checkpoint() usable, e.g. for boosted trees that cut their lineage."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/trainlake/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the rows once below the shared folder and read them back.

    For results that several later plans read (levels of a category, clean rows):
    the source is scanned once, a lost executor cannot change what was decided
    from them, and the reader knows their size. discard() deletes them when they have done their work.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written._scratch = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that materialise() has written, when all that reads them is written as well.

    Only the very frames that it returned know their files; others are left alone.
    """
    for table in tables:
        path = getattr(table, "_scratch", None)
        if path is not None:
            spark = table.sparkSession
            found = spark._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)
            table._scratch = None


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Python functions of what is run inside get at most so many rows at a time.

    Spark's usual batch is 10,000 rows; with whole texts that is all of a task's input, held at once by the JVM and by Python. For
    work that runs before the block ends, such as materialise(): a lazy result follows the setting of its later run.
    """
    before = spark.conf.get(_BATCH)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def spread_scan(df: DataFrame) -> DataFrame:
    """A scan with at least one partition for each core, for work heavier than reading.

    Only small or unsplittable inputs (one Parquet row group, compressed JSON)
    have fewer and pay a shuffle for it; a large input comes back as it is. To be
    used on fresh scans: their partitions are known without running anything, and
    their row numbers are the same on every read, so that a hash of those spreads
    any rows evenly, copies too, and needs no sort to be repeatable.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, F.monotonically_increasing_id())


#: Rows in a partition that a fit keeps in memory, at about 200 bytes each.
ROWS_IN_MEMORY = 500_000


def spread_rows(df: DataFrame, rows: int, most: int = ROWS_IN_MEMORY) -> DataFrame:
    """The rows, of which there are so many, in partitions of at most about `most` each.

    A scan cuts its files by bytes, and a few bytes of columns and repeated values may be very many rows, which are large once a
    fit holds them. To be used on scans, as spread_scan(); what is small enough comes back as it is.
    """
    if rows <= most * df.rdd.getNumPartitions():
        return df
    return df.repartition(-(-rows // most), F.monotonically_increasing_id())
