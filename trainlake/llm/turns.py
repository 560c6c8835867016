"""Running numbers along sorted groups, with no group held by one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from trainlake.session import scratch_path

#: New columns of a batch of sorted rows, the number added up along a group, and the number of a row that counts if it leads its group.
Extend = Callable[[pa.RecordBatch], tuple[list[pa.Array], np.ndarray, np.ndarray]]


def turn_order() -> list[Column]:
    """Turns of a conversation in order: NULL numbers first, equal numbers by role and text."""
    return [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]


def clean_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; NULL roles and texts are empty; other columns are not looked at."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _changes(keys: pa.Array) -> np.ndarray:
    """Positions in a sorted batch at which another key begins, the first row left out."""
    n = len(keys)
    if n < 2:
        return np.empty(0, np.int64)
    valid = np.asarray(pc.is_valid(keys).to_numpy(zero_copy_only=False))
    values = np.asarray(pc.fill_null(keys, 0).to_numpy(zero_copy_only=False))
    return np.flatnonzero((values[1:] != values[:-1]) | (valid[1:] != valid[:-1])) + 1


def running(df: DataFrame, group: str, order: Sequence[Column], extend: Extend, extra: str) -> DataFrame:
    """df with the columns of ``extra`` and ``at``, ``before``, ``weight``, ``lead``.

    ``at`` is the 0-based position of a row in its group (a column of long numbers, NULL being a group, too), ``before``
    the sum of the weights of the rows before it, ``lead`` the leading number of the group's first row. Rows are
    ranged by group and order, so that a group of any size is spread over tasks; each task passes over its sorted
    rows once and they are written with what it counted. Groups of more than one task, at most one for each
    boundary, then get what the tasks before have counted. df must not have columns of these names, nor ``part``.
    """
    counted = ("at", "before", "weight", "lead", "part")
    schema = T.StructType([*df.schema.fields, *T._parse_datatype_string(extra).fields, *(T.StructField(c, T.LongType()) for c in counted)])
    key, names = df.columns.index(group), schema.names

    def count(batches):
        part, last, at, before, lead = TaskContext.get().partitionId(), None, 0, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns, weights, leads = extend(batch)
            keys = batch.column(key)
            if last is None or keys[0].as_py() != last[0]:
                at, before, lead = 0, 0, int(leads[0])
            starts = np.concatenate([[0], _changes(keys)]).astype(np.int64)
            sizes = np.diff(np.append(starts, n))
            sums = np.cumsum(weights) - weights
            rows_at, rows_before = np.arange(n) - np.repeat(starts, sizes), sums - np.repeat(sums[starts], sizes)
            rows_lead = np.repeat(leads[starts], sizes)
            rows_at[: sizes[0]] += at
            rows_before[: sizes[0]] += before
            rows_lead[: sizes[0]] = lead
            last, at, before, lead = (keys[n - 1].as_py(),), int(rows_at[-1]) + 1, int(rows_before[-1] + weights[-1]), int(rows_lead[-1])
            numbers = [pa.array(np.asarray(c, np.int64)) for c in (rows_at, rows_before, weights, rows_lead, np.full(n, part))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, *numbers], names=names)

    ordered = [F.col(group).asc_nulls_first(), *order]
    path = scratch_path(df.sparkSession, "running")
    df.repartitionByRange(*ordered).sortWithinPartitions(*ordered).mapInArrow(count, schema).write.parquet(path)
    stored = df.sparkSession.read.schema(schema).parquet(path)
    earlier = Window.partitionBy("group").orderBy("part")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    runs = stored.groupBy(F.col(group).alias("group"), "part").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"), F.min("lead").alias("l"))
    later = runs.select(
        "group", "part", F.row_number().over(earlier).alias("k"), F.sum("n").over(before).alias("n"), F.sum("w").over(before).alias("w"),
        F.first("l").over(earlier).alias("l"),
    ).filter("k > 1")
    # At most one row for each boundary between tasks.
    joined = stored.alias("s").join(F.broadcast(later.alias("r")), (F.col("s.part") == F.col("r.part")) & F.col(f"s.{group}").eqNullSafe(F.col("r.group")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        *(F.col(f"s.{c}") for c in names[: -len(counted)]),
        (F.col("s.at") + F.coalesce("r.n", zero)).alias("at"), (F.col("s.before") + F.coalesce("r.w", zero)).alias("before"),
        "s.weight", F.coalesce("r.l", "s.lead").alias("lead"),
    )


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``at``, the 0-based position of each turn in its conversation."""

    def plain(batch):
        zeros = np.zeros(batch.num_rows, np.int64)
        return [], zeros, zeros

    found = running(clean_turns(conversations), "conv_id", turn_order(), plain, "")
    return found.drop("before", "weight", "lead")
