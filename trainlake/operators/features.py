"""Column roles, category indexes, one-hot slots, assembled features.

Categories have two forms. The Spark ML stages (see models.py) hold all levels
on the driver, so they are for columns of known small cardinality. The index
table here is an ordinary table, so it works for any number of levels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake.operators.ranks import WINDOW_ROWS, positions, rows_before
from trainlake.session import materialise

BROADCAST_LEVELS = 500_000
BROADCAST_BYTES = 64 << 20


# --- roles -----------------------------------------------------------------


@dataclass(frozen=True)
class Roles:
    """Which columns are features, and why the others are not."""

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    excluded: Mapping[str, str] = field(default_factory=dict)

    def rows(self) -> list[tuple[str, str, str]]:
        """(column, role, reason) for each column."""
        return (
            [(c, "categorical", "string") for c in self.categorical]
            + [(c, "numeric", "double") for c in self.numeric]
            + [(c, "excluded", why) for c, why in self.excluded.items()]
        )


def column_roles(
    df: DataFrame, label: str, derived: Sequence[str] = (), exclude: Sequence[str] = ()
) -> Roles:
    """Strings are categorical, doubles other than the label are numeric.

    Columns of other types are reported as excluded. `derived` names columns
    computed from the label (a copy, a logarithm), which would leak it; a second
    column called "label" is taken for one.
    """
    categorical, numeric, excluded = [], [], {}
    for name, dtype in df.dtypes:
        if name == label:
            excluded[name] = "label"
        elif name in derived or name == "label":
            excluded[name] = "derived from the label"
        elif name in exclude:
            excluded[name] = "on request"
        elif dtype == "string":
            categorical.append(name)
        elif dtype == "double":
            numeric.append(name)
        else:
            excluded[name] = f"type {dtype}"
    return Roles(tuple(categorical), tuple(numeric), excluded)


def role_report(df: DataFrame, roles: Roles) -> DataFrame:
    """(column, role, reason, n_rows, n_null): roles with null counts, one pass."""
    listed = roles.rows()
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, (c, _, _) in enumerate(listed)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"), F.lit(role).alias("role"), F.lit(why).alias("reason"),
            F.col("n_rows"), F.col(f"null_{i}").alias("n_null"),
        )
        for i, (c, role, why) in enumerate(listed)
    ]
    return counts.select(F.inline(F.array(*entries)))


def null_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that hold a NULL or, for numbers, a NaN; one pass for all of them."""
    types = dict(df.dtypes)
    missing = {
        c: F.col(c).isNull() | F.isnan(c) if types[c] == "double" else F.col(c).isNull()
        for c in columns
    }
    if not missing:
        return []
    row = df.agg(*[F.coalesce(F.bool_or(m), F.lit(False)).alias(c) for c, m in missing.items()])
    return [c for c, found in row.first().asDict().items() if found]


# --- category indexes -------------------------------------------------------


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, level, freq) of the non-NULL levels.

    One scan for all columns; counts combine before the shuffle, so a level that
    a third of the rows share costs one row per task.
    """
    return (
        df.select(*columns)
        .unpivot([], list(columns), "column", "level")
        .filter(F.col("level").isNotNull())
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("freq"))
    )


@dataclass(frozen=True)
class LevelIndex:
    """Index table (column, level, freq, idx); by column, the number of levels and
    the bytes of the longest.

    `rank` names the column that numbers levels by falling frequency, where that is not the index itself;
    `values` tells how many indexes a column has, where that is not the number of its levels.
    """

    table: DataFrame
    sizes: Mapping[str, int]
    widths: Mapping[str, int]
    rank: str = "idx"
    values: Mapping[str, int] = field(default_factory=dict)

    def n_values(self, column: str) -> int:
        return self.values.get(column, self.sizes[column])

    def of(self, column: str) -> DataFrame:
        return self.table.filter(F.col("column") == column)


def fit_index(
    train: DataFrame,
    columns: Sequence[str],
    window_rows: int = WINDOW_ROWS,
    partitions: int | None = None,
) -> LevelIndex:
    """Number the levels of each column by falling frequency, equals by level.

    Above window_rows levels the numbering is spread over partitions.
    """
    counts = materialise(level_counts(train, columns), "levels")
    by_column = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("level")).alias("width")
    )
    found = {r["column"]: r for r in by_column.collect()}  # one row for each column
    sizes = {c: found[c]["n"] if c in found else 0 for c in columns}
    widths = {c: found[c]["width"] if c in found else 0 for c in columns}
    order = [F.desc("freq"), F.col("level")]
    largest = max(sizes.values())
    table = positions(counts, "column", order, "idx", largest, window_rows, partitions)
    if largest > window_rows:  # numbered once, not for each lookup
        table = materialise(table, "index", partition_by=["column"])
    return LevelIndex(table, sizes, widths)


def fit_groups(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    groups: int,
    window_rows: int = WINDOW_ROWS,
    partitions: int | None = None,
) -> LevelIndex:
    """Levels of each column ordered by their mean label and cut into groups of about as many rows.

    The index of a level is its group: the rows of the levels before it times groups, by the rows of all. Equal
    means are ordered by level. For squared error the best split of a category is a cut of its levels in this order, so a tree
    over the groups loses only the cuts inside a group. Rows without a label do not count.
    """
    known = train.filter(F.col(label).isNotNull()).select(*columns, F.col(label).cast("double").alias("_label"))
    by_level = (
        known.unpivot(["_label"], list(columns), "column", "level").filter(F.col("level").isNotNull())
        .groupBy("column", "level").agg(F.count(F.lit(1)).alias("freq"), F.avg("_label").alias("_mean"))
    )
    counts = materialise(by_level, "label-means")
    by_column = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("level")).alias("width"), F.sum("freq").alias("rows")
    )
    found = {r["column"]: r for r in by_column.collect()}  # one row for each column
    sizes = {c: found[c]["n"] if c in found else 0 for c in columns}
    widths = {c: found[c]["width"] if c in found else 0 for c in columns}
    largest = max(sizes.values())
    ranked = positions(counts, "column", [F.desc("freq"), F.col("level")], "rank", largest, window_rows, partitions)
    before = rows_before(ranked, "column", [F.col("_mean"), F.col("level")], "freq", "_before", largest, window_rows, partitions)
    total = F.create_map(*(x for c in columns for x in (F.lit(c), F.lit(found[c]["rows"] if c in found else 1))))
    group = F.floor(F.col("_before") * groups / total[F.col("column")]).cast("bigint")
    table = materialise(before.select("column", "level", "freq", "rank", group.alias("idx")), "groups", partition_by=["column"])
    return LevelIndex(table, sizes, widths, "rank", dict.fromkeys(columns, groups))


def apply_index(
    df: DataFrame,
    index: LevelIndex,
    columns: Sequence[str] | None = None,
    on_unknown: str = "skip",
    suffix: str = "_idx",
    broadcast_levels: int = BROADCAST_LEVELS,
) -> DataFrame:
    """Add <column>_idx. Rows with an unknown or NULL level are dropped ("skip")
    or get an index of their own, the number of known ones ("keep").

    Columns whose levels fit a broadcast are looked up where the rows are. Of the others, the
    most frequent levels are, too; rows with a rarer level in any of them are shuffled, once for each of these columns.
    """
    if on_unknown not in ("skip", "keep"):
        raise ValueError(f"on_unknown is 'skip' or 'keep', not {on_unknown!r}")
    columns = list(columns or index.sizes)
    outs = {c: c + suffix for c in columns}
    found = look_up(df, index, outs, broadcast_levels)
    if on_unknown == "skip":
        return found.dropna(subset=list(outs.values()))
    return found.withColumns({out: F.coalesce(out, F.lit(index.n_values(c)).cast("bigint")) for c, out in outs.items()})


def look_up(df: DataFrame, index: LevelIndex, outs: Mapping[str, str], broadcast_levels: int = BROADCAST_LEVELS) -> DataFrame:
    """Add what the index table has for the level in each column, under the name in outs; NULL for an unknown or NULL level."""
    # What is broadcast is bounded in rows and, by the longest level, in bytes, for all columns together.
    limits = {c: min(broadcast_levels, BROADCAST_BYTES // (max(index.widths[c], 1) * len(outs))) for c in outs}
    wide = [c for c in outs if index.sizes[c] > limits[c]]
    found = df
    for c in outs:
        levels = index.of(c)
        # Ranks go by frequency: the first ones are the hot levels.
        head = levels.filter(F.col(index.rank) < limits[c]) if c in wide else levels
        head = head.select(F.col("level").alias("_level"), F.col("idx").alias(outs[c]))
        found = found.join(F.broadcast(head), F.col(c) == F.col("_level"), "left").drop("_level")
    if wide:
        found = _rare_levels(found, index, wide, outs, limits)
    return found.select(*df.columns, *outs.values())


def _rare_levels(df: DataFrame, index: LevelIndex, wide: Sequence[str], outs: Mapping[str, str], limits: Mapping[str, int]) -> DataFrame:
    """Fill in the indexes of rare levels, with one join by level for each wide column.

    Rows without a rare level stay where they are. The others move once for each wide column, with nothing but the columns that
    are asked for later; where a row's level in the column is not a rare one, it moves by what it has in the other wide columns.
    """
    rare = {c: F.col(outs[c]).isNull() & F.col(c).isNotNull() for c in wide}
    some = reduce(Column.__or__, rare.values())
    key, level = "_key", "_level"
    found = df.filter(some)
    for k, c in enumerate(wide):
        name, known = F.col(c), F.col("level")
        if len(wide) > 1:  # what stands for another level than a rare one must be like none
            others = F.xxhash64(*(outs[o] for o in wide[:k]), *wide[k + 1 :])
            name, known = F.when(rare[c], F.concat(F.lit("="), name)).otherwise(others.cast("string")), F.concat(F.lit("="), known)
        tail = index.of(c).filter(F.col(index.rank) >= limits[c]).select(known.alias(level), F.col("idx").alias("_idx"))
        found = found.withColumn(key, name).join(tail, F.col(key) == F.col(level), "left")
        found = found.withColumn(outs[c], F.coalesce(outs[c], "_idx")).drop(key, level, "_idx")
    return df.filter(~some).unionByName(found)


# --- one-hot and assembled features -----------------------------------------


def _nonzero(entries: Sequence[Column]) -> Column:
    """Rows (slot, value) of a row's features that are not zero."""
    kept = F.filter(F.array(*entries), lambda e: e["value"] != 0)
    return F.inline(kept)


def _entry(slot: Column, value: Column) -> Column:
    return F.struct(slot.cast("bigint").alias("slot"), value.cast("double").alias("value"))


def one_hot_long(df: DataFrame, key: str, index: LevelIndex, column: str, suffix: str = "_idx") -> DataFrame:
    """(key, slot, 1.0) for each indexed row; the last level has no slot."""
    last = index.sizes[column] - 1
    idx = F.col(column + suffix)
    return df.filter(idx < last).select(key, idx.alias("slot"), F.lit(1.0).alias("value"))


def assembled_long(
    df: DataFrame,
    key: str,
    index: LevelIndex,
    categorical: Sequence[str],
    numeric: Sequence[str],
    one_hot: bool = True,
    suffix: str = "_idx",
) -> DataFrame:
    """(key, slot, value) of the non-zero features: the categories, then the numbers.

    One-hot categories take a slot for each level but the last, plain indexes one
    slot each. Row by row, never a dense vector.
    """
    entries, width = [], 0
    for c in categorical:
        idx = F.col(c + suffix)
        if one_hot:
            last = max(index.sizes[c] - 1, 0)
            entries.append(_entry(idx + width, (idx < last).cast("double")))
            width += last
        else:
            entries.append(_entry(F.lit(width), idx))
            width += 1
    for c in numeric:
        entries.append(_entry(F.lit(width), F.col(c)))
        width += 1
    return df.select(key, _nonzero(entries))
