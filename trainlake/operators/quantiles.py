"""Exact quantiles in bounded memory.

percentile_disc counts every distinct value in one aggregation buffer, which is
fine for room counts and impossible for a trillion prices. Here a quantile sketch
first brackets the wanted rank, the bracket is verified by counting, and
percentile_disc runs only over a bracket with few distinct values. The rows are read three times at most, by
all columns together: for the first bracket, to count it, and to write what lies in it; further
rounds read only that, a thousandth of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from trainlake.functions.numbers import nan_to_null
from trainlake.session import discard, materialise


@dataclass(frozen=True)
class _Bracket:
    """Bounds (both inclusive) known to hold the wanted rank, counted from `below`."""

    low: float
    high: float
    below: int
    inside: int
    distinct: int

    def within(self, c: Column) -> Column:
        return F.when((c >= F.lit(self.low)) & (c <= F.lit(self.high)), c)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    q: float = 0.5,
    max_distinct: int = 200_000,
    accuracy: int = 10_000,
) -> dict[str, float | None]:
    """The smallest value v of each column with at least q of its values <= v.

    NULL and NaN do not count. A column without values gives None.
    """
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    margin = 4.0 / accuracy
    around = [max(0.0, q - margin), min(1.0, q + margin)]
    first = values.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.approx_count_distinct(c).alias(f"d_{c}") for c in columns],
        *[F.min(c).alias(f"lo_{c}") for c in columns],
        *[F.max(c).alias(f"hi_{c}") for c in columns],
        *[F.percentile_approx(c, around, accuracy).alias(f"q_{c}") for c in columns],
    ).first()
    result: dict[str, float | None] = {c: None for c in columns if first[f"n_{c}"] == 0}
    rank = {c: max(1, math.ceil(q * first[f"n_{c}"])) for c in columns}
    found = {
        c: _Bracket(first[f"lo_{c}"], first[f"hi_{c}"], 0, first[f"n_{c}"], first[f"d_{c}"])
        for c in columns
        if c not in result
    }
    ready = {c: b for c, b in found.items() if b.distinct <= max_distinct}
    wide = {c: b for c, b in found.items() if c not in ready}
    if found:
        # The first brackets are known by now: they are counted while the narrow columns are picked.
        tries = {c: replace(b, low=first[f"q_{c}"][0], high=first[f"q_{c}"][1]) for c, b in wide.items()}
        second = values.agg(*_picks(ready, rank), *_facts(tries)).first()
        result.update({c: second[c] for c in ready})
        wide = {c: _settle(rank[c], wide[c], b, second[f"facts_{c}"], 0) for c, b in tries.items()}
    if wide:
        # From here on only rows in an open bracket are read.
        inside = materialise(_within(values, wide), "brackets")
        before = {c: b.below for c, b in wide.items()}
        while any(b.distinct > max_distinct for b in wide.values()):
            wide |= _narrow(inside, {c: b for c, b in wide.items() if b.distinct > max_distinct}, rank, accuracy, before)
        result.update(inside.agg(*_picks(wide, rank)).first().asDict())
        discard(inside)
    return {c: result[c] for c in columns}


def _within(values: DataFrame, brackets: dict[str, _Bracket]) -> DataFrame:
    """Values in their column's bracket, NULL elsewhere; rows without any are left out."""
    kept = values.select(*(b.within(F.col(c)).alias(c) for c, b in brackets.items()))
    return kept.dropna(how="all")


def _picks(brackets: dict[str, _Bracket], rank: dict[str, int]) -> list[Column]:
    """The value at each rank, exactly. The fraction in the middle of a rank's step avoids rounding at its edges."""
    return [
        F.expr(
            f"percentile_disc({(rank[c] - b.below - 0.5) / b.inside!r}D) "
            f"WITHIN GROUP (ORDER BY CASE WHEN `{c}` BETWEEN double('{b.low!r}') "
            f"AND double('{b.high!r}') THEN `{c}` END)"
        ).alias(c)
        for c, b in brackets.items()
    ]


def _facts(tries: dict[str, _Bracket]) -> list[Column]:
    return [_bracket_facts(F.col(c), b).alias(f"facts_{c}") for c, b in tries.items()]


def _narrow(
    values: DataFrame, wide: dict[str, _Bracket], rank: dict[str, int], accuracy: int, before: dict[str, int]
) -> dict[str, _Bracket]:
    """One sketch pass and one counting pass over the brackets still too wide."""
    margin = 4.0 / accuracy
    targets = {c: (rank[c] - b.below) / b.inside for c, b in wide.items()}
    sketched = values.agg(
        *[
            F.percentile_approx(
                b.within(F.col(c)),
                [max(0.0, targets[c] - margin), min(1.0, targets[c] + margin)],
                accuracy,
            ).alias(c)
            for c, b in wide.items()
        ]
    ).first()
    tries = {c: replace(b, low=sketched[c][0], high=sketched[c][1]) for c, b in wide.items()}
    counted = values.agg(*_facts(tries)).first()
    return {c: _settle(rank[c], wide[c], b, counted[f"facts_{c}"], before[c]) for c, b in tries.items()}


def _bracket_facts(c: Column, b: _Bracket) -> Column:
    """What one pass tells about a bracket: rows by side and edge, nearest values."""
    low, high = F.lit(b.low), F.lit(b.high)
    return F.struct(
        F.count_if(c < low).alias("below"),
        F.count(b.within(c)).alias("inside"),
        F.count_if(c == low).alias("at_low"),
        F.count_if(c == high).alias("at_high"),
        F.approx_count_distinct(b.within(c)).alias("distinct"),
        F.max(F.when(c < low, c)).alias("before_low"),
        F.min(F.when(c > low, c)).alias("after_low"),
        F.max(F.when(c < high, c)).alias("before_high"),
        F.min(F.when(c > high, c)).alias("after_high"),
    )


def _settle(rank: int, wide: _Bracket, b: _Bracket, seen: Row, before: int) -> _Bracket:
    """The part of the bracket that holds the rank; `before` rows lie below all that were counted.

    Edge values are split off, since either may hold most of the rows; so every
    round makes progress whatever the distribution.
    """
    below = before + seen.below
    above = below + seen.inside
    if rank <= below:  # the sketch was off: the rank lies left of its bracket
        return replace(wide, high=seen.before_low, inside=below - wide.below)
    if rank > above:
        inside = wide.below + wide.inside - above
        return replace(wide, low=seen.after_high, below=above, inside=inside)
    if rank <= below + seen.at_low:
        return _Bracket(b.low, b.low, below, seen.at_low, 1)
    if rank > above - seen.at_high:
        return _Bracket(b.high, b.high, above - seen.at_high, seen.at_high, 1)
    inner = seen.inside - seen.at_low - seen.at_high
    return _Bracket(
        seen.after_low, seen.before_high, below + seen.at_low, inner, seen.distinct
    )
