import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from trainlake.operators.clean import missing_flags
from trainlake.operators.impute import fit_imputation
from trainlake.operators import quantiles
from trainlake.operators.quantiles import exact_quantiles


def frame(spark, columns):
    names = list(columns)
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def lower_quantile(values, q):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(q * len(kept))) - 1] if kept else None


def distributions(n=3000):
    rng = random.Random(7)
    return {
        "even": [rng.random() for _ in range(n)],
        "heavy_low": [0.0 if i % 3 else rng.random() for i in range(n)],
        "heavy_edges": [0.0 if i % 2 else 1.0 for i in range(n - 40)] + [rng.random() for _ in range(40)],
        "tails": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(n)],
        "infinite": [rng.choice([math.inf, -math.inf, rng.random()]) for _ in range(n)],
        "holes": [rng.choice([None, math.nan, rng.gauss(0, 1)]) for _ in range(n)],
        "one": [5.0] * n,
        "none": [None] * n,
    }


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 1.0])
def test_quantiles_are_exact_when_narrowed(spark, q):
    columns = distributions()
    df = frame(spark, columns).repartition(7)
    found = exact_quantiles(df, list(columns), q, max_distinct=20, accuracy=50)
    assert found == {c: lower_quantile(v, q) for c, v in columns.items()}


def test_rows_are_read_three_times_at_most(spark, monkeypatch):
    columns = {k: v for k, v in distributions().items() if k in ("even", "holes", "tails")}
    df = frame(spark, columns).withColumn("marked", F.lit("source"))
    scans, agg, write = [], DataFrame.agg, quantiles.materialise
    monkeypatch.setattr(DataFrame, "agg", lambda self, *e: scans.append(self) or agg(self, *e))
    monkeypatch.setattr(quantiles, "materialise", lambda d, label: scans.append(d) or write(d, label))
    found = exact_quantiles(df, list(columns), 0.5, max_distinct=2, accuracy=50)
    assert found == {c: lower_quantile(v, 0.5) for c, v in columns.items()}
    whole = [s for s in scans if "LogicalRDD" in s._jdf.queryExecution().analyzed().toString()]
    assert len(whole) == 3 < len(scans)


def test_median_is_the_lower_of_two(spark):
    df = frame(spark, {"a": [1.0, 2.0, 3.0, 10.0]})
    assert fit_imputation(df, ["a"]).values == {"a": 2.0}
    assert fit_imputation(df, ["a"], relative_error=0.001).values == {"a": 2.0}


def test_flags_are_for_null_and_fills_for_nan_too(spark):
    df = frame(spark, {"a": [1.0, 1.0, 3.0, None, math.nan]})
    flagged = missing_flags(df, ["a"])
    filled = fit_imputation(flagged, ["a"], "mode").apply(flagged)
    assert sorted((r.a, r.a_na) for r in filled.collect()) == [(1.0, 0.0), (1.0, 0.0), (1.0, 0.0), (1.0, 1.0), (3.0, 0.0)]
    assert missing_flags(df, ["a"], flag_nan=True).filter("a_na = 1").count() == 2


def test_mode_takes_the_smallest_of_equals_and_mean_skips_holes(spark):
    df = frame(spark, {"a": [4.0, 4.0, -2.0, -2.0, 9.0, None, math.nan]})
    assert fit_imputation(df, ["a"], "mode").values == {"a": -2.0}
    assert fit_imputation(df, ["a"], "mean").values["a"] == pytest.approx(2.6)


def test_empty_column_is_named(spark):
    df = frame(spark, {"a": [1.0], "b": [None]})
    for strategy in ("median", "mean", "mode"):
        with pytest.raises(ValueError, match=r"\['b'\]"):
            fit_imputation(df, ["a", "b"], strategy)
    with pytest.raises(ValueError, match="unknown strategy"):
        fit_imputation(df, ["a"], "max")


def test_nothing_is_missing_afterwards(spark):
    columns = {k: v for k, v in distributions(500).items() if k not in ("none", "infinite")}
    df = missing_flags(frame(spark, columns), list(columns))
    filled = fit_imputation(df, list(columns)).apply(df)
    holes = [F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in columns]
    assert set(filled.agg(*holes).first()) == {0}
    nulls = sum(v is None for v in columns["holes"])
    assert filled.agg(F.sum("holes_na")).first()[0] == nulls
