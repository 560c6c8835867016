from pyspark.sql import functions as F

from trainlake.operators.split import (
    bucket_folds, bucket_split, combine, fold_column, hash_split, random_split, with_buckets,
)


def test_parts_are_the_input_under_any_partitioning(spark):
    df = spark.range(5000).withColumn("key", F.col("id").cast("string"))
    parts = hash_split(df, F.col("key"), [0.6, 0.2, 0.2])
    assert combine(*parts).exceptAll(df).isEmpty() and sum(p.count() for p in parts) == 5000
    again = hash_split(df.repartition(13), F.col("key"), [0.6, 0.2, 0.2])
    for before, after in zip(parts, again):
        assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
    assert abs(parts[0].count() - 3000) < 150


def test_bucketed_split_and_folds_equal_the_hashed_ones(spark):
    df = spark.range(3000).withColumn("key", F.when(F.col("id") > 5, F.col("id").cast("string")))
    bucketed = with_buckets(df, F.col("key"))
    for weights in ([0.8, 0.2], [0.6, 0.2, 0.2], [1, 1, 1], [0.05, 0.95]):
        for a, b in zip(bucket_split(bucketed, weights), hash_split(df, F.col("key"), weights), strict=True):
            assert a.select("id", "key").exceptAll(b).isEmpty() and a.count() == b.count()
    folds = bucket_folds(bucketed.filter("key is not null"), 7).select("id", "key", "fold")
    assert folds.exceptAll(fold_column(df, F.col("key"), 7)).isEmpty()


def test_seed_changes_parts_and_null_keys_are_kept(spark):
    df = spark.range(1000).withColumn("key", F.when(F.col("id") > 10, F.col("id").cast("string")))
    one, two = (hash_split(df, F.col("key"), [0.5, 0.5], seed) for seed in (1, 2))
    assert not one[0].exceptAll(two[0]).isEmpty()
    assert sum(p.count() for p in one) == 1000


def test_folds_cover_all_rows_once(spark):
    df = fold_column(spark.range(3000), F.col("id"), folds=10)
    sizes = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(sizes) == set(range(10)) and sum(sizes.values()) == 3000
    assert min(sizes.values()) > 200


def test_split_needs_no_shuffle(spark):
    df = spark.range(10).withColumn("key", F.col("id").cast("string"))
    plan = hash_split(df, F.col("key"), [0.8, 0.2])[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_random_split_and_union_by_name(spark):
    parts = random_split(spark.range(1000), [0.8, 0.2])
    assert sum(p.count() for p in parts) == 1000
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    assert combine(a, a.select("s", "n")).filter("n = 1 and s = 'x'").count() == 2
