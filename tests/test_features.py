import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from trainlake.operators import features as feat
from trainlake.operators.models import feature_stages, fit_features, preflight
from trainlake.operators.ranks import positions


@pytest.fixture(scope="module")
def levels(spark):
    rows = [("b",)] * 3 + [("a",)] * 3 + [("c",)] + [(None,)] * 2
    return spark.createDataFrame(rows, "s string").withColumn("id", F.monotonically_increasing_id())


def test_index_by_frequency_then_level(levels):
    table = feat.fit_index(levels, ["s"]).table
    assert {r.level: r.idx for r in table.collect()} == {"a": 0, "b": 1, "c": 2}


def test_unknown_and_null_levels(spark, levels):
    index = feat.fit_index(levels, ["s"])
    other = spark.createDataFrame([("a",), ("z",), (None,)], "s string")
    assert [r.s_idx for r in feat.apply_index(other, index).collect()] == [0]
    kept = feat.apply_index(other, index, on_unknown="keep").collect()
    assert sorted(r.s_idx for r in kept) == [0, 3, 3]
    with pytest.raises(ValueError):
        feat.apply_index(other, index, on_unknown="error")


def test_ranged_positions_equal_the_window(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("g"), F.col("id"), (F.col("id") % 7).alias("v")
    )
    order = [F.desc("v"), F.col("id")]
    window = positions(df, "g", order, "p", 5000)
    ranged = positions(df, "g", order, "p", 5000, window_rows=100, partitions=9)
    assert ranged.select(*window.columns).exceptAll(window).isEmpty() and ranged.count() == 5000


def test_head_and_tail_lookup_equal_the_broadcast(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 11 == 0, None)
        .otherwise((F.col("id") % 300).cast("string")).alias("s"), "id",
    )
    index = feat.fit_index(df.filter("id < 3000"), ["s"], window_rows=50)
    for mode in ("skip", "keep"):
        small = feat.apply_index(df, index, on_unknown=mode)
        split = feat.apply_index(df, index, on_unknown=mode, broadcast_levels=20)
        assert split.select(*small.columns).exceptAll(small).isEmpty() and split.count() == small.count()


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "rows")
    df = spark.range(3000).select(
        "id", *(F.when(F.col("id") % k == 0, F.lit("hot")).when(F.col("id") % 13 == k, None).otherwise((F.col("id") * k % 700).cast("string")).alias(c) for c, k in (("a", 3), ("b", 5), ("c", 7))),
        (F.col("id") % 11).cast("double").alias("y"),
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_several_wide_columns_equal_the_broadcast_in_two_scans(wide):
    index = feat.fit_index(wide.filter("id < 2000"), ["a", "b", "c"])
    for mode in ("skip", "keep"):
        whole = feat.apply_index(wide, index, on_unknown=mode)
        split = feat.apply_index(wide, index, on_unknown=mode, broadcast_levels=15)
        assert split.columns == whole.columns and split.count() == whole.count()
        assert split.exceptAll(whole).isEmpty()
    split.write.format("noop").mode("overwrite").save()
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("Relation [id") <= 2


def test_rows_with_rare_levels_move_once_for_each_wide_column(wide):
    for columns in (["a"], ["a", "b", "c"]):
        index = feat.fit_index(wide, columns)
        plan = feat.apply_index(wide, index, broadcast_levels=15).select("id")._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan  # no row is put together again from parts


def test_no_rows_and_no_levels(spark, wide):
    index = feat.fit_index(wide.filter("id < 0"), ["a", "b"])
    assert feat.apply_index(wide, index).isEmpty()
    assert feat.apply_index(wide, index, on_unknown="keep").filter("a_idx <> 0 OR b_idx <> 0").isEmpty()
    groups = feat.fit_groups(wide.filter("id < 0"), ["a"], "y", 4)
    assert feat.apply_index(wide.filter("id < 9"), groups, on_unknown="keep").select("a_idx").distinct().first()[0] == 4


@pytest.mark.parametrize("window_rows", [50, 10_000])
def test_groups_are_cuts_of_the_levels_by_mean(wide, window_rows):
    found = feat.fit_groups(wide, ["a", "b"], "y", 6, window_rows=window_rows, partitions=5)
    for column in ("a", "b"):
        rows, levels = [r for r in wide.collect() if r[column] is not None], {}
        for r in rows:
            levels.setdefault(r[column], []).append(r.y)
        expected, before = {}, 0
        for level in sorted(levels, key=lambda v: (sum(levels[v]) / len(levels[v]), v)):
            expected[level] = before * 6 // len(rows)
            before += len(levels[level])
        assert {r.level: r.idx for r in found.of(column).collect()} == expected
    wider = feat.apply_index(wide, found, on_unknown="keep", broadcast_levels=10)
    assert wider.exceptAll(feat.apply_index(wide, found, on_unknown="keep")).isEmpty() and wider.agg(F.max("a_idx")).first()[0] == 6


@pytest.mark.parametrize(("one_hot", "mode"), [(True, "keep"), (True, "skip"), (False, "keep")])
def test_wide_columns_in_a_saved_pipeline(spark, wide, tmp_path, one_hot, mode):
    roles = feat.Roles(("a", "b"), ("id_",))
    rows = wide.withColumn("id_", F.col("id").cast("double"))
    fitted = fit_features(rows.filter("id < 2000"), roles, one_hot, wide_levels=100, on_unknown=mode, label="y", bins=9)
    path = str(tmp_path / "model")
    fitted.model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    first, second = (m.transform(rows).select("id", vector_to_array("features").alias("v")) for m in (fitted.model, again))
    assert first.exceptAll(second).isEmpty() and first.count() == second.count() > 0
    if one_hot:
        slots = sum(fitted.model.stages[0].n_values(c) for c in ("a", "b"))
        assert {r[0] for r in first.select(F.size("v")).distinct().collect()} == {slots + 1}
    else:
        assert first.agg(F.max(F.col("v")[0])).first()[0] == 8
    assert (first.count() == 3000) == (mode == "keep")


def test_last_level_has_no_slot(levels):
    index = feat.fit_index(levels, ["s"])
    slots = feat.one_hot_long(feat.apply_index(levels, index), "id", index, "s")
    assert sorted(r.slot for r in slots.collect()) == [0, 0, 0, 1, 1, 1]


def test_roles_report_and_guard(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 2.0, 3)], "s string, n double, price double, label double, k int")
    roles = feat.column_roles(df, "price")
    assert roles.categorical == ("s",) and roles.numeric == ("n",)
    assert roles.excluded == {"price": "label", "label": "derived from the label", "k": "type int"}
    assert feat.column_roles(df, "price", derived=["n"]).numeric == ()


def test_missing_numbers_are_named(spark):
    df = spark.createDataFrame([("a", None, float("nan"), 1.0)], "s string, x double, y double, z double")
    roles = feat.column_roles(df, "")
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        preflight(df, roles)
    assert feat.null_columns(df, ["s", "x", "y", "z"]) == ["x", "y"]
    assert fit_features(df, roles, one_hot=False, on_null="keep").inputs == ("sIndex", "x", "y", "z")


def test_no_column_is_left_out_unasked(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("address"), (F.col("id") % 90).cast("string").alias("city")
    )
    roles = feat.column_roles(df, "")
    assert roles.categorical == ("address", "city")
    assert preflight(df, roles) == pytest.approx({"address": 500, "city": 90}, rel=0.1)
    assert fit_features(df, roles, one_hot=False, wide_levels=100).inputs == ("addressIndex", "cityIndex")


def test_stage_inputs():
    roles = feat.Roles(("s",), ("n",))
    assert feature_stages(roles, one_hot=True)[1] == ["sOHE", "n"]
    assert feature_stages(roles, one_hot=False)[1] == ["sIndex", "n"]
