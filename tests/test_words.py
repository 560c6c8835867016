import random

from pyspark.sql import functions as F

from trainlake.functions.stopwords import stopwords
from trainlake.functions.words import clean_steps, letter_words
from trainlake.operators import trend


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "text string")


def words_of(spark, value, **options):
    rows = trend.tokens(texts(spark, value), F.col("text"), **options)
    return [r.word for r in rows.collect() if r.word]


def test_one_pass_words_equal_the_steps(spark):
    rng = random.Random(1)
    pieces = ["http", "https://a.b/c?d=1", "HTTP://X.y", "é", "K", "İ", "word", "Don't", " ", "  ", "\n", "\t", ",", "9", "-", "ttp"]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    df = texts(spark, *values, "", "http", "httphttp://x y", "a http b", "x,http://y,z w")
    steps = F.filter(F.split(clean_steps(F.col("text")), " "), lambda w: w != "")
    fused = F.filter(letter_words(F.col("text")), lambda w: w != "")
    assert df.filter(steps != fused).count() == 0


def test_upper_case_addresses_stay_unless_asked(spark):
    assert words_of(spark, "see HTTP://site.org now") == ["see", "http", "site", "org", "now"]
    assert words_of(spark, "see HTTP://site.org now", ignore_case=True) == ["see", "now"]


def test_accents_part_words_unless_asked(spark):
    assert words_of(spark, "Café-también") == ["caf", "tambi", "n"]
    assert words_of(spark, "Café-también", letters="unicode") == ["café", "también"]


def test_trending_drops_null_short_and_stopwords(spark):
    df = texts(spark, "Data data the with lake", None, "data LAKE couldn't x", "could")
    rows = trend.trending(df).collect()
    assert [(r.word, r["count"]) for r in rows] == [("data", 3), ("lake", 2), ("could", 1)]


def test_equal_counts_go_by_word_and_top_limits(spark):
    df = texts(spark, "zeta alpha beta alpha")
    assert [r.word for r in trend.trending(df, top=2).collect()] == ["alpha", "beta"]


def test_own_stopwords_and_length(spark):
    df = texts(spark, "one three five")
    rows = trend.word_counts(df, stop=["five"], length=1).collect()
    assert {r.word for r in rows} == {"one", "three"}
    assert trend.word_counts(df, stop=[], length=5).count() == 1


def test_clean_text_keeps_rows_with_text(spark):
    rows = trend.clean_text(texts(spark, "A1, b!", None)).collect()
    assert [r.text for r in rows] == ["a   b"]


def test_stopwords_need_no_session():
    assert list(stopwords()) == sorted(set(stopwords())) and len(stopwords()) == 597
    assert {"echt", "couldn", "niet", "with", "sobre"} <= set(stopwords())
    assert not {"could", "would"} & set(stopwords())


def test_hot_words_are_combined_before_the_shuffle(spark):
    plan = trend.word_counts(texts(spark, "a"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Exchange hashpartitioning(word" in plan
    assert "BroadcastHashJoin" in plan
