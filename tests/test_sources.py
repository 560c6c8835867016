from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trainlake import session
from trainlake.operators.clean import clean_listing
from trainlake.sources.documents import collection_name, read_documents, text_field
from trainlake.sources.csv_ranges import read_listing_ranges
from trainlake.sources.listing import HOUSING, SHORT_STAY, ListingSpec, few_files, read_listing, stage_listing, write_listing_csv
from trainlake.sources.tables import ingest_if_absent, write_table


def test_discarded_tables_are_gone_and_others_stay(spark):
    kept, gone = session.materialise(spark.range(5), "a"), session.materialise(spark.range(6), "b")
    folder = gone._scratch
    session.discard(gone, gone, kept.filter("id > 1"))
    assert kept.count() == 5 and not Path(folder.removeprefix("file:")).exists()


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    (tmp_path / "l.csv").write_text('name,price,n\n"a ""b"",\nc","$1,200.50",3\nplain,"$7",\n')
    rows = {r.name: r for r in read_listing(spark, str(tmp_path / "l.csv")).collect()}
    assert set(rows) == {'a "b",\nc', "plain"}
    assert rows["plain"].n is None and rows['a "b",\nc'].price == "$1,200.50"


def test_no_task_writes_more_than_a_file_of_some_bytes(spark, tmp_path):
    df = spark.range(0, 1000, 1, 3).select("id", F.repeat(F.lit("a\n"), 50).alias("text"))
    assert few_files(df, F.octet_length("text")).rdd.getNumPartitions() == 1
    for file_bytes, files in ((50_000, 2), (10_000, 10)):
        several = few_files(df, F.octet_length("text"), file_bytes)
        assert several.rdd.getNumPartitions() == files and several.exceptAll(df).isEmpty() and several.count() == 1000
    write_listing_csv(several, str(tmp_path / "several"))
    assert read_listing_ranges(spark, str(tmp_path / "several"), df.schema).exceptAll(df).isEmpty()
    assert few_files(df.filter("id < 0"), F.octet_length("text")).isEmpty()


def test_staging_keeps_rows(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    assert stage_listing(df, str(tmp_path / "s"), partitions=3).exceptAll(df).count() == 0


def test_unknown_collection_fails_early():
    assert collection_name("Twitter-Sample.json") == "twitter-sample"
    with pytest.raises(ValueError, match="unknown collection"):
        text_field("other")


def test_nested_documents(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"interaction": {"content": "hello"}}\n{"interaction": {}}\n')
    df = read_documents(spark, str(tmp_path / "d.json"))
    assert [r[0] for r in df.select(text_field("twitter-sample")).na.drop().collect()] == ["hello"]


def test_ingest_once_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    ingest_if_absent(spark.range(3), path)
    ingest_if_absent(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    write_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_listing_layouts():
    assert len(HOUSING.keep) == 7 and len(HOUSING.impute) == 3
    assert len(SHORT_STAY.keep) == 22 and len(SHORT_STAY.impute) == 10
    for spec in (HOUSING, SHORT_STAY):
        assert set(spec.impute) < set(spec.keep) and spec.label in spec.keep


def test_clean_listing_drops_unusable_rows(spark):
    rows = [("$1,000.00", 2, 10), ("n/a", 1, 10), ("$0.00", 1, 10), (None, 1, 10), ("$5", None, 10), ("$5", 1, 400), ("$5", 1, None)]
    df = spark.createDataFrame(rows, "price string, rooms int, nights int")
    spec = ListingSpec(keep=("price", "rooms"), impute=("rooms",), caps=(("nights", 365),))
    out = clean_listing(df, spec)
    assert out.dtypes == [("price", "double"), ("rooms", "double"), ("rooms_na", "double")]
    assert sorted((r.price, r.rooms, r.rooms_na) for r in out.filter("rooms is not null").collect()) == [(1000.0, 2.0, 0.0)]
    assert out.filter("rooms is null").collect()[0].rooms_na == 1.0


def test_object_store_settings_come_from_the_environment():
    assert session.object_store_conf({}) == {}
    env = {"AWS_ACCESS_KEY_ID": "k", "AWS_SECRET_ACCESS_KEY": "s", "AWS_ENDPOINT_URL_S3": "http://store:9000"}
    conf = session.object_store_conf(env)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_spread_scan_leaves_large_scans_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    large = spark.range(0, 1000, 1, cores + 2)
    assert session.spread_scan(large) is large
    small = session.spread_scan(spark.range(0, 1000, 1, 1))
    assert small.rdd.getNumPartitions() == cores and small.distinct().count() == 1000


def test_scratch_is_in_the_shared_folder(spark):
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))
    df = spark.range(4)
    assert session.materialise(df, "x").count() == 4


CELLS = ["plain", "a,b", 'say "hi"', "line\nbreak", '"\n"', "\n\n", '",\n"', "x" * 300 + "\n" * 40 + '""', None, "  spaced ", "tail\n"]


@pytest.mark.parametrize("bytes_", [20, 64, 333, 5000, 1 << 20])
def test_csv_by_ranges_equals_the_plain_reader(spark, tmp_path, bytes_):
    schema = "id bigint, a string, b string"
    rows = spark.createDataFrame([(i, CELLS[i % 11], CELLS[i * 7 % 11]) for i in range(120)], schema)
    path = str(tmp_path / "csv")
    write_listing_csv(rows.coalesce(2), path)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    expected = read_listing(spark, path, schema).collect()
    try:
        for n, v in zip(names, (bytes_, 0)):
            spark.conf.set(n, str(v))
        found = read_listing_ranges(spark, path, schema)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected)) and len(expected) == 120
        if bytes_ < 100:
            assert spark.read.text(path).rdd.getNumPartitions() > 20
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_csv_ranges_of_windows_lines_blank_lines_and_open_quotes(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n3,"never closed\r\n4,w')
    found = read_listing_ranges(spark, str(tmp_path / "w.csv"), "a int, b string").orderBy("a").collect()
    assert [r.a for r in found] == [1, 2, 3] and found[1].b == "z" and found[0].b.replace("\r", "") == "x\ny"
    (tmp_path / "e.csv").write_text("a,b\n")
    assert read_listing_ranges(spark, str(tmp_path / "e.csv"), "a int, b string").isEmpty()
