"""Readers, writers and the storage helpers."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brindle.functions.dates import utc_instant, utc_text
from brindle.session import as_table, delete_path, path_exists, release_scratch, scratch_path, shared_dir
from brindle.sources import readers, writers


def test_flights_csv(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        "FL_DATE,AIRLINE,AIRLINE_DOT,AIRLINE_CODE,DOT_CODE\n2023-01-01,Sky,Sky: SK,SK,7\n,Sky,,SK,\n")
    flights = readers.read_flights(spark, str(tmp_path), view="flights_csv")
    row = flights.where("FL_DATE is not null").first()
    assert (row["FL_DATE"], row["YEAR"], row["MONTH"], row["DAY_OF_WEEK"], row["DOT_CODE"]) == (
        date(2023, 1, 1), 2023, 1, 1, 7)
    assert len(flights.columns) == 35
    assert spark.sql("SELECT count(*) FROM flights_csv").first()[0] == 2


def test_quoted_reviews(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        ',asin,helpful,overall,reviewText,reviewTime,reviewerID,reviewerName,summary,unixReviewTime\n'
        '0,B1,"[0, 0]",5,"line one\nline ""two"", end","05 5, 2014",A1,Ann,ok,1399248000\n'
        '1,B2,"[0, 0]",bad,text,"01 6, 2014",A2,Bob,ok,oops\n')
    rows = sorted(tuple(r) for r in readers.read_reviews(spark, str(tmp_path)).collect())
    assert rows == [("A1", "B1", 5.0, 1399248000), ("A2", "B2", None, None)]


def test_read_sink(spark):
    path = scratch_path(spark, "sink")
    schema = "id bigint"
    assert readers.read_sink(spark, path, schema).count() == 0
    for _ in range(3):
        spark.range(10).coalesce(1).write.mode("append").parquet(path)
    assert readers.read_sink(spark, path, schema).count() == 30
    assert readers.read_sink(spark, path, schema, newest_files=2).count() == 20
    assert readers.read_sink(spark, path, schema, modified_after="2000-01-01T00:00:00").count() == 30


def test_partitioned_writer(spark):
    path = scratch_path(spark, "part")
    df = spark.range(100).withColumn("YEAR", (F.col("id") % 4 + 2020).cast("int"))
    writers.write_partitioned(df, path, "YEAR")
    assert path_exists(spark, f"{path}/YEAR=2022") and writers.succeeded(spark, path)
    writers.write_partitioned(df.limit(1), path, "YEAR", keep_existing=True)
    assert readers.read_parquet(spark, path, "by_year").count() == 100
    delete_path(spark, f"{path}/_SUCCESS")  # as a failed job leaves it
    writers.write_partitioned(df.limit(1), path, "YEAR", keep_existing=True)
    assert spark.read.parquet(path).count() == 1


def test_balanced(spark):
    path = scratch_path(spark, "one")
    spark.range(100).coalesce(1).write.parquet(path)
    scan = readers.balanced(spark.read.parquet(path))
    assert scan.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 64)
    assert readers.balanced(many, most_bytes=0) is many


def test_as_table(spark):
    table = as_table(spark.range(5), "t")
    assert table.inputFiles()[0].split("://")[-1].removeprefix("file:").startswith(shared_dir(spark).removeprefix("file:"))
    assert table.count() == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_helpers_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-05 01:02:03' AS t").select(utc_instant("t").alias("i"))
        row = df.select(F.unix_seconds("i").alias("s"), utc_text("i").alias("x")).first()
        assert (row["s"], row["x"]) == (1709600523, "2024-03-05 01:02:03")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_release_scratch(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    other = shared_dir(spark) + "/kept"
    spark.range(3).write.mode("overwrite").parquet(other)
    release_scratch(spark)
    assert not path_exists(spark, path) and path_exists(spark, other)


def test_size_for(spark, monkeypatch):
    from brindle import session

    shuffle, split = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"
    path = scratch_path(spark, "sized")
    spark.range(100_000).write.parquet(path)
    total = session.size_for(spark, path)
    assert total > 100_000 and int(spark.conf.get(shuffle)) == spark.sparkContext.defaultParallelism
    assert int(spark.conf.get(split)) == session.SPLIT_BYTES
    monkeypatch.setattr(session, "SHUFFLE_BYTES", total // 50)
    monkeypatch.setattr(session, "MAX_SCAN_TASKS", 1)
    monkeypatch.setattr(session, "SPLIT_BYTES", 1000)
    assert session.size_for(spark, path, path + "-missing") == total
    assert int(spark.conf.get(shuffle)) == 50 and int(spark.conf.get(split)) == total
    monkeypatch.undo()
    session.size_for(spark, path)
