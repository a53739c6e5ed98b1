"""Null, tie and empty-group rules of the aggregates."""

from datetime import date

from pyspark.sql import functions as F

from brindle.operators import aggregates, filters, reports


def flights(spark):
    return spark.createDataFrame(
        [("A", 10.0, 0.0), ("A", 20.0, 1.0), ("B", None, 1.0), ("B", None, None), ("C", 30.0, 0.0)],
        "carrier string, delay double, cancelled double")


def test_summary_of_all_null_group_is_null(spark, rows):
    out = aggregates.summary(flights(spark), ["carrier"], "delay", "cancelled")
    assert rows(out)[1] == ("B", 2, 1.0, None, None, None)


def test_group_average_null_groups(spark, rows):
    assert rows(aggregates.group_average(flights(spark), ["carrier"], "delay", out="a")) == [
        ("A", 15.0, 2), ("C", 30.0, 1)]
    assert ("B", None, 2) in rows(aggregates.group_average(flights(spark), ["carrier"], "delay", out="a",
                                                           drop_null=False))


def test_top_groups_having_and_ties(spark):
    df = spark.createDataFrame([(k, 5.0) for k in "cabcab"] + [("z", 9.0)], "k string, v double")
    out = aggregates.top_groups(df, ["k"], "v", out="a", min_count=1, k=2)
    assert [r["k"] for r in out.collect()] == ["a", "b"]
    assert aggregates.top_groups(df, ["k"], "v", out="a", min_count=None, k=1).first()["k"] == "z"


def test_above_overall_average_is_strict(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0), ("d", None)], "k string, v double")
    assert rows(aggregates.above_overall_average(df, "k", "v", out="m")) == [("b", 3.0)]


def test_largest_total_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [("tie", 2.0, 2.0, 1.0), ("null", None, None, None), ("part", None, -5.0, -7.0), ("last", 0.0, 1.0, 4.0)],
        "k string, x double, y double, z double")
    out = aggregates.largest_total(df, "k", ["x", "y", "z"], out="top", keep_totals=False)
    assert rows(out) == [("last", "z"), ("null", None), ("part", "y"), ("tie", "x")]


def test_spread_of_one_row(spark):
    one = spark.createDataFrame([("a", 4.0)], "k string, v double")
    assert aggregates.spread(one, ["k"], "v").first()["sd"] is None
    assert aggregates.spread(one, ["k"], "v", sd="pop").first()["sd"] == 0.0


def test_per_day_null_rules(spark, rows):
    df = spark.createDataFrame([("a", date(2024, 1, 1), None), ("a", date(2024, 1, 2), 2.0)],
                               "k string, d date, v double")
    sums = aggregates.per_day(df, "k", "d", "v", out="s", how="sum")
    assert [r[2] for r in rows(sums)] == [None, 2.0]
    zero = aggregates.per_day(df, "k", "d", "v", out="s", how="sum", null_as_zero=True)
    assert [r[2] for r in rows(zero)] == [0.0, 2.0]


def test_share_and_pivot_and_rmse(spark, rows):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("a", None)], "k string, v double")
    assert rows(aggregates.share_within(df, ["k"], "v", 15, out="s")) == [("a", 0.5)]
    log = spark.createDataFrame([("q", "SQL", 2.0), ("q", "SQL", 1.0), ("q", "RDD", 9.0), ("q", "X", 0.1)],
                                "query string, api string, seconds double")
    pivot = aggregates.pivot_min(log, "query", "api", "seconds", ["RDD", "DataFrame", "SQL"])
    assert rows(pivot) == [("q", 9.0, None, 1.0)]
    pred = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, float("nan"))], "y double, p double")
    assert aggregates.rmse(pred, "y", "p").first()[0] == 0.5 ** 0.5


def test_key_profile_and_distinct_counts(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "k int, c string")
    assert rows(aggregates.key_profile(df, "k", "c")) == [(1, 2, "a"), (2, 1, None)]
    assert rows(aggregates.distinct_counts(df, "k", "c")) == [(3, 2, 2)]
    assert aggregates.distinct_counts(df, "k", approximate=True).first()["distinct_k"] == 2


def test_filters(spark, rows):
    df = spark.createDataFrame([("a", 1.0), (None, 3.0), ("b", 5.5), ("c", None), ("d", 5.0)], "k string, v double")
    assert rows(filters.valid_range(df, "v", 1, 5, "k")) == [("a", 1.0), ("d", 5.0)]
    text = spark.createDataFrame([("x",), ("  \t",), (" ",), ("",), (None,)], "line string")
    assert rows(filters.non_blank(text, "line")) == [("x",)]


def test_hash_share_and_split(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 100)
    kept = filters.hash_share(df, ["k"], 1, 4)
    assert 0 < kept.count() < 1000
    assert kept.groupBy("k").count().where("count != 10").count() == 0  # whole keys
    train, test = filters.hash_split(df, ["id"])
    assert train.count() + test.count() == 1000 and train.join(test, "id").count() == 0
    assert 0.7 < train.count() / 1000 < 0.9


def test_histogram_edges(spark, rows):
    df = spark.createDataFrame([(0.0,), (10.0,), (9.9,), (None,)], "v double")
    assert [(r[0], r[3]) for r in rows(reports.histogram(df, "v", 10))] == [(0, 1), (9, 2)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert rows(reports.histogram(flat, "v"), "bin", "n") == [(0, 2)]
    lat = spark.createDataFrame([(1,), (6000,)], "latency_ms long")
    assert rows(reports.over_budget(lat)) == [(2, 0.5)]


def test_report_snapshots(spark, rows):
    recs = spark.createDataFrame([(1, 1, 0), (2, 1, 7), (1, 2, 7), (1, 1, 7)], "user_id int, rank int, batch_id int")
    assert [tuple(r) for r in reports.newest_recommendations(recs, 2).collect()] == [(1, 1, 7), (1, 2, 7)]
