"""Join semantics must not depend on which strategy the size check picks."""

import pytest
from pyspark.sql import functions as F

from brindle.operators import joins
from brindle.plans.studies import physical_plan

TINY = {"max_rows": 0}


@pytest.fixture
def fact(spark):
    # Key 1 holds two thirds of the rows; 99 and null match nothing.
    return spark.createDataFrame([(1, float(i)) for i in range(40)] + [(2, 5.0), (2, None), (99, 7.0), (None, 1.0)]
                                 + [(k, 1.0) for k in range(3, 19)], "k int, v double")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(k, f"n{k}") for k in range(1, 19)], "k int, name string")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_give_the_plain_join(fact, dim, rows, how):
    plain = rows(fact.join(dim, "k", how), "k", "v", "name")
    assert rows(joins.hot_key_join(fact, dim, "k", how, hot_share=0.1), "k", "v", "name") == plain
    assert rows(joins.hot_key_join(fact, dim, "k", how, hot_share=2.0), "k", "v", "name") == plain
    assert rows(joins.broadcast_join(fact, dim, "k", how, **TINY), "k", "v", "name") == plain


def test_size_check_picks_the_strategy(fact, dim):
    assert joins.fits_broadcast(dim) and not joins.fits_broadcast(dim, max_rows=3)
    assert not joins.fits_broadcast(dim, max_bytes=10)
    assert joins.fits_broadcast(dim.where("false"))
    assert "BroadcastHashJoin" in physical_plan(joins.broadcast_join(fact, dim, "k"))


def test_merge_join_is_sort_merge(fact, dim):
    plan = physical_plan(joins.merge_join(fact, dim, "k"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("strategy", ["broadcast", "merge"])
def test_average_equals_row_level_join(fact, dim, rows, strategy):
    twice = dim.union(dim.where("k = 2").withColumn("name", F.lit("n1")))  # one key, two names
    direct = fact.join(twice, "k").groupBy("name").agg(F.avg("v").alias("a"))
    pushed = joins.average_by_dimension(fact, twice, "k", "name", "v", out="a", strategy=strategy)
    assert rows(pushed) == rows(direct)


def test_average_with_default(fact, dim, rows):
    out = joins.average_by_dimension(fact, dim, "k", "name", "v", out="a", how="left",
                                     default="UNKNOWN", drop_null=True)
    assert ("UNKNOWN", 4.0) in rows(out) and ("n2", 5.0) in rows(out)


def test_average_of_all_null_group(spark, dim, rows):
    nulls = spark.createDataFrame([(1, None)], "k int, v double")
    assert rows(joins.average_by_dimension(nulls, dim, "k", "name", "v", out="a")) == [("n1", None)]


@pytest.mark.parametrize("bound", [{}, TINY])
def test_lookup_and_excluding(fact, dim, rows, bound):
    named = joins.lookup(fact, dim, "k", "name", default="UNKNOWN", **bound)
    assert named.count() == fact.count()
    assert named.where("name = 'UNKNOWN'").count() == 2
    left = joins.excluding(fact, dim.where("k = 1"), "k", **bound)
    assert left.count() == fact.count() - 40


def test_size_of_a_broadcast_side(spark):
    """Rows times 16 bytes a column, plus what strings, arrays and nested values hold."""
    from decimal import Decimal
    df = spark.createDataFrame(
        [(1, "é" * 10, bytearray(b"abc"), [1.0, 2.0], {"k": "v"}, Decimal("1.5")), (2, None, None, None, None, None)],
        "`a.b` int, s string, b binary, v array<float>, m map<string,string>, d decimal(30,2)")
    held = 2 * 6 * 16 + 20 + 3 + 16 + len('{"m":{"k":"v"}}') + len("{}")
    assert joins.fits_broadcast(df, max_bytes=held) and not joins.fits_broadcast(df, max_bytes=held - 1)
    assert not joins.fits_broadcast(df, max_rows=1) and joins.fits_broadcast(df.limit(0), max_bytes=0)
    numbers = spark.range(100)
    assert joins.fits_broadcast(numbers, max_bytes=1600) and not joins.fits_broadcast(numbers, max_bytes=1599)


def test_split_known(fact, dim):
    known, unknown = joins.split_known(fact, dim, "k")
    assert (known.count(), unknown.count()) == (58, 2)


def test_hot_keys_with_many_side_rows_are_salted(spark, rows):
    fact = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "id AS v")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "k string, w int")
    for how in ("inner", "left"):
        assert rows(joins.hot_key_join(fact, dim, "k", how), "k", "v", "w") == rows(fact.join(dim, "k", how), "k", "v", "w")


def test_hot_rows_spread_over_tasks(many_parts):
    """A third of the rows on one key, a third on null: no task of the join gets more than a part of either."""
    fact = many_parts.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "id AS v")
    dim = many_parts.range(9000).selectExpr("id AS k", "id AS w")
    joined = joins.hot_key_join(fact, dim.hint("merge"), "k", "left")
    sizes = joined.where("k = 1 OR k IS NULL").groupBy(F.spark_partition_id(), "k").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500


@pytest.mark.parametrize("hot_share", [0.1, 2.0])
def test_hot_key_join_reads_the_fact_twice(spark, dim, tmp_path, hot_share):
    """Once for the sketch, which needs the keys only, and once in the one join."""
    spark.range(300).selectExpr("if(id % 3 = 0, 1, cast(id AS int)) AS k", "id AS v").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = physical_plan(joins.hot_key_join(fact, dim, "k", hot_share=hot_share)).split("===")[0]
    assert plan.count("Scan parquet") == 2  # as listed in the tree and among the nodes
    assert "Union" not in plan


def test_keys_of_two_types_meet(spark, rows):
    fact = spark.range(400).selectExpr("cast(if(id % 2 = 0, 7, id) AS int) AS k", "id AS v")
    dim = spark.range(50).selectExpr("id AS k", "-id AS w")
    assert rows(joins.hot_key_join(fact, dim, "k"), "k", "v", "w") == rows(fact.join(dim, "k"), "k", "v", "w")
    pair = ["k", "j"]
    fact, dim = fact.selectExpr("k", "if(v % 5 = 0, null, 1.5D) AS j", "v"), dim.selectExpr("k", "1.5F AS j", "w")
    for how in ("inner", "left"):
        assert rows(joins.hot_key_join(fact, dim, pair, how), "k", "v", "w") == rows(fact.join(dim, pair, how), "k", "v", "w")


def test_heavy_hitters_miss_none(spark):
    """Over many small keys the sketch keeps every key with the share, its estimate never too small."""
    df = spark.range(200_000, numPartitions=7).selectExpr("CASE WHEN id % 50 = 0 THEN -1 WHEN id % 90 = 1 THEN -2 ELSE id END AS k")
    exact = {r["k"]: r["n"] / 200_000 for r in df.where("k < 0").groupBy("k").agg(F.count("k").alias("n")).collect()}
    found = joins.heavy_hitters(df, "k", 0.01)
    assert set(exact) == set(found)
    assert all(exact[k] <= found[k] <= exact[k] + 0.0025 for k in exact)
    assert joins.heavy_hitters(df.where("false"), "k", 0.01) == {}
    assert joins.heavy_hitters(df.selectExpr("cast(null AS long) AS k"), "k", 0.01) == {}
