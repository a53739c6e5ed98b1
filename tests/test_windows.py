"""Window operators and global order against brute force."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brindle.operators import ordering, windows
from brindle.plans.studies import physical_plan
from brindle.session import as_table


def test_moving_average_counts_rows_not_days(spark):
    days = [date(2024, 1, 1) + timedelta(days=3 * i) for i in range(10)]
    df = spark.createDataFrame([("a", d, float(i)) for i, d in enumerate(days)], "k string, d date, v double")
    out = windows.moving_average(df, "k", "d", "v", out="m").orderBy("d").collect()
    assert [r["m"] for r in out] == [np.mean(range(max(0, i - 6), i + 1)) for i in range(10)]


def test_running_total_skips_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 2.0), ("a", 3, 3.0)], "k string, d int, v double")
    out = windows.running_total(df, "k", "d", "v", out="t").orderBy("d").collect()
    assert [r["t"] for r in out] == [None, 2.0, 5.0]


@pytest.mark.parametrize("method", ["rank", "row_number"])
def test_ranks_of_large_groups(many_parts, rows, method):
    """One group holds most rows and most of those tie, so runs cross sort tasks."""
    random.seed(3)
    data = [("hot", 1.0 if random.random() < 0.6 else random.choice([0.5, 2.0, 3.0, None]), i) for i in range(900)]
    data += [(random.choice("abc"), random.choice([1.0, 2.0]), i) for i in range(900, 1000)] + [(None, 1.0, 1001)]
    df = many_parts.createDataFrame(data, "g string, v double, id int").repartition(7)
    small = windows.ranked(df, ["g"], "v", method=method, tie_break=["id"])
    large = windows.ranked(df, ["g"], "v", method=method, tie_break=["id"], max_group=0)
    assert rows(large) == rows(small)
    assert large.select("g").count() == 1001
    stored = ordering._sorted_parts(df, "g", F.col("v").desc_nulls_last(), "id")
    assert stored.select("__part").distinct().count() > 2


def test_incomplete_tie_break_gives_one_order(many_parts, rows):
    """Numbers depend neither on row order nor on the size of the group."""
    data = [("g", 1.0, "t", i) for i in range(50)] + [("g", 2.0, "t", i) for i in range(50, 60)]
    df = many_parts.createDataFrame(random.Random(5).sample(data, len(data)), "g string, v double, t string, id int")
    small = windows.ranked(df, ["g"], "v", method="row_number", tie_break=["t"])
    large = windows.ranked(df.repartition(5), ["g"], "v", method="row_number", tie_break=["t"], max_group=0)
    assert rows(small) == rows(large)
    assert [r["id"] for r in small.orderBy("rnk").collect()] == [*range(50, 60), *range(50)]


def test_copies_spread_over_sort_tasks(many_parts, rows):
    df = many_parts.createDataFrame([("g", 1.0)] * 3000 + [("g", 2.0)] * 5, "g string, v double").repartition(8)
    out = windows.ranked(df, ["g"], "v", max_group=0)
    assert rows(out.groupBy("v", "rnk").count()) == [(1.0, 6, 3000), (2.0, 1, 5)]
    numbered = windows.ranked(df, ["g"], "v", max_group=0, method="row_number")
    assert sorted(r["rnk"] for r in numbered.collect()) == list(range(1, 3006))
    stored = as_table(df, "copies")
    parts = ordering._sorted_parts(stored.withColumn("__copy", F.monotonically_increasing_id()), "g", "v", "__copy")
    assert max(r["count"] for r in parts.groupBy("__part").count().collect()) < 1500


def test_dense_ids(many_parts):
    df = many_parts.range(500).select((F.col("id") * 7919 % 1009).alias("k"))
    out = ordering.dense_ids(df, "k").orderBy("k").collect()
    assert [r["id"] for r in out] == list(range(500))


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [5.0] * 300 + [7.0], list(map(float, range(997, 0, -1)))])
def test_quantiles_match_linear_interpolation(many_parts, values):
    df = many_parts.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    wanted = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    out = {r["probability"]: r["value"] for r in ordering.exact_quantiles(df, "v", wanted).collect()}
    assert out == pytest.approx(dict(zip(wanted, np.quantile(values, wanted))))


def test_quantiles_of_nothing(spark):
    assert ordering.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]).count() == 0


@pytest.mark.parametrize("sd", ["samp", "pop"])
@pytest.mark.parametrize("bound", [{}, {"max_rows": 0}])
def test_outliers_equal_the_window_form(spark, rows, sd, bound):
    random.seed(5)
    data = [("r", random.gauss(0, 1)) for _ in range(300)] + [("r", 50.0), ("one", 9.0), ("r", None)]
    df = spark.createDataFrame(data, "g string, v double")
    w = Window.partitionBy("g")
    dev = (F.stddev_samp if sd == "samp" else F.stddev_pop)("v").over(w)
    direct = df.where("v is not null").select("g", "v", (F.avg("v").over(w) + 3 * dev).alias("cut")).where("v > cut")
    assert rows(windows.outliers(df, ["g"], "v", sd=sd, **bound), "g", "v") == rows(direct, "g", "v")
    assert ("one", 9.0) not in rows(direct, "g", "v")


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", None, 9.0), ("a", 2, 1.0), ("a", 2, 4.0), ("b", None, 2.0)],
                               "k string, t int, v double")
    assert rows(windows.latest_per_key(df, ["k"], "t", ["v"])) == [("a", 2, 4.0), ("b", None, 2.0)]


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    top = windows.top_per_group(df, ["g"], 2, F.col("id").desc())
    assert "WindowGroupLimit" in physical_plan(top)
    assert top.count() == 6


def test_latest_slice(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "m int, v string")
    assert rows(windows.latest_slice(df, "m")) == [(2, "b"), (2, "c")]


@pytest.mark.parametrize("kind", ["spread", "few", "hot", "nan"])
def test_quantiles_sort_only_their_brackets(spark, kind, monkeypatch):
    """Exact for any distribution; of spread values only a few rows are sorted."""
    value = {"spread": "cast(id * 48271 % 65537 as double) / 7", "few": "cast(id % 3 as double)",
             "hot": "if(id % 3 = 0, 5.0D, cast(id as double))", "nan": "if(id % 50 = 0, double('NaN'), cast(id as double))"}[kind]
    df = spark.range(40_000).selectExpr(f"{value} as v").unionByName(spark.sql("select cast(null as double) as v"))
    sorted_rows = []
    inner = ordering._sorted_parts
    monkeypatch.setattr(ordering, "_sorted_parts", lambda rows, *order: (sorted_rows.append(rows.count()), inner(rows, *order))[1])
    wanted = [0.0, 0.001, 0.25, 0.5, 0.5, 0.95, 0.99, 1.0]
    got = sorted((r.probability, r.value) for r in ordering.exact_quantiles(df, "v", wanted).collect())
    values = sorted((r.v for r in df.where("v is not null").collect()), key=lambda v: (v != v, v))

    def at(p):
        place = p * (len(values) - 1)
        low = math.floor(place)
        high = min(low + 1, len(values) - 1)
        return values[low] + (place - low) * (values[high] - values[low])
    for (p, found), want in zip(got, sorted(wanted)):
        assert p == want and (found == pytest.approx(at(want)) or math.isnan(found) and math.isnan(at(want)))
    if kind == "spread":
        assert sum(sorted_rows) < 0.15 * len(values)


def test_brackets_widen_until_they_hold_the_rank(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SKETCH", 8)
    monkeypatch.setattr(ordering, "MARGINS", (0.0001, 0.01, 1.0))
    df = spark.range(20_000).selectExpr("cast(id * 7919 % 20011 as double) as v")
    values = sorted(r.v for r in df.collect())
    got = {r.probability: r.value for r in ordering.exact_quantiles(df, "v", [0.3, 0.7]).collect()}
    assert all(found == pytest.approx(np.quantile(values, p)) for p, found in got.items())


@pytest.fixture
def ten_tasks(many_parts):
    before = many_parts.conf.get("spark.sql.shuffle.partitions")
    many_parts.conf.set("spark.sql.shuffle.partitions", 10)
    yield many_parts
    many_parts.conf.set("spark.sql.shuffle.partitions", before)


ENTITIES = {"one": "'a'", "third": "if(id % 3 = 0, 'hot', concat('k', id % 40))", "null": "if(id % 3 = 0, null, 'b')", "each": "concat('k', id)"}


@pytest.mark.parametrize("entity", list(ENTITIES))
def test_entities_spread_over_tasks_equal_the_window(ten_tasks, rows, entity):
    """Also with fewer rows in a sort task than the halo needs (20 rows in ten tasks)."""
    for n, widths in ((400, (7,)), (20, (1, 30)), (0, (7,))):
        df = ten_tasks.range(n).selectExpr(f"{ENTITIES[entity]} AS k", "(id * 37) % 401 AS d", "if(id % 7 < 3, null, id % 11) AS v")
        for width in widths:
            plain = windows.moving_average(df, "k", "d", "v", out="m", rows=width)
            assert rows(windows.moving_average(df, "k", "d", "v", out="m", rows=width, max_group=0)) == rows(plain)
        plain = windows.running_total(df, "k", ["d"], "v", out="t")
        spread = windows.running_total(df, "k", ["d"], "v", out="t", max_group=0)
        assert rows(spread) == rows(plain) and spread.schema["t"].dataType == plain.schema["t"].dataType


def test_one_entity_runs_in_ten_tasks(ten_tasks):
    df = ten_tasks.range(4000).selectExpr("'a' AS k", "id AS d", "id % 11 AS v")
    sorted_rows = ordering._in_order(as_table(df, "rows"), "k", ["d"])
    sizes = [r["count"] for r in sorted_rows.groupBy("__part").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 800


def test_copies_of_a_row_are_totalled_one_by_one(ten_tasks):
    df = ten_tasks.range(300).selectExpr("'a' AS k", "1 AS d", "2 AS v")
    spread = windows.running_total(df, "k", "d", "v", out="t", max_group=0)
    assert sorted(r["t"] for r in spread.collect()) == list(range(2, 602, 2))


def test_max_group_keeps_small_entities_in_a_window(spark):
    df = spark.range(20).selectExpr("id % 2 AS k", "id AS d", "id AS v")
    assert "rangepartitioning" not in physical_plan(windows.running_total(df, "k", "d", "v", out="t", max_group=10))


@pytest.mark.parametrize("question", [windows.moving_average, windows.running_total])
def test_tasks_of_spread_entities_follow_the_rows(ten_tasks, rows, monkeypatch, question):
    """Sort tasks hold about as many rows however many there are, also where the session has few partitions."""
    monkeypatch.setattr(ordering, "TASK_ROWS", 100)
    many = []
    inner = ordering._sorted_parts

    def sorted_parts(*args, **kw):
        parts = inner(*args, **kw)
        many.append([r["count"] for r in parts.groupBy("__part").count().collect()])
        return parts
    monkeypatch.setattr(ordering, "_sorted_parts", sorted_parts)
    df = ten_tasks.range(4000).selectExpr("if(id % 3 = 0, 'a', 'b') AS k", "(id * 37) % 4001 AS d", "id % 11 AS v")
    spread = question(df, "k", "d", "v", out="o", max_group=0)
    assert rows(spread) == rows(question(df, "k", "d", "v", out="o"))
    assert len(many) == 1 and len(many[0]) > 30 and max(many[0]) < 200
