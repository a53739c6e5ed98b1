"""Ratings, model and blended recommendations against plain Python."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import als, filters, hybrid, ratings
from brindle.operators.factor_table import FactorTable
from brindle.operators.top_products import item_blocks, top_products
from brindle.plans.studies import physical_plan
from brindle.session import scratch_path
from brindle.sources import readers


def scores(spark, values):
    return spark.createDataFrame([(k, float(v)) for k, v in values.items()], "item_id int, score double")


def as_dict(df, key="item_id", value="score"):
    return {r[key]: r[value] for r in df.collect()}


def test_constant_scores_scale_to_zero(spark):
    same = scores(spark, {1: 0.5, 2: 0.5, 3: 0.5})
    assert as_dict(hybrid.scaled(same)) == {1: 0.0, 2: 0.0, 3: 0.0}
    assert as_dict(hybrid.scaled(same, single_score=1.0)) == {1: 1.0, 2: 1.0, 3: 1.0}


def test_scores_scale_to_their_range(spark):
    assert as_dict(hybrid.scaled(scores(spark, {1: 0, 2: 5, 3: 10}))) == pytest.approx({1: 0.0, 2: 0.5, 3: 1.0})


def test_blend_weights(spark):
    out = as_dict(hybrid.blended(scores(spark, {1: 1, 2: 0}), scores(spark, {1: 0, 2: 1})))
    assert out == pytest.approx({1: 0.7, 2: 0.3})


def test_blend_of_disjoint_items_keeps_the_union(spark):
    """A lone trending score has no range, so it scales to 0."""
    a, t = scores(spark, {1: 5, 2: 1}), scores(spark, {3: 10})
    assert as_dict(hybrid.blended(a, t)) == pytest.approx({1: 0.7, 2: 0.0, 3: 0.0})
    assert as_dict(hybrid.blended(a, t, single_score=1.0))[3] == pytest.approx(0.3)


def brute_force(user_scores, trending, k):
    def scale(d):
        lo, hi = (min(d.values()), max(d.values())) if d else (0, 0)
        return {i: 0.0 if hi - lo < 1e-9 else (s - lo) / (hi - lo) for i, s in d.items()}
    if user_scores is None:
        best = sorted(trending.items(), key=lambda e: (-e[1], e[0]))
        return [(i, round(s, 9)) for i, s in best[:k]]
    pool = dict(sorted(user_scores.items(), key=lambda e: (-e[1], e[0]))[:4 * k])
    a, t = scale(pool), scale(trending)
    best = {i: 0.7 * a.get(i, 0) + 0.3 * t.get(i, 0) for i in a.keys() | t.keys()}
    return [(i, round(s, 9)) for i, s in sorted(best.items(), key=lambda e: (-round(e[1], 12), e[0]))[:k]]


@pytest.mark.parametrize("n_trending", [0, 1, 3, 200])
def test_hybrid_top_k_equals_brute_force(spark, n_trending):
    random.seed(n_trending)
    k = 3
    trending = {i: float(random.randint(1, 60)) for i in random.sample(range(300), n_trending)}
    own = {u: {i: float(random.randint(1, 40)) for i in random.sample(range(300), size)}
           for u, size in ((1, 100), (2, 2), (3, 1), (4, 30))}
    table = spark.createDataFrame([(u, i, s) for u, d in own.items() for i, s in d.items()],
                                  "user_id int, item_id int, score double")
    users = spark.createDataFrame([(u,) for u in (1, 2, 3, 4, 9, 9)], "user_id int")
    out = hybrid.hybrid_top_k(users, table, scores(spark, trending), k=k)
    got = {}
    for r in out.orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append((r["item_id"], round(r["score"], 9)))
    expected = {u: brute_force(own.get(u), trending, k) for u in (1, 2, 3, 4, 9)}
    assert got == {u: e for u, e in expected.items() if e}


def factor_tables(spark, users=12, items=40, rank=4):
    rng = np.random.default_rng(1)
    u, i = rng.random((users, rank), dtype=np.float32), rng.random((items, rank), dtype=np.float32)
    make = lambda m: spark.createDataFrame([(n, [float(x) for x in row]) for n, row in enumerate(m)],
                                           "id int, features array<float>")
    return make(u), make(i), u @ i.T


def test_top_k_and_exclusion(spark):
    users, items, product = factor_tables(spark)
    model = als.model_from_factors(users, items, 4)
    wanted = spark.createDataFrame([(0,), (1,), (2,), (77,)], "user_id int")
    excluded = {0: set(range(0, 40, 2)), 1: {int(np.argmax(product[1]))}, 2: set(range(38))}
    table = spark.createDataFrame([(u, i) for u, s in excluded.items() for i in s], "user_id int, item_id int")
    for exclude in (None, table):
        got = {}
        for r in als.top_k(model, wanted, 5, exclude).orderBy("user_id", "rank").collect():
            got.setdefault(r["user_id"], []).append(r["item_id"])
        gone = excluded if exclude is not None else {}
        for u in (0, 1, 2):
            allowed = [i for i in np.argsort(-product[u]) if i not in gone.get(u, ())]
            assert got[u] == allowed[:5]
        assert 77 not in got


def test_pair_scores(spark):
    users, items, product = factor_tables(spark)
    pairs = spark.createDataFrame([(0, 3), (5, 39), (99, 1)], "user_id int, item_id int")
    got = {(r["user_id"], r["item_id"]): r["score"] for r in als.score_pairs(pairs, users, items).collect()}
    assert got == pytest.approx({(0, 3): float(product[0, 3]), (5, 39): float(product[5, 39])}, rel=1e-5)


def review_rows():
    random.seed(7)
    taste = {u: random.choice([1, 2]) for u in range(40)}
    return [(f"u{u}", f"i{i}", 5.0 if i % 2 == taste[u] % 2 else 2.0, 1000 + i)
            for u in range(40) for i in range(20) if (u + i) % 3]


def test_model_round_trip_and_tuning(spark):
    reviews = spark.createDataFrame(review_rows(), "reviewerID string, asin string, overall double, unixReviewTime long")
    indexed, users, items = ratings.index_ratings(ratings.clean_ratings(reviews))
    indexed = indexed.cache()
    train, test = filters.hash_split(indexed, ["user_id", "item_id"])
    model, error, params = als.fit_tuned(train, test)
    assert error < 1.5 and params["rank"] == 10
    grid = {"rank": [2, 3], "regParam": [0.1], "maxIter": [3]}
    _, tuned, best = als.fit_tuned(train, test, tune_above=0.0, grid=grid)
    assert best["rank"] in (2, 3) and tuned < 2.0
    path = scratch_path(spark, "model")
    als.save_artifacts(model, users, items, path)
    stored_users, stored_items = readers.read_factors(spark, path)
    assert stored_users.count() == 40 and stored_items.count() == 20
    lookup = FactorTable(spark, f"{path}/user_factors")
    assert lookup.of(users.limit(3)).count() == 3
    names, _ = readers.read_dictionaries(spark, path)
    recs = als.top_k(als.load_model(path), names, 3)
    assert recs.groupBy("user_id").count().where("count = 3").count() == 40
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_dictionaries(spark, path + "-missing")
    assert als.holdout_error(model, test.where("false")) == float("inf")


def test_clean_ratings(spark, rows):
    raw = spark.createDataFrame(
        [("u", "i", 3.0, 1), ("u", "i", 4.0, 2), ("u", "j", 0.5, 1), ("u", "k", 5.5, 1), (None, "i", 3.0, 1),
         ("u", None, 3.0, 1), ("v", "i", None, 1), ("v", "j", 5.0, None)],
        "reviewerID string, asin string, overall double, unixReviewTime long")
    assert rows(ratings.clean_ratings(raw)) == [("u", "i", 4.0, 2), ("v", "j", 5.0, None)]


def test_frequency_ids(many_parts):
    df = many_parts.createDataFrame([(k,) for k in "bbbaacczd"] + [(None,)], "key string")
    got = as_dict(ratings.frequency_ids(df, "key", "id"), "key", "id")
    assert got == {"b": 0, "a": 1, "c": 2, "d": 3, "z": 4}


def test_rating_events(spark):
    users = spark.createDataFrame([(0, "u"), (1, "v")], "user_id int, reviewerID string")
    items = spark.createDataFrame([(5, "i")], "item_id int, asin string")
    reviews = spark.createDataFrame([("u", "i", 3.0), ("v", "i", None), ("w", "i", 2.0), ("v", "x", 1.0), (None, "i", 1.0)],
                                    "reviewerID string, asin string, overall double")
    stamp = F.timestamp_millis(F.lit(1_700_000_000_123))
    events, skipped = ratings.rating_events(reviews, users, items, stamp=stamp)
    row = events.first()
    assert events.count() == 1 and skipped.first()["skipped"] == 2
    assert (row["user_id"], row["item_id"], row["rating"], row["event_time_ms"], row["user_key"]) == (
        0, 5, 3.0, 1_700_000_000_123, "u")


# --- factors in folders by id ------------------------------------------------------------

def test_factor_lookup_opens_the_wanted_folders_only(spark):
    ddl = "id int, features array<float>"
    factors = [(i, [float(i), 1.0]) for i in range(5000)] + [(None, [1.0, 1.0])]
    table = FactorTable.write(spark.createDataFrame(factors, ddl), scratch_path(spark, "f"), buckets=50)
    assert table.buckets == 50 and table.all().count() == 5000
    wanted = spark.createDataFrame([(7,), (7,), (4999,), (5000,), (None,)], "user_id int")
    found = table.of(wanted)
    assert sorted((r.user_id, list(r.features)) for r in found.collect()) == [(7, [7.0, 1.0]), (4999, [4999.0, 1.0])]
    filters = re.search(r"PartitionFilters: \[.*bucket#\d+ IN \(([\d,]+)\)", physical_plan(found)).group(1)
    assert 2 <= len(filters.split(",")) <= 3  # of 50 folders
    near = table._folders(spark.createDataFrame([(int(n),) for n in filters.split(",")], "__bucket int"))
    assert near.select(F.input_file_name()).distinct().count() == len(filters.split(","))  # one file each
    assert near.count() < 5000 * 5 // 50
    everyone = spark.range(-10, 6000).withColumnRenamed("id", "user_id")
    assert table.of(everyone).count() == 5000


def test_factor_tables_of_odd_content(spark, rows):
    ddl, path = "id int, features array<float>", scratch_path(spark, "f")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    empty = FactorTable.write(spark.createDataFrame([], ddl), path)
    assert empty.buckets == 0 and empty.of(users).columns == ["user_id", "features"] and empty.of(users).count() == 0
    table = FactorTable.write(spark.createDataFrame([(1, [2.0]), (-3, None)], ddl), path)  # replaces it
    assert table.buckets == 1 and rows(table.of(users)) == [(1, [2.0])] and table.of(users.limit(0)).count() == 0
    wider = FactorTable.write(spark.createDataFrame([(1, [3.0]), (2, [4.0])], ddl), path, buckets=7)
    assert FactorTable(spark, path).buckets == 7 and rows(wider.of(users)) == [(1, [3.0]), (2, [4.0])]
    plain = scratch_path(spark, "plain")
    users.write.parquet(plain)
    for wrong in (plain, plain + "-missing"):
        with pytest.raises(ValueError, match="no factors"):
            FactorTable(spark, wrong)


# --- products bounded by lengths --------------------------------------------------------

def _factors(spark, many, rank, seed, stretch=1.0):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-1, 1) * (stretch if i % 50 == 0 else 1.0) for _ in range(rank)]) for i in range(many)]


@pytest.mark.parametrize("items,users,wave", [(4096, 512, 64 << 20), (16, 8, 64 << 20), (16, 8, 1000)])
def test_top_products_equal_all_pairs(spark, items, users, wave):
    own, named = _factors(spark, 300, 4, 1), _factors(spark, 40, 4, 2)
    own += [(1000 + n, own[7][1]) for n in range(5)]  # equal scores
    gone = [(u, i) for u, _ in named for i in ([] if u % 4 else range(u, 300, 3))]
    ddl = "id int, features array<float>"
    blocks = item_blocks(spark.createDataFrame(own, ddl), items)
    wanted = spark.createDataFrame(named, ddl).withColumnRenamed("id", "user_id")
    exclude = spark.createDataFrame(gone, "user_id int, item_id int")
    got = top_products(wanted, blocks, 7, exclude, users_in_block=users, wave_bytes=wave).collect()
    f32 = lambda v: np.array(v, np.float32).astype(float)
    want = set()
    for user, vector in named:
        left = sorted((-float(f32(vector) @ f32(v)), i) for i, v in own if (user, i) not in set(gone))
        want |= {(user, n + 1, i) for n, (_, i) in enumerate(left[:7])}
    assert {(r.user_id, r.rank, r.item_id) for r in got} == want


def test_blocks_beyond_the_bound_are_not_multiplied(spark):
    """A few long vectors hold the best items, so most pairs of user and block are left out."""
    ddl = "id int, features array<float>"
    items = [(i, [20.0 + i % 3, 20.0]) if i % 100 == 0 else (i, [1.0, i % 7 / 7]) for i in range(2000)]
    users = spark.createDataFrame([(u, [1.0 + u, 2.0]) for u in range(30)], ddl).withColumnRenamed("id", "user_id")
    blocks = item_blocks(spark.createDataFrame(items, ddl), 20)
    for wave in (64 << 20, 2000):
        scored = spark.sparkContext.accumulator(0)
        got = top_products(users, blocks, 5, users_in_block=10, wave_bytes=wave, scored=scored)
        assert got.count() == 150 and all(r.item_id % 100 == 0 for r in got.collect())
        assert scored.value == 30  # of 30 x 100


def test_top_products_of_odd_tables(spark):
    ddl = "id int, features array<float>"
    none = spark.createDataFrame([], ddl)
    users = spark.createDataFrame([(1, [1.0]), (None, [1.0]), (2, None)], ddl).withColumnRenamed("id", "user_id")
    assert top_products(users, item_blocks(none), 3).count() == 0
    blocks = item_blocks(spark.createDataFrame([(5, [-1.0]), (6, [0.0]), (None, [3.0]), (7, None)], ddl))
    assert [tuple(r) for r in top_products(users, blocks, 3).orderBy("rank").collect()] == [(1, 1, 6, 0.0), (1, 2, 5, -1.0)]
    assert top_products(users.limit(0), blocks, 3).count() == 0
    gone = spark.createDataFrame([(1, 5), (1, 6)], "user_id int, item_id int")
    assert top_products(users, blocks, 3, gone).count() == 0
