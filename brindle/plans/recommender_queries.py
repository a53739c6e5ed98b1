"""Catalog: ratings, model and hybrid recommendations on the events and embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators import als, filters, hybrid, joins, ratings, reports
from brindle.operators.factor_table import FactorTable
from brindle.operators.windows import latest_per_key, top_per_group
from brindle.plans.catalog import Tables, bigint, query, rounded
from brindle.session import as_table, scratch_path
from brindle.sources import readers


def raw_reviews(t: Tables) -> DataFrame:
    """Events as reviews with string keys; ratings 0 to 5, of which 0 is invalid."""
    return t.events.select(
        F.concat(F.lit("u"), "user_id").alias("reviewerID"),
        F.concat(F.lit("i"), F.get_json_object("props", "$.k")).alias("asin"),
        (F.floor("value") % 6).cast("double").alias("overall"),
        F.col("event_id").alias("unixReviewTime"))


def event_ratings(t: Tables) -> DataFrame:
    """Rated events with integer ids, latest per user and item."""
    rows = t.events.select(
        F.col("user_id").cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        (1 + F.floor("value") % 5).cast("double").alias("rating"),
        F.col("event_id").alias("at"))
    return latest_per_key(rows, ["user_id", "item_id"], "at").drop("at")


_REVIEWS = """(SELECT 'u' || user_id AS reviewerID, 'i' || regexp_extract(props, '[0-9]+') AS asin,
    CAST(CAST(floor(value) AS BIGINT) % 6 AS DOUBLE) AS overall, event_id AS unixReviewTime FROM events)"""
_CLEAN = f"""(SELECT * FROM {_REVIEWS} WHERE overall BETWEEN 1 AND 5 QUALIFY row_number() OVER (
    PARTITION BY reviewerID, asin ORDER BY unixReviewTime DESC) = 1)"""


def _ids(key: str, out: str) -> str:
    return f"""(SELECT row_number() OVER (ORDER BY count(*) DESC, {key}) - 1 AS {out}, {key}
                FROM {_CLEAN} GROUP BY {key})"""


@query(f"SELECT * FROM {_CLEAN}")
def clean_ratings(t):
    return ratings.clean_ratings(raw_reviews(t))


@query(f"SELECT * FROM {_ids('reviewerID', 'user_id')}")
def user_dictionary(t):
    return ratings.frequency_ids(ratings.clean_ratings(raw_reviews(t)), "reviewerID", "user_id") \
        .withColumns(bigint("user_id"))


@query(f"SELECT * FROM {_ids('asin', 'item_id')}")
def item_dictionary(t):
    return ratings.frequency_ids(ratings.clean_ratings(raw_reviews(t)), "asin", "item_id") \
        .withColumns(bigint("item_id"))


@query(f"""SELECT c.*, user_id, item_id FROM {_CLEAN} c JOIN {_ids('reviewerID', 'user_id')} USING (reviewerID)
           JOIN {_ids('asin', 'item_id')} USING (asin)""")
def indexed_ratings(t):
    clean = as_table(ratings.clean_ratings(raw_reviews(t)), "ratings")
    indexed, _, _ = ratings.index_ratings(clean)
    return indexed.withColumns(bigint("user_id", "item_id"))


def _replay(t: Tables):
    """Reviews against dictionaries that only know users and items with a high value."""
    high = t.events.where(F.col("value") > 200)
    users = high.select(F.col("user_id").cast("int").alias("user_id"),
                        F.concat(F.lit("u"), "user_id").alias("reviewerID")).distinct()
    item = F.get_json_object("props", "$.k")
    items = high.select(item.cast("int").alias("item_id"), F.concat(F.lit("i"), item).alias("asin")).distinct()
    reviews = raw_reviews(t).withColumn("overall", F.when(F.col("overall") > 0, F.col("overall")))
    return ratings.rating_events(reviews, as_table(users, "users"), as_table(items, "items"),
                                 stamp=F.timestamp_millis("unixReviewTime"))


_REPLAY = f"""(SELECT CAST(substr(reviewerID, 2) AS BIGINT) AS user_id, CAST(substr(asin, 2) AS BIGINT) AS item_id,
    overall AS rating, unixReviewTime AS event_time_ms, reviewerID AS user_key, asin AS item_key
  FROM {_REVIEWS} WHERE overall > 0)"""
_LISTED = """user_id IN (SELECT user_id FROM events WHERE value > 200) AND item_id IN
  (SELECT CAST(regexp_extract(props, '[0-9]+') AS BIGINT) FROM events WHERE value > 200)"""


@query(f"SELECT * FROM {_REPLAY} WHERE {_LISTED}")
def replay_events(t):
    events, _ = _replay(t)
    return events.drop("timestamp").withColumns(bigint("user_id", "item_id"))


@query(f"SELECT count(*) AS skipped FROM {_REPLAY} WHERE NOT ({_LISTED})")
def replay_skipped(t):
    return _replay(t)[1]


# --- factors ---------------------------------------------------------------------------

def _factors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))


@query("""SELECT user_id, item_id, round(list_dot_product(CAST(u.embedding AS DOUBLE[]),
            CAST(i.embedding AS DOUBLE[])), 6) + 0.0::DOUBLE AS score
          FROM (SELECT DISTINCT user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id FROM events)
          JOIN embeddings u ON u.vec_id = user_id JOIN embeddings i ON i.vec_id = item_id""")
def stored_factor_scores(t):
    """Factors written, read back and multiplied for every rated pair."""
    path = scratch_path(t.spark, "factors")
    for side in ("user_factors", "item_factors"):
        _factors(t).write.parquet(f"{path}/{side}")
    users, items = readers.read_factors(t.spark, path)
    pairs = event_ratings(t).select("user_id", "item_id")
    scored = als.score_pairs(pairs, users, items).withColumns(bigint("user_id", "item_id"))
    return scored.withColumn("score", F.round("score", 6) + F.lit(0.0))  # no negative zero


@query("""SELECT vec_id AS user_id, round(list_sum(CAST(embedding AS DOUBLE[])), 4) + 0.0::DOUBLE AS total FROM embeddings
          WHERE vec_id IN (SELECT user_id FROM events WHERE value > 200)""")
def factor_lookup(t):
    """Factors stored in folders by id; only the folders of the wanted users are read."""
    table = FactorTable.write(_factors(t), scratch_path(t.spark, "factor-table"), buckets=64)
    found = table.of(t.events.where(F.col("value") > 200).select("user_id"))
    total = F.aggregate("features", F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double"))
    return found.select(F.col("user_id").cast("long").alias("user_id"), (F.round(total, 4) + F.lit(0.0)).alias("total"))


def _nearest_sql(extra: str) -> str:
    return f"""SELECT u.vec_id AS user_id, i.vec_id AS item_id, row_number() OVER (PARTITION BY u.vec_id
                 ORDER BY list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) DESC) AS rank
               FROM embeddings u, embeddings i WHERE {extra} QUALIFY rank <= 5"""


def _top(t: Tables, exclude: DataFrame | None) -> DataFrame:
    factors = _factors(t)
    model = als.model_from_factors(factors, factors, 64)
    best = als.top_k(model, factors.select(F.col("id").alias("user_id")), 5, exclude)
    return best.drop("score").withColumns(bigint("user_id", "item_id", "rank"))


@query(_nearest_sql("TRUE"))
def factor_top_k(t):
    return _top(t, None)


@query(_nearest_sql("i.vec_id NOT IN (u.vec_id, u.vec_id + 1, u.vec_id + 2)"))
def factor_top_k_excluding(t):
    """Excludes the vector itself and its two successors."""
    own = F.col("vec_id").cast("int")
    gone = F.explode(F.array(own, own + 1, own + 2))
    return _top(t, t.embeddings.select(own.alias("user_id"), gone.alias("item_id")))


# --- blending -------------------------------------------------------------------------

def _score_tables(t: Tables):
    """Given scores: summed value per user and item, and per item."""
    rows = t.events.select(F.col("user_id").cast("int").alias("user_id"), "value",
                           F.get_json_object("props", "$.k").cast("int").alias("item_id"),
                           F.floor("value").alias("v"))
    own = rows.groupBy("user_id", "item_id").agg(F.sum("v").cast("double").alias("score"))
    trend = rows.groupBy("item_id").agg(F.sum("v").cast("double").alias("score"))
    return rows, as_table(own, "scores"), as_table(trend, "trend")


_RAW = """(SELECT user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id, value,
    CAST(floor(value) AS BIGINT) AS v FROM events)"""
_OWN = f"(SELECT user_id, item_id, CAST(sum(v) AS DOUBLE) AS score FROM {_RAW} GROUP BY ALL)"
_TREND = f"(SELECT item_id, CAST(sum(v) AS DOUBLE) AS score FROM {_RAW} GROUP BY ALL)"
# For the hybrid: only users with a high value have model scores, the others are unknown; every
# third item of a user is excluded.
_HIGH = f"{_OWN[:-1]} HAVING user_id IN (SELECT user_id FROM events WHERE value > 200))"
_TREND_SCALED = f"""(SELECT item_id, score AS raw, CASE WHEN max(score) OVER () - min(score) OVER () < 1e-9 THEN 0.0::DOUBLE
    ELSE (score - min(score) OVER ()) / (max(score) OVER () - min(score) OVER ()) END AS t FROM {_TREND})"""


def _hybrid_sql(own: str) -> str:
    return f"""WITH pool AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r
                         FROM {own} QUALIFY r <= 20),
             a AS (SELECT user_id, item_id, CASE WHEN max(score) OVER w - min(score) OVER w < 1e-9 THEN 0.0::DOUBLE
                     ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END AS a
                   FROM pool WINDOW w AS (PARTITION BY user_id)),
             known AS (SELECT DISTINCT user_id FROM {_HIGH}),
             pairs AS (SELECT user_id, item_id FROM a UNION
                       SELECT user_id, item_id FROM known, (SELECT item_id FROM {_TREND})),
             blend AS (SELECT user_id, item_id,
                         0.7::DOUBLE * coalesce(a, 0) + 0.3::DOUBLE * coalesce(t, 0) AS score
                       FROM pairs LEFT JOIN a USING (user_id, item_id)
                       LEFT JOIN {_TREND_SCALED} USING (item_id)
                       UNION ALL SELECT user_id, item_id, raw FROM
                         (SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM known)),
                         {_TREND_SCALED})
           SELECT user_id, item_id, round(score, 6) AS score, row_number() OVER (
             PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM blend QUALIFY rank <= 5"""


def _hybrid(t: Tables, exclude: bool) -> DataFrame:
    rows, own, trend = _score_tables(t)
    known = rows.where(F.col("value") > 200).select("user_id").distinct()
    own = own.join(known, "user_id", "left_semi")
    gone = own.where("(user_id + item_id) % 3 = 0").select("user_id", "item_id") if exclude else None
    best = hybrid.hybrid_top_k(rows.select("user_id"), own, trend, k=5, known=known, exclude=gone)
    return best.withColumns({**bigint("user_id", "item_id", "rank"), **rounded(6, "score")})


@query(_hybrid_sql(_HIGH))
def hybrid_top_k(t):
    """Known users get blended scores, all others the trending fallback."""
    return _hybrid(t, False)


@query(_hybrid_sql(f"(SELECT * FROM {_HIGH} WHERE (user_id + item_id) % 3 <> 0)"))
def hybrid_top_k_excluding(t):
    """A third of the pairs cannot come from the model; what trends can still bring them."""
    return _hybrid(t, True)


@query(f"""WITH a AS (SELECT item_id, sum(score) AS score FROM {_OWN} GROUP BY item_id)
           SELECT item_id, round(0.7 * coalesce((a.score - (SELECT min(score) FROM a)) /
                    ((SELECT max(score) FROM a) - (SELECT min(score) FROM a)), 0) + 0.3 * coalesce(t, 0), 6) AS score
           FROM a FULL JOIN {_TREND_SCALED} USING (item_id)""")
def blended_scores(t):
    _, own, trend = _score_tables(t)
    totals = own.groupBy("item_id").agg(F.sum("score").alias("score"))
    return hybrid.blended(totals, trend).withColumns({**bigint("item_id"), **rounded(6, "score")})


@query(f"SELECT item_id, raw AS score, t AS scaled FROM {_TREND_SCALED}")
def scaled_scores(t):
    _, _, trend = _score_tables(t)
    return hybrid.scaled(trend.withColumn("scaled", F.col("score")), "scaled").withColumns(bigint("item_id"))


@query("""SELECT user_id, max(value) > 200 AS known FROM events GROUP BY user_id""")
def known_and_unknown_users(t):
    users = t.events.select("user_id").distinct()
    known, unknown = joins.split_known(users, t.events.where(F.col("value") > 200), "user_id")
    return known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))


@query(f"""SELECT user_id, item_id, rank FROM (SELECT user_id, item_id, row_number() OVER (
             PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM {_OWN} QUALIFY rank <= 5)
           ORDER BY user_id, rank LIMIT 50""")
def newest_recommendations(t):
    """The dashboard's view: first 50 rows of the newest batch (batch 1 is a copy of batch 0)."""
    _, own, _ = _score_tables(t)
    best = top_per_group(own, ["user_id"], 5, F.col("score").desc(), "item_id")
    recs = best.withColumn("batch_id", F.explode(F.array(F.lit(0), F.lit(1))))
    return reports.newest_recommendations(recs).select("user_id", "item_id", "rank").withColumns(
        bigint("user_id", "item_id", "rank"))


# --- model -------------------------------------------------------------------------

@query(f"""SELECT count(DISTINCT reviewerID) AS users, 5 * count(DISTINCT reviewerID) AS rows, 0::BIGINT AS broken,
             TRUE AS error_bounded, TRUE AS searched FROM {_CLEAN}""")
def als_recommendations(t):
    """Clean, index, split, fit, search the grid, store, load, recommend; checked by invariants.

    Of every known user: ranks 1 to 5 once each, falling scores, ids of the dictionaries.
    """
    clean = as_table(ratings.clean_ratings(raw_reviews(t)), "ratings")
    indexed, users, items = ratings.index_ratings(clean)
    indexed = as_table(indexed, "indexed")
    train, test = filters.hash_split(indexed, ["user_id", "item_id"], 80)
    model, error, params = als.fit_tuned(train, test)
    path = scratch_path(t.spark, "model")
    als.save_artifacts(als.fit(indexed), users, items, path)
    stored_users, stored_items = readers.read_dictionaries(t.spark, path)
    best = as_table(als.top_k(als.load_model(path), stored_users, 5), "best")
    by_user = Window.partitionBy("user_id").orderBy("rank")  # five rows a user
    wrong = (F.col("rank") != F.row_number().over(by_user)) | (F.col("score") > F.lag("score").over(by_user))
    unknown = best.join(stored_items, "item_id", "left_anti").count()
    checked = best.withColumn("wrong", F.coalesce(wrong, F.lit(False)).cast("long"))
    # Ratings without a pattern cannot be predicted better than by their spread, so the grid is searched.
    searched = set(params) == set(als.GRID) if error > als.TUNE_ABOVE else True
    return checked.agg(F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("rows"),
                       (F.sum("wrong") + F.lit(unknown)).alias("broken")).withColumns(
        {"error_bounded": F.lit(error < 4.0), "searched": F.lit(searched)})
