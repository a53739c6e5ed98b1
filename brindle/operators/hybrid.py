"""Blend of model scores and live trending scores, with a cold-start fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.functions.scores import ALS_WEIGHT, TRENDING_WEIGHT, min_max
from brindle.operators.joins import broadcast_join, excluding, split_known
from brindle.operators.windows import top_per_group
from brindle.session import as_table

# Fixed value: model candidates taken per wanted recommendation.
POOL = 4


def scaled(scores: DataFrame, value: str = "score", *, by: list[str] | None = None,
           single_score: float = 0.0) -> DataFrame:
    """Min-max scale ``value`` to [0, 1], over all rows or within each ``by`` group.

    ``by`` uses a window, so it is meant for lists already cut to their top rows.
    """
    if by:
        group = Window.partitionBy(*by)
        low, high = F.min(value).over(group), F.max(value).over(group)
    else:
        low, high = scores.agg(F.min(value)).scalar(), scores.agg(F.max(value)).scalar()
    return scores.withColumn(value, min_max(F.col(value), low, high, single_score=single_score))


def blended(als: DataFrame, trending: DataFrame, *, als_weight: float = ALS_WEIGHT,
            trending_weight: float = TRENDING_WEIGHT, single_score: float = 0.0) -> DataFrame:
    """Scale two (item_id, score) tables and blend them; a missing side counts as 0."""
    a = scaled(als, single_score=single_score).select("item_id", F.col("score").alias("__a"))
    t = scaled(trending, single_score=single_score).select("item_id", F.col("score").alias("__t"))
    score = (F.lit(als_weight) * F.coalesce("__a", F.lit(0.0))
             + F.lit(trending_weight) * F.coalesce("__t", F.lit(0.0)))
    return a.join(t, "item_id", "full").select("item_id", score.alias("score"))


def hybrid_top_k(users: DataFrame, als_scores: DataFrame, trending: DataFrame, *, k: int = 5,
                 known: DataFrame | None = None, exclude: DataFrame | None = None, als_weight: float = ALS_WEIGHT,
                 trending_weight: float = TRENDING_WEIGHT,
                 single_score: float = 0.0) -> DataFrame:
    """Top ``k`` items per user: (user_id, rank, item_id, score).

    A known user's candidates are the user's best ``4k`` model items and all trending
    items; both sides are scaled and blended. An unknown user gets the top trending
    items with raw scores. ``known`` defaults to the users that have model scores.
    ``exclude`` (user_id, item_id) takes items out of a user's model candidates; what trends
    can still bring them back.

    At most ``4k`` trending items are also model candidates, so beyond those only the
    ``5k`` best trending items can reach the top ``k``: that short list, one row, is
    all that is attached to each user.
    """
    pool = POOL * k
    users = users.select("user_id").distinct()
    known = als_scores.select("user_id") if known is None else known
    if exclude is not None:
        als_scores = excluding(als_scores, exclude, ["user_id", "item_id"])

    # Trending, best first, with raw and scaled score.
    trend = as_table(scaled(trending.select("item_id", F.col("score").alias("raw"), "score"),
                            single_score=single_score), "trend")
    best = trend.orderBy(F.col("raw").desc(), "item_id").limit(pool + k)
    head = best.agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("raw")).alias("by"), F.col("item_id"), F.col("score"), F.col("raw"))))).scalar()

    familiar, strangers = split_known(users, known, "user_id")
    # Every task cuts its users to 4k rows before the exchange.
    lists = top_per_group(als_scores, ["user_id"], pool, F.col("score").desc(), F.col("item_id"))
    lists = scaled(lists, by=["user_id"], single_score=single_score)
    lists = lists.join(familiar, "user_id", "left_semi")
    lists = broadcast_join(lists, trend.select("item_id", F.col("score").alias("t")), "item_id", "left")
    own_score = (F.lit(als_weight) * F.col("score")
                 + F.lit(trending_weight) * F.coalesce("t", F.lit(0.0)))
    own = lists.groupBy("user_id").agg(  # at most 4k entries per user
        F.collect_list(F.struct((-own_score).alias("by"), F.col("item_id"))).alias("own"))

    unseen = F.when(F.col("own").isNull(), F.col("head")).otherwise(
        F.filter("head", lambda h: ~F.array_contains(F.col("own.item_id"), h["item_id"])))
    others = F.transform(unseen, lambda h: F.struct(
        (-(F.lit(trending_weight) * h["score"])).alias("by"), h["item_id"].alias("item_id")))
    merged = F.when(F.col("own").isNull(), others).when(others.isNull(), F.col("own")).otherwise(
        F.concat(F.col("own"), others))
    warm = (familiar.join(own, "user_id", "left").withColumn("head", head)
            .select("user_id", F.slice(F.array_sort(merged), 1, k).alias("top")))
    cold = (strangers.withColumn("head", head)
            .select("user_id", F.transform(F.slice("head", 1, k), lambda h: F.struct(
                h["by"].alias("by"), h["item_id"].alias("item_id"))).alias("top")))
    return (warm.unionByName(cold)
            .select("user_id", F.posexplode("top").alias("pos", "entry"))
            .select("user_id", (F.col("pos") + 1).alias("rank"), F.col("entry.item_id").alias("item_id"),
                    (-F.col("entry.by")).alias("score")))
