"""Ratings: cleaning, key indexing, splitting and conversion to event records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.filters import present, valid_range
from brindle.operators.joins import broadcast_join
from brindle.operators.ordering import dense_ids
from brindle.operators.windows import latest_per_key

# The valid rating range.
LOWEST, HIGHEST = 1.0, 5.0


def clean_ratings(df: DataFrame, user: str = "reviewerID", item: str = "asin",
                  rating: str = "overall", time: str = "unixReviewTime") -> DataFrame:
    """Valid ratings only, one (the latest) per user and item."""
    valid = valid_range(df.select(user, item, rating, time), rating, LOWEST, HIGHEST, user, item)
    return latest_per_key(valid, [user, item], time, [rating])


def frequency_ids(df: DataFrame, key: str, out: str) -> DataFrame:
    """Dictionary (out, key): id 0 is the most frequent key, equal counts go by key."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    ids = dense_ids(counts, F.col("__n").desc(), key, out="__id")
    return ids.select(F.col("__id").cast("int").alias(out), key)


def index_ratings(df: DataFrame, user: str = "reviewerID", item: str = "asin"):
    """Replace string keys by ints: (indexed ratings, user dictionary, item dictionary)."""
    users = frequency_ids(df, user, "user_id")
    items = frequency_ids(df, item, "item_id")
    return attach_ids(df, users, items, user, item), users, items


def attach_ids(df: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str,
               how: str = "inner") -> DataFrame:
    """Join both dictionaries; an inner join skips rows with an unknown key."""
    return broadcast_join(broadcast_join(df, users, user, how), items, item, how)


def matched_reviews(reviews: DataFrame, users: DataFrame, items: DataFrame, *, user: str = "reviewerID",
                    item: str = "asin", rating: str = "overall") -> DataFrame:
    """Reviews with key and rating, and their ids where the dictionaries know the key."""
    return attach_ids(present(reviews, user, item, rating), users, items, user, item, "left")


def _known() -> Column:
    return F.col("user_id").isNotNull() & F.col("item_id").isNotNull()


def skipped_count() -> Column:
    """Aggregate over :func:`matched_reviews`: rows with an unknown key."""
    return F.count(F.when(~_known(), 1)).alias("skipped")


def known_events(matched: DataFrame, *, user: str = "reviewerID", item: str = "asin", rating: str = "overall",
                 stamp=None) -> DataFrame:
    """Interaction events of the matched reviews with known keys. ``stamp`` is the event time (default: now)."""
    stamp = F.current_timestamp() if stamp is None else stamp
    return matched.where(_known()).withColumn("timestamp", stamp).select(
        F.col("user_id").cast("int").alias("user_id"),
        F.col("item_id").cast("int").alias("item_id"),
        F.col(rating).cast("double").alias("rating"),
        "timestamp",
        F.unix_millis("timestamp").alias("event_time_ms"),
        F.col(user).alias("user_key"),
        F.col(item).alias("item_key"))


def rating_events(reviews: DataFrame, users: DataFrame, items: DataFrame, *,
                  user: str = "reviewerID", item: str = "asin", rating: str = "overall",
                  stamp=None):
    """Turn reviews into interaction events: (events, skipped).

    Rows with a null key or rating are dropped, rows with an unknown key are counted
    in the one-row table ``skipped``. Where events are written at once, observe
    :func:`skipped_count` on the way instead: one pass gives both.
    """
    matched = matched_reviews(reviews, users, items, user=user, item=item, rating=rating)
    return known_events(matched, user=user, item=item, rating=rating, stamp=stamp), matched.agg(skipped_count())
