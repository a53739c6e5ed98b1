"""Sliding-window statistics and alerts over shared panes. The same plans run on batch tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.dates import minutes_between
from brindle.functions.scores import DECAY_MINUTES, decayed

# Window shape and alert thresholds.
SIZE, SLIDE = "30 seconds", "10 seconds"
ALERT_RATING, ALERT_ITEM_COUNT, ALERT_USER_COUNT = 4.5, 10, 20


def _pane(spark: SparkSession, size: str, slide: str) -> str:
    """The longest span of which both window size and slide are multiples."""
    lengths = spark.range(1).select(*(F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {span}"))
                                      for span in (size, slide))).first()
    return f"{math.gcd(*lengths)} microseconds"


def _paned(events: DataFrame, key: str, size: str, slide: str | None, first: list[Column], then: list[Column]) -> DataFrame:
    """Per window and key: ``then`` over ``first``, which is aggregated by pane.

    Sliding windows share panes: an event is counted in one pane, and a closed pane (one row for each key) goes to
    the windows that hold it. So the first state has a row per pane and key, and events are not copied for each
    window they are in. Tumbling windows are panes themselves.
    """
    if slide is None:
        panes = events.groupBy(F.window("event_time", size).alias("window"), key).agg(*first)
    else:
        pane = _pane(events.sparkSession, size, slide)
        panes = events.groupBy(F.window("event_time", pane).alias("pane"), key).agg(*first)
        panes = panes.groupBy(F.window("pane", size, slide).alias("window"), key).agg(*then)
    return panes


def item_windows(events: DataFrame, size: str = SIZE, slide: str | None = SLIDE,
                 decay_minutes: float = DECAY_MINUTES) -> DataFrame:
    """Count, mean rating and time-decayed trending score per item and window."""
    stats = _paned(
        events, "item_id", size, slide,
        [F.count(F.lit(1)).alias("count"), F.count("rating").alias("rated"), F.sum("rating").alias("ratings"),
         F.max("event_time").alias("latest")],
        [F.sum("count").alias("count"), F.sum("rated").alias("rated"), F.sum("ratings").alias("ratings"),
         F.max("latest").alias("latest")])
    mean = F.col("ratings") / F.nullif("rated", F.lit(0))
    age = minutes_between(F.col("window.end"), F.col("latest"))
    return stats.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "item_id", "count", mean.alias("avg_rating"),
        decayed(F.col("count"), mean, age, decay_minutes).alias("trending_score"))


def user_windows(events: DataFrame, size: str = SIZE, slide: str | None = SLIDE) -> DataFrame:
    """Interactions per user and window."""
    return (_paned(events, "user_id", size, slide, [F.count(F.lit(1)).alias("count")], [F.sum("count").alias("count")])
            .select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "user_id", "count"))


def item_alerts(items: DataFrame, min_rating: float = ALERT_RATING,
                min_count: int = ALERT_ITEM_COUNT) -> DataFrame:
    """Windows in which an item was both busy and highly rated."""
    hits = items.where((F.col("avg_rating") > min_rating) & (F.col("count") >= min_count))
    return _alert_rows(hits, "trending_item", "item_id", "avg_rating")


def user_alerts(users: DataFrame, min_count: int = ALERT_USER_COUNT) -> DataFrame:
    """Windows in which one user was very active."""
    return _alert_rows(users.where(F.col("count") >= min_count), "user_burst", "user_id", "count")


def alerts(items: DataFrame, users: DataFrame, *, min_rating: float = ALERT_RATING,
           min_item_count: int = ALERT_ITEM_COUNT, min_user_count: int = ALERT_USER_COUNT) -> DataFrame:
    """Both kinds of alert in one schema.

    Sliding windows overlap, so one burst may raise an alert in several of them.
    """
    return item_alerts(items, min_rating, min_item_count).unionByName(user_alerts(users, min_user_count))


def _alert_rows(df: DataFrame, kind: str, subject: str, metric: str) -> DataFrame:
    return df.select(F.lit(kind).alias("alert_type"), F.col(subject).cast("string").alias("subject"),
                     F.col(metric).cast("double").alias("metric"),
                     F.col("count").alias("magnitude"), "window_start", "window_end")
