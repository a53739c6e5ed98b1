"""The full stream: windows, alerts, latency, trending table and recommendations."""

from __future__ import annotations

from functools import partial

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from brindle.operators.factor_table import FactorTable
from brindle.streaming import ingest, sinks, windows
from brindle.streaming.trending import TrendingTable

# Trigger intervals.
EVERY_LATENCY, EVERY_RECS, EVERY_WINDOW = "1 second", "3 seconds", "5 seconds"


def start(raw: DataFrame, out: str, model: ALSModel | None = None, *, brokers: str | None = None,
          size: str = windows.SIZE, slide: str | None = windows.SLIDE,
          watermark: str = ingest.WATERMARK, min_rating: float = windows.ALERT_RATING,
          min_item_count: int = windows.ALERT_ITEM_COUNT,
          min_user_count: int = windows.ALERT_USER_COUNT,
          exclude: DataFrame | None = None, state_partitions: int | None = None,
          user_factors: FactorTable | None = None, once: bool = False) -> dict[str, StreamingQuery]:
    """Start the queries over ``raw`` messages; outputs go below ``out``.

    Item windows, their alerts and the trending table come from one stateful query, user
    windows and their alerts from another. With ``brokers`` alerts and recommendations
    are published as well, keyed by what names a row for good, so that a replayed batch repeats keys and adds none. The
    users' windows also leave sketches of their users below ``activity/users``. ``exclude`` (user_id, item_id) is not recommended from the model;
    ``user_factors`` is the table that was saved with it.
    ``state_partitions`` sets the partitions of the window state; a checkpoint keeps those of its
    first start; the session's own setting stays as it is. ``once`` works off what is there and stops.
    """
    key, conf = "spark.sql.shuffle.partitions", raw.sparkSession.conf
    before = conf.get(key)
    if state_partitions is not None:
        conf.set(key, state_partitions)
    try:  # a query copies the settings when it starts
        return _start_all(raw, out, model, brokers, size, slide, watermark, min_rating, min_item_count, min_user_count, exclude,
                          user_factors, once)
    finally:
        conf.set(key, before)


def _start_all(raw: DataFrame, out: str, model: ALSModel | None, brokers: str | None, size: str, slide: str | None,
               watermark: str, min_rating: float, min_item_count: int, min_user_count: int, exclude: DataFrame | None,
               user_factors: FactorTable | None, once: bool) -> dict[str, StreamingQuery]:
    parsed = ingest.parse_events(raw)
    events = ingest.good_events(parsed, watermark)
    table = TrendingTable(raw.sparkSession, f"{out}/trending")

    def publisher(topic: str, *key: str):
        return partial(sinks.batch_to_kafka, brokers=brokers, topic=topic, key=list(key)) if brokers else None

    def run(name: str, df: DataFrame, callback, every: str) -> StreamingQuery:
        return sinks.for_each_batch(df, callback, f"{out}/checkpoints/{name}", every=every, once=once)

    publish = publisher(ingest.ALERTS, "alert_type", "subject", "window_end")
    running = {
        "items": run("items", windows.item_windows(events, size, slide), sinks.window_writer(
            f"{out}/windows/items", f"{out}/alerts/kind=item",
            lambda items: windows.item_alerts(items, min_rating, min_item_count),
            update=table.update, publish=publish), EVERY_WINDOW),
        "users": run("users", windows.user_windows(events, size, slide), sinks.window_writer(
            f"{out}/windows/users", f"{out}/alerts/kind=user",
            lambda users: windows.user_alerts(users, min_user_count), publish=publish,
            sketches=(f"{out}/activity/users", ["user_id"])), EVERY_WINDOW),
        "latency": run("latency", events, sinks.latency_writer(f"{out}/latency"), EVERY_LATENCY),
        "dead_letters": sinks.to_parquet(ingest.dead_letters(parsed), f"{out}/dead_letters",
                                         f"{out}/checkpoints/dead_letters", every=EVERY_WINDOW, once=once),
    }
    if model is not None:
        writer = sinks.recommendation_writer(f"{out}/recs", model, table, exclude=exclude, user_factors=user_factors,
                                             publish=publisher(ingest.RECOMMENDATIONS, "user_id", "batch_id", "rank"))
        running["recs"] = run("recs", events, writer, EVERY_RECS)
    return running
