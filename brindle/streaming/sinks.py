"""Streaming sinks. ``foreachBatch`` writers put a batch into its own directory, so a
replayed batch replaces itself."""

from __future__ import annotations

import time

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brindle.operators import als, reports
from brindle.operators.factor_table import FactorTable
from brindle.operators.hybrid import POOL, hybrid_top_k
from brindle.session import as_table, delete_path, scratch_owner
from brindle.streaming.ingest import identity, message
from brindle.streaming.trending import TrendingTable


def _start(writer, checkpoint: str, every: str | None, once: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, *, every: str = "5 seconds",
               once: bool = False) -> StreamingQuery:
    """Append to a Parquet directory; the sink's commit log makes it exactly-once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, every, once)


def to_console(df: DataFrame, name: str, checkpoint: str, rows: int = 10, *,
               once: bool = False) -> StreamingQuery:
    """Print every batch."""
    writer = (df.writeStream.format("console").outputMode("append").queryName(name)
              .option("truncate", False).option("numRows", rows))
    return _start(writer, checkpoint, None, once)


def to_kafka(df: DataFrame, brokers: str, topic: str, checkpoint: str,
             value_cols: list[str] | None = None, key: str | None = None) -> StreamingQuery:
    """Publish rows as JSON messages."""
    writer = (message(df, value_cols, key).writeStream.format("kafka").outputMode("append")
              .option("kafka.bootstrap.servers", brokers).option("topic", topic))
    return _start(writer, checkpoint, None, False)


def batch_to_kafka(df: DataFrame, brokers: str, topic: str, key: str | list[str] | None = None) -> None:
    """Publish a finished batch.

    A batch that is replayed after a failure is published again: delivery is at least once. Let ``key`` list columns
    that name a row for good (for a recommendation user, batch and rank; for an alert its kind, subject and window), so
    that a compacted topic, or a consumer that keeps the last message of a key, has every row once.
    """
    (message(df, key=identity(*key) if isinstance(key, list) else key).write.format("kafka")
     .option("kafka.bootstrap.servers", brokers).option("topic", topic).save())


def for_each_batch(df: DataFrame, callback, checkpoint: str, *, every: str | None = None,
                   once: bool = False) -> StreamingQuery:
    """Run ``callback(batch, batch_id)`` on every micro-batch."""
    return _start(df.writeStream.outputMode("append").foreachBatch(callback), checkpoint, every, once)


def with_latency(batch: DataFrame, process_ms: int) -> DataFrame:
    """Event, append and processing time of each record, and the delay between the ends."""
    return batch.select(
        "user_id", "item_id", "event_time_ms",
        F.unix_millis("kafka_ts").alias("ingest_ms"),
        F.lit(process_ms).cast("long").alias("process_ms"),
        (F.lit(process_ms).cast("long") - F.col("event_time_ms")).alias("latency_ms"))


def latency_writer(path: str):
    """foreachBatch callback: latency records, one processing time per batch; an empty batch writes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        now = int(time.time() * 1000)
        with_latency(batch, now).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def window_writer(path: str, alerts_path: str, find_alerts, *, update=None, publish=None,
                  sketches: tuple[str, list[str]] | None = None, bitmaps: tuple[str, str] | None = None):
    """foreachBatch callback for closed windows: store them, derive and store their
    alerts, feed ``update(windows, batch_id)`` and ``publish(alerts)``.

    ``sketches`` names a folder and the keys of whose values every batch leaves a sketch per window end there, for
    reports that count distinct keys without reading the windows (:func:`reports.merged_activity`). ``bitmaps`` names
    a folder and an integer key for reports that have to be exact (:func:`reports.merged_bitmaps`).

    All consumers share one stateful query; separate queries would each keep their own
    copy of the window state. A batch that closes no window leaves nothing behind.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        closed = batch.sparkSession.read.schema(batch.schema).parquet(target)
        if closed.isEmpty():  # asked of the stored rows: the batch itself would run its state again
            delete_path(batch.sparkSession, target)
            return
        found = f"{alerts_path}/batch_id={batch_id}"
        alerts = find_alerts(closed)
        alerts.write.mode("overwrite").parquet(found)
        if sketches is not None:
            folder, keys = sketches
            reports.activity_sketches(closed, *keys).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        if bitmaps is not None:
            folder, key = bitmaps
            reports.activity_bitmaps(closed, key).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        if update is not None:
            update(closed, batch_id)
        if publish is not None:
            publish(batch.sparkSession.read.schema(alerts.schema).parquet(found))
    return write


def recommend(users: DataFrame, model: ALSModel, trending: DataFrame, k: int = 5,
              exclude: DataFrame | None = None, blocks: DataFrame | None = None,
              user_factors: FactorTable | None = None) -> DataFrame:
    """Hybrid top ``k`` for the distinct users of a batch; ``exclude`` as in :func:`hybrid_top_k`, ``blocks`` as in
    :func:`als.top_k`. With ``user_factors`` only the folders of these users are read, once for their
    scores and for who is known."""
    users = users.select("user_id").distinct()
    if user_factors is None:
        factors, known = None, model.userFactors.select(F.col("id").alias("user_id"))
    else:
        users = as_table(users, "asking")  # the batch is not evaluated again
        factors = as_table(user_factors.of(users), "user-factors")
        known = factors.select("user_id")
    scores = als.top_k(model, users, POOL * k, exclude, blocks, factors).select("user_id", "item_id", "score")
    return hybrid_top_k(users, scores, trending, k=k, known=known)


def recommendation_writer(path: str, model: ALSModel, trending: TrendingTable, *, k: int = 5,
                          exclude: DataFrame | None = None, publish=None, user_factors: FactorTable | None = None):
    """foreachBatch callback: recommendations of the batch's users, optionally published.

    ``publish`` gets the stored rows, so the plan is not evaluated again. Tables written on
    the way are deleted at the end of the batch. An empty batch writes nothing. The model's items are put into blocks
    once, by the first batch, beside its results; so are its user factors into a table of folders, unless
    ``user_factors`` is the one that was saved with the model.
    """
    blocks: list[DataFrame] = []
    lookup: list[FactorTable] = [user_factors] if user_factors else []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            if not blocks:
                blocks.append(als.item_blocks(model, f"{path}/_item_blocks"))
            if not lookup:
                lookup.append(FactorTable.write(model.userFactors, f"{path}/_user_factors"))
            with scratch_owner(batch.sparkSession):
                store(batch, batch_id)

    def store(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        recs = recommend(batch, model, trending.scores(), k, exclude, blocks[0], lookup[0]).select(
            F.col("user_id").cast("long").alias("user_id"), F.col("rank").cast("long").alias("rank"),
            F.col("item_id").cast("long").alias("item_id"), F.col("score").cast("double").alias("score"),
            F.lit(int(time.time() * 1000)).cast("long").alias("generated_at_ms"))
        recs.write.mode("overwrite").parquet(target)
        if publish is not None:
            stored = batch.sparkSession.read.schema(recs.schema).parquet(target)
            publish(stored.withColumn("batch_id", F.lit(batch_id).cast("long")))
    return write
