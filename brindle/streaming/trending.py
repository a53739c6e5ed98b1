"""Trending table: the newest score per item, kept as a base and the changes since.

Batch ``n`` writes only its own items, as ``delta/batch_id=n``; what a batch writes follows the batch and not the
table. Readers merge the newest base with the deltas behind it: an item's newest batch counts. Once
``compact_after`` deltas lie behind the base, the merged rows are written as the next base,
``base/batch_id=n``. A folder is there for readers once its ``_SUCCESS`` file is, so the switch to a new base is one
file, and neither is written again once it is finished: a replayed batch finds its delta and leaves it, and a
reader keeps the folders it picked for as long as it runs. Folders that a newer base has replaced are
deleted by age. A state path belongs to one checkpoint, because batch numbers come from it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.session import delete_path, finished_batches
from brindle.sources import schemas

#: Age in seconds from which a replaced folder may go (longer than any reader runs), and deltas behind a base.
KEEP_SECONDS, COMPACT_AFTER = 3600, 32


class TrendingTable:
    """``expire_after`` (seconds, default never) leaves out items whose newest window ended that long
    before the newest window of the table; otherwise every item stays."""

    def __init__(self, spark: SparkSession, path: str, *, expire_after: int | None = None,
                 keep_seconds: int = KEEP_SECONDS, compact_after: int = COMPACT_AFTER):
        self.spark, self.path = spark, path
        self.expire_after, self.keep_seconds, self.compact_after = expire_after, keep_seconds, compact_after

    def _folders(self) -> tuple[int | None, list[int]]:
        """The number of the newest base, and those of the deltas behind it."""
        # Deltas are listed first: a base that is finished meanwhile holds all of them.
        deltas = finished_batches(self.spark, f"{self.path}/delta")
        base = max(finished_batches(self.spark, f"{self.path}/base"), default=None)
        return base, sorted(n for n in deltas if base is None or n > base)

    def _read(self, kind: str, numbers: list[int]) -> DataFrame:
        schema = f"{schemas.TRENDING}, batch_id bigint"
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}")
                .parquet(*(f"{self.path}/{kind}/batch_id={n}" for n in numbers)))

    def _merged(self, base: int | None, deltas: list[int]) -> DataFrame:
        rows = self._read("base", [] if base is None else [base])
        if deltas:
            # Fixed-width state: a hash aggregate, with one row for each item of a task in the shuffle.
            newest = [F.max_by(c, "batch_id").alias(c) for c in ("score", "window_end")]
            rows = rows.unionByName(self._read("delta", deltas)).groupBy("item_id").agg(*newest)
        rows = rows.select("item_id", "score", "window_end")
        if self.expire_after is not None:
            oldest = rows.agg(F.max("window_end")).scalar() - F.make_dt_interval(secs=F.lit(self.expire_after))
            rows = rows.where(F.col("window_end") >= oldest)
        return rows

    def scores(self) -> DataFrame:
        """Current (item_id, score)."""
        return self._merged(*self._folders()).select("item_id", "score")

    def update(self, windows: DataFrame, batch_id: int) -> None:
        """Replace each item's score by its maximum in ``windows`` (a foreachBatch callback)."""
        done = finished_batches(self.spark, f"{self.path}/delta")
        base = max(finished_batches(self.spark, f"{self.path}/base"), default=-1)
        if batch_id not in done and batch_id > base:
            rows = windows.groupBy("item_id").agg(F.max("trending_score").alias("score"),
                                                  F.max("window_end").alias("window_end"))
            rows.write.mode("overwrite").parquet(f"{self.path}/delta/batch_id={batch_id}")
        if len([n for n in done if base < n < batch_id]) + 1 >= self.compact_after:
            self.compact()
        self._clean()

    def compact(self) -> None:
        """Write base and deltas as the next base."""
        base, deltas = self._folders()
        if deltas:
            merged = self._merged(base, deltas)
            merged.write.mode("overwrite").parquet(f"{self.path}/base/batch_id={deltas[-1]}")

    def _clean(self) -> None:
        """Delete what the newest base has replaced, once that was long enough ago."""
        bases = finished_batches(self.spark, f"{self.path}/base")
        newest = max(bases, default=None)
        if newest is None or bases[newest] >= time.time() - self.keep_seconds:
            return
        for n in bases:
            if n < newest:
                delete_path(self.spark, f"{self.path}/base/batch_id={n}")
        for n in finished_batches(self.spark, f"{self.path}/delta"):
            if n <= newest:
                delete_path(self.spark, f"{self.path}/delta/batch_id={n}")
