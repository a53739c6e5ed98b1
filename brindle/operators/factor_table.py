"""Factors in folders by a hash of their id, so that a lookup of a few ids reads a few folders.

A plain folder of factors has every id anywhere, so each lookup scans all of them, however few ids it asks for.
Here the folder of an id is known from the id alone: the distinct folders of the wanted ids (at most
``MAX_BUCKETS`` numbers) become a partition filter, and files of other folders are not opened.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.joins import fits_broadcast
from brindle.session import as_table, folders, path_exists

#: Bytes of factors that a folder is meant for, and the most folders of a table.
BUCKET_BYTES, MAX_BUCKETS = 16 << 20, 4096
SCHEMA = "id int, features array<float>"


def _bucket(key: str, of: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(of)).cast("int")


class FactorTable:
    """Stored factors (id, features) below ``path``; the files are listed once, when the table is opened.

    A folder that is missing, or that holds factors in another layout, is an error rather than an empty table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        found = [re.search(r"of=(\d+)$", name) for name in folders(spark, self.path, "of=*")]
        if not path_exists(spark, self.path) or not found and folders(spark, self.path, "*.parquet"):
            raise ValueError(f"no factors in folders by id below {path}")
        self.buckets = int(found[0][1]) if found else 0
        self.rows = (spark.read.schema(f"{SCHEMA}, of int, bucket int").parquet(self.path) if self.buckets
                     else spark.createDataFrame([], f"{SCHEMA}, of int, bucket int"))

    @classmethod
    def write(cls, factors: DataFrame, path: str, buckets: int | None = None) -> FactorTable:
        """Store ``factors`` (id, features), replacing an older table; rows with a null id are left out.

        There is a folder for every ``BUCKET_BYTES`` of factors, or as many as ``buckets`` says, each with one file.
        """
        rows = factors.where("id is not null").select("id", "features")
        if buckets is None:
            many, rank = rows.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
            buckets = min(MAX_BUCKETS, max(1, -(-many * (4 * (rank or 0) + 8) // BUCKET_BYTES)))
        placed = rows.withColumn("of", F.lit(buckets)).withColumn("bucket", _bucket("id", buckets))
        (placed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "id")
         .write.mode("overwrite").partitionBy("of", "bucket").parquet(path))
        return cls(factors.sparkSession, path)

    def all(self) -> DataFrame:
        return self.rows.select("id", "features")

    def _folders(self, wanted: DataFrame) -> DataFrame:
        """The rows of the folders in ``wanted.__bucket``, of which there are at most ``MAX_BUCKETS``."""
        numbers = sorted(row[0] for row in wanted.select("__bucket").distinct().collect())
        return self.rows if len(numbers) == self.buckets else self.rows.where(F.col("bucket").isin(numbers))

    def of(self, users: DataFrame, key: str = "user_id") -> DataFrame:
        """(``key``, features) of those ids in ``users`` that have factors, each once."""
        wanted = users.select(F.col(key).cast("long").alias("__id")).where("__id is not null").distinct()
        if not self.buckets:
            return self.rows.select(F.col("id").alias(key), "features")
        wanted = as_table(wanted.withColumn("__bucket", _bucket("__id", self.buckets)), "wanted-factors")
        side = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
        return self._folders(wanted).join(side, F.col("id").cast("long") == F.col("__id"), "left_semi").select(
            F.col("id").alias(key), "features")
