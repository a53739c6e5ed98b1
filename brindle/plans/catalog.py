"""Registry of the queries on the test tables, each with its SQL counterpart.

``carrier`` is ``l_suppkey``; a measure is made nullable by blanking it for one return
flag, because the test tables hold no nulls. Measures are whole numbers wherever a
result is an average, so both engines get identical doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.session import apply_defaults, size_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Lazy scans of the test tables: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = apply_defaults(spark), folder.rstrip("/")
        size_for(spark, self.folder)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None, name: str | None = None):
    """Register ``f(tables) -> DataFrame`` under its name, with the SQL to compare with."""
    def add(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLE[key] = sql
        return f
    return add


def bigint(*cols: str) -> dict:
    """Casts for ``withColumns``: integer results compare as 64-bit on both sides."""
    return {c: F.col(c).cast("bigint") for c in cols}


def rounded(digits: int, *cols: str) -> dict:
    return {c: F.round(c, digits) for c in cols}
