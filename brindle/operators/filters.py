"""Row predicates. All are plain column filters, so they reach the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(df: DataFrame, *conditions: Column) -> DataFrame:
    """Conjunctive filter; a null in any condition rejects the row."""
    return df.where(reduce(lambda a, b: a & b, conditions))


def present(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose listed columns are all non-null."""
    return df.dropna(subset=list(cols))


def valid_range(df: DataFrame, col: str, low: float, high: float, *keys: str) -> DataFrame:
    """Keep rows with non-null ``keys`` and ``low <= col <= high`` (drops, never clips)."""
    return all_of(df, F.col(col).between(low, high), *(F.col(k).isNotNull() for k in keys))


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose text holds something besides white space."""
    return df.where(F.col(col).rlike(r"(?U)\S"))


def hash_share(df: DataFrame, keys: list[str], keep: int, out_of: int) -> DataFrame:
    """Reproducible subset: rows whose key hash falls in ``keep`` of ``out_of`` buckets.

    Whole keys are kept or dropped together, so the choice does not depend on
    partitioning or on retries.
    """
    return df.where(_bucket(keys, out_of) < keep)


def hash_split(df: DataFrame, keys: list[str], train_percent: int = 80):
    """Split into (train, test) by key hash; the two are disjoint and cover ``df``."""
    bucket = _bucket(keys, 100)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def _bucket(keys: list[str], out_of: int) -> Column:
    """A bucket from the MD5 of the keys' text, which any engine can compute."""
    text = F.concat_ws("\u0001", *(F.coalesce(F.col(k).cast("string"), F.lit("\u0002")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % out_of
