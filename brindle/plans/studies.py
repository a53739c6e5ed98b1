"""Tuning studies: the same question under different storage and settings.

Times come from ``noop`` writes, which evaluate every column; ``count()`` would let
the optimizer skip most of the work.
"""

from __future__ import annotations

import contextlib
import io
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brindle.sources import schemas
from brindle.sources.writers import write_partitioned

# The shuffle-partition sweep.
SWEEP = (8, 50, 200, 400)
SHUFFLE = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def run_full(df: DataFrame) -> float:
    """Seconds to evaluate every row and column."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def plans(df: DataFrame, mode: str = "extended") -> str:
    """Parsed, analyzed, optimized and physical plan as text."""
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain(mode)
    return text.getvalue()


def physical_plan(df: DataFrame) -> str:
    return plans(df, "formatted")


def log(spark: SparkSession, seconds: dict[tuple[str, str], float]) -> DataFrame:
    """Performance log rows (query, api, seconds, rows)."""
    rows = [(query, api, float(took), None) for (query, api), took in seconds.items()]
    return spark.createDataFrame(rows, schemas.PERFORMANCE)


def cache_study(df: DataFrame, question: Callable[[DataFrame], DataFrame]) -> dict[str, float]:
    """Seconds without and with the input held in the columnar cache."""
    cold = run_full(question(df))
    cached = df.cache()
    try:
        cached.count()
        return {"cold": cold, "warm": run_full(question(cached))}
    finally:
        cached.unpersist()


def format_study(rows: DataFrame, columnar: DataFrame,
                 question: Callable[[DataFrame], DataFrame]) -> dict[str, float]:
    """Seconds on a row-oriented and on a columnar scan of the same data."""
    return {"csv": run_full(question(rows)), "parquet": run_full(question(columnar))}


def partitioned_copy(df: DataFrame, path: str, col: str = "YEAR") -> DataFrame:
    """Scan of ``path``, written partitioned by ``col`` unless it exists already."""
    write_partitioned(df, path, col, keep_existing=True)
    return df.sparkSession.read.parquet(path)


def pruned(table: DataFrame, condition: str = "YEAR = 2022") -> DataFrame:
    """Filter on a partition column; raises unless the scan reads only matching directories."""
    kept = table.where(condition)
    filters = [line for line in physical_plan(kept).splitlines() if "PartitionFilters" in line]
    if not any("PartitionFilters: []" not in line for line in filters):
        raise ValueError(f"{condition!r} does not prune partitions")
    return kept


def shuffle_study(df: DataFrame, question: Callable[[DataFrame], DataFrame],
                  sizes=SWEEP) -> dict[int, float]:
    """Seconds per number of shuffle partitions; the settings are restored."""
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in SHUFFLE}
    try:
        took = {}
        for size in sizes:
            for key in SHUFFLE:
                conf.set(key, size)
            took[size] = run_full(question(df))
        return took
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
