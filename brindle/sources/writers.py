"""Batch sinks. Every one replaces older output and leaves Spark's _SUCCESS marker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.operators.inverted_index import index_lines
from brindle.session import as_table, path_exists


def write_partitioned(df: DataFrame, path: str, *cols: str, keep_existing: bool = False) -> None:
    """Parquet partitioned by ``cols``; ``keep_existing`` makes it a no-op on a path whose job committed.

    What a failed job left behind is replaced.

    Rows are rebalanced on the partition columns first: few files per value, while AQE
    splits a value that holds a large share of the rows over several tasks.
    """
    if keep_existing and succeeded(df.sparkSession, path):
        return
    df.hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols).parquet(path)


def write_index(index: DataFrame, path: str) -> None:
    """Index table ordered by (term, doc), so a term lookup reads few row groups.

    The range split includes ``doc``: a frequent term spreads over several tasks. It reads the rows
    twice, so they are stored before.
    """
    (as_table(index, "to-order").repartitionByRange("term", "doc").sortWithinPartitions("term", "doc")
     .write.mode("overwrite").parquet(path))


def write_index_text(lists: DataFrame, path: str) -> None:
    """Posting lines in term order. The sort reads them twice, so they are stored before."""
    as_table(index_lines(lists), "lines").orderBy("term", "part").select("line").write.mode("overwrite").text(path)


def succeeded(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote ``path`` committed."""
    return path_exists(spark, f"{path}/_SUCCESS")
