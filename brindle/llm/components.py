"""Connected components of a link table, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.session import as_table


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; the root is the smallest node reachable.

    Each round hangs every node's larger neighbours on its smallest one (large star), then
    every node and its smaller neighbours on the smallest of these (small star). Both
    steps are an aggregate with map-side combine and a join that can split hot nodes. A
    round's links are written to the shared folder, so lineage stays short and survives
    lost executors. Rounds grow with the logarithm of the longest path. Self links keep a
    node; an empty table gives no rows; null nodes are ignored.
    """
    both = links.where("a is not null and b is not null").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = as_table(both.distinct(), "links")
    before = None
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
        around = current.union(current.select("v", "u"))
        smallest = around.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = around.join(smallest, F.col("u") == F.col("k")).where("v >= u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        hung = large.join(lowest, F.col("u") == F.col("k"))
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", F.col("m")))
        current = as_table(small.distinct(), "links")
    roots = current.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root")
