"""Equi-joins with explicit size and skew rules.

A side is broadcast only after its rows and bytes were measured. Beyond the bound
the join shuffles, and the rows of keys that hold a large share of the big side are
spread over several salts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, DatetimeType, MapType, NumericType, StringType, StructField, StructType)

from brindle.session import as_table

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1 / 500


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` against the bound: rows first (no columns read), then bytes.

    Columns of a fixed width are not read for that, so a table without others is measured by its number of rows.
    """
    many = df.count()
    if many > max_rows:
        return False
    fixed = 16 * many * len(df.columns)
    varying = [width for width in map(_varying_width, df.schema) if width is not None]
    if fixed > max_bytes or not varying:
        return fixed <= max_bytes
    return fixed + (df.agg(F.sum(sum(varying[1:], varying[0]))).first()[0] or 0) <= max_bytes


def _varying_width(field: StructField) -> Column | None:
    """Bytes of a value beyond its fixed 16, None where it has no others."""
    kind, value = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, (StringType, BinaryType)):
        width = F.octet_length(value)
    elif isinstance(kind, ArrayType) and isinstance(kind.elementType, (NumericType, BooleanType, DatetimeType)):
        width = 8 * F.array_size(value)
    elif isinstance(kind, (ArrayType, MapType, StructType)):
        width = F.octet_length(F.to_json(F.struct(value)))
    else:
        return None
    return F.coalesce(width, F.lit(0)).cast("long")


def broadcast_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner", *,
                   max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hash join when ``dim`` is within the bound, skew-safe shuffle join beyond.

    ``dim`` is read twice (once to measure it), so pass a table, not an expensive plan.
    """
    if fits_broadcast(dim, max_rows, max_bytes):
        return fact.join(F.broadcast(dim), on, how)
    return hot_key_join(fact, dim, on, how)


def hot_key_join(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "inner",
                 hot_share: float = HOT_SHARE) -> DataFrame:
    """Shuffle join that survives hot keys of the fact.

    One pass over the keys makes a mergeable sketch of heavy hitters; whoever may hold at least ``hot_share`` of
    all fact rows is hot. The fact rows of a hot key are spread over one salt for each ``hot_share`` of the rows that
    it holds, and its ``dim`` rows are repeated once a salt: at most ``2 / hot_share`` copies over all hot keys together.
    Then one join does it, so the fact is read once for the sketch (its keys only) and once for the join. ``how`` is
    "inner" or "left"; fact rows with a null key match nothing, and are spread like those of any other key.
    """
    keys = [on] if isinstance(on, str) else list(on)
    dim = dim.dropna(subset=keys)
    if how == "inner":
        fact = fact.dropna(subset=keys)
    # Keys of both sides are hashed as the one type that the join compares them in.
    common = fact.select(*keys).limit(0).union(dim.select(*keys).limit(0)).schema
    mark = F.xxhash64(*(F.col(k).cast(common[k].dataType) for k in keys))
    hot = heavy_hitters(fact.select(mark.alias("__mark")), "__mark", hot_share)
    if not hot:
        return fact.join(dim, keys, how)
    salts = F.broadcast(fact.sparkSession.createDataFrame(
        [(key, math.ceil(share / hot_share)) for key, share in hot.items()], "__mark long, __salts int"))

    def salted(side: DataFrame) -> DataFrame:
        return side.withColumn("__mark", mark).join(salts, "__mark", "left").withColumn("__salts", F.coalesce("__salts", F.lit(1)))
    rows = salted(fact).withColumn("__salt", F.pmod(F.monotonically_increasing_id(), "__salts").cast("int"))
    copies = salted(dim).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)))
    extra = ["__mark", "__salts"]
    return rows.drop(*extra).join(copies.drop(*extra), [*keys, "__salt"], how).drop("__salt")


def heavy_hitters(df: DataFrame, col: str, share: float) -> dict:
    """Value -> estimated share for all values of ``col`` that hold at least ``share`` of the rows (nulls left out).

    The frequent-items sketch is aggregated like a sum, so no value is shuffled. Its error stays below a quarter of
    ``share``: a value may come out up to that much too large, so none is missed, but some that hold a little less than
    ``share`` can be among them. There are at most ``2 / share`` of them.
    """
    tracked = min(1_000_000, max(64, math.ceil(14 / share)))
    limit = min(tracked, math.ceil(2 / share))
    found = df.agg(F.count(col).alias("n"), F.expr(f"approx_top_k(`{col}`, {limit}, {tracked})").alias("top")).first()
    least = found["n"] * share
    return {row["item"]: row["count"] / found["n"] for row in found["top"] or [] if row["item"] is not None and row["count"] >= least}


def merge_join(left: DataFrame, right: DataFrame, on: str | list[str],
               how: str = "inner") -> DataFrame:
    """Equi-join that Spark is told to run as sort-merge; AQE splits skewed partitions."""
    return left.join(right.hint("merge"), on, how)


def lookup(fact: DataFrame, dim: DataFrame, key: str, value: str, *,
           default=None, out: str | None = None, **bound) -> DataFrame:
    """Append ``dim.value`` by ``key``; unmatched rows get ``default``.

    A key listed with several values keeps the greatest, so facts are never duplicated.
    """
    out = out or value
    names = as_table(dim.groupBy(key).agg(F.max(value).alias(out)), "lookup")
    joined = broadcast_join(fact, names, key, "left", **bound)
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


def average_by_dimension(fact: DataFrame, dim: DataFrame, key: str, group: str, measure: str, *,
                         out: str, strategy: str = "broadcast", how: str = "inner",
                         default: str | None = None, drop_null: bool = False) -> DataFrame:
    """``avg(measure)`` per ``dim.group`` over ``fact join dim``.

    The fact is reduced to one (sum, count) row per key before the join, so neither
    the size of the fact nor a hot key reaches the join. Several dimension rows for
    one key weight that key's facts once each, exactly as a row-level join would.
    ``how="left"`` sends unmatched keys to the group named ``default``.
    """
    if drop_null:
        fact = fact.where(F.col(measure).isNotNull())
    per_key = fact.groupBy(key).agg(F.sum(measure).alias("__sum"), F.count(measure).alias("__n"))
    dim = dim.select(key, group)
    if strategy == "broadcast":
        joined = broadcast_join(per_key, dim, key, how)
    elif strategy == "merge":
        joined = merge_join(per_key, dim, key, how)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    if how == "left":
        joined = joined.withColumn(group, F.coalesce(F.col(group), F.lit(default)))
    return (joined.groupBy(group)
            .agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
            .select(group, ratio(F.col("__sum"), F.col("__n")).alias(out)))


def average_by_own_label(fact: DataFrame, key: str, label: str, measure: str, *, out: str, extra: list[str] | None = None,
                         one_label: bool = False, drop_null: bool = False) -> DataFrame:
    """``avg(measure)`` per ``label`` over ``fact join its own dimension``, in one scan of ``fact``.

    The dimension is the distinct (key, label, *extra) of the fact, or with ``one_label`` the
    least label of each key; it comes from the same stored (sum, count) rows as the averages.
    ``drop_null`` leaves out labels without any measure.
    """
    rows = as_table(fact.where(F.col(key).isNotNull()).groupBy(key, label, *(extra or [])).agg(
        F.sum(measure).alias("__sum"), F.count(measure).alias("__n")), "labelled")
    totals = rows.groupBy(key).agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    names = rows.groupBy(key).agg(F.min(label).alias(label)) if one_label else rows.select(key, label)
    joined = totals.join(names, key).groupBy(label).agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    if drop_null:
        joined = joined.where("__n > 0")
    return joined.select(label, ratio(F.col("__sum"), F.col("__n")).alias(out))


def ratio(total: Column, count: Column) -> Column:
    """``total / count`` as double; null when nothing was counted (ANSI-safe)."""
    return F.when(count > 0, total.cast("double") / count)


def excluding(df: DataFrame, unwanted: DataFrame, on: str | list[str], **bound) -> DataFrame:
    """Rows of ``df`` whose key is not in ``unwanted`` (anti join)."""
    keys = [on] if isinstance(on, str) else list(on)
    keys_only = as_table(unwanted.select(*keys).distinct(), "unwanted")
    if fits_broadcast(keys_only, **bound):
        return df.join(F.broadcast(keys_only), keys, "left_anti")
    flagged = hot_key_join(df, keys_only.withColumn("__hit", F.lit(True)), keys, "left")
    return flagged.where(F.col("__hit").isNull()).drop("__hit")


def split_known(df: DataFrame, known: DataFrame, on: str):
    """(rows whose key is in ``known``, rows whose key is not).

    ``df`` is the small side as a rule (the users of a batch): its keys are measured and broadcast,
    so ``known`` is scanned once for its hits and never shuffled. Beyond the bound both are.
    """
    keys = as_table(df.select(on).distinct(), "keys")
    side = F.broadcast(keys) if fits_broadcast(keys) else keys
    hits = as_table(known.select(on).join(side, on, "left_semi").distinct().withColumn("__known", F.lit(True)), "known")
    flagged = broadcast_join(df, hits, on, "left")
    return flagged.where("__known").drop("__known"), flagged.where("__known is null").drop("__known")
