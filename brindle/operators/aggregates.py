"""Grouped aggregations. Each is one partial + final aggregate around one exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions.scores import share
from brindle.session import as_table


def summary(df: DataFrame, keys: list[str], measure: str, flag: str, *,
            rows="total", flagged="flagged") -> DataFrame:
    """Row count, sum of a 0/1 flag, and avg / max / min of a nullable measure."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(rows),
        F.sum(flag).alias(flagged),
        F.avg(measure).alias(f"avg_{measure}"),
        F.max(measure).alias(f"max_{measure}"),
        F.min(measure).alias(f"min_{measure}"))


def group_average(df: DataFrame, keys: list[str], measure: str, *, out: str, rows: str = "n",
                  drop_null: bool = True) -> DataFrame:
    """Average and row count per group.

    ``drop_null=True`` removes null measures first, so groups without a value vanish
    and ``n`` counts values; ``False`` keeps every group and counts every row.
    """
    if drop_null:
        df = df.where(F.col(measure).isNotNull())
    return df.groupBy(*keys).agg(F.avg(measure).alias(out), F.count(F.lit(1)).alias(rows))


def top_groups(df: DataFrame, keys: list[str], measure: str, *, out: str, rows: str = "n",
               min_count: int | None = 100, k: int = 20) -> DataFrame:
    """The ``k`` groups with the highest average among those with more than ``min_count`` rows."""
    groups = group_average(df, keys, measure, out=out, rows=rows, drop_null=False)
    if min_count is not None:
        groups = groups.where(F.col(rows) > min_count)
    return top(groups, k, F.col(out).desc_nulls_last(), *keys)


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows of a total order (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order).limit(k)


def per_day(df: DataFrame, entity: str, day: str, measure: str, *, out: str, how: str = "avg",
            drop_null: bool = False, null_as_zero: bool = False) -> DataFrame:
    """Daily average or sum per entity: the pre-aggregation before a window."""
    if drop_null:
        df = df.where(F.col(measure).isNotNull())
    value = F.coalesce(F.col(measure), F.lit(0.0)) if null_as_zero else F.col(measure)
    total = {"avg": F.avg, "sum": F.sum}[how](value)
    return df.groupBy(entity, day).agg(total.alias(out))


def share_within(df: DataFrame, keys: list[str], measure: str, limit: float, *,
                 out: str) -> DataFrame:
    """Share of non-null measures that are at most ``limit``, per group."""
    return (df.where(F.col(measure).isNotNull())
            .groupBy(*keys).agg(share(F.col(measure) <= limit).alias(out)))


def above_overall_average(df: DataFrame, key: str, measure: str, *, out: str) -> DataFrame:
    """Groups whose average is strictly above the average of all rows.

    The overall average comes from the groups' sums and counts, stored once, so ``df`` is
    scanned a single time.
    """
    groups = as_table(df.groupBy(key).agg(F.avg(measure).alias(out), F.sum(measure).cast("double").alias("__sum"),
                                          F.count(measure).alias("__n")), "groups")
    overall = groups.agg(F.try_divide(F.sum("__sum"), F.sum("__n"))).scalar()
    return groups.where(F.col(out) > overall).drop("__sum", "__n")


def largest_total(df: DataFrame, key: str, measures: list[str], *, out: str,
                  keep_totals: bool = True) -> DataFrame:
    """Sum every measure per group and name the largest.

    Null totals never win, the first listed measure wins a tie, and the name is null
    when every total is null.
    """
    totals = df.groupBy(key).agg(*(F.sum(m).alias(m) for m in measures))
    best = F.greatest(*(F.col(m) for m in measures))
    name = F.coalesce(*(F.when(F.col(m) == best, F.lit(m)) for m in measures))
    named = totals.withColumn(out, name)
    return named if keep_totals else named.select(key, out)


def spread(df: DataFrame, keys: list[str], measure: str, *, sd: str = "samp",
           mean_out: str = "mean", sd_out: str = "sd") -> DataFrame:
    """Mean and (sample or population) standard deviation per group."""
    deviation = {"samp": F.stddev_samp, "pop": F.stddev_pop}[sd]
    return df.groupBy(*keys).agg(F.avg(measure).alias(mean_out), deviation(measure).alias(sd_out))


def key_profile(df: DataFrame, key: str, label: str, *, rows: str = "n") -> DataFrame:
    """Row count and one (the least) label per key.

    Rows collapse to (key, label) counts first: a hash aggregate, whereas the least of a
    string alone would sort every row.
    """
    pairs = df.groupBy(key, label).agg(F.count(F.lit(1)).alias("__n"))
    return pairs.groupBy(key).agg(F.sum("__n").alias(rows), F.min(label).alias(label))


def dimension(df: DataFrame, *cols: str) -> DataFrame:
    """Distinct combinations of ``cols``: a dimension derived from the fact."""
    return df.select(*cols).distinct()


def pivot_min(df: DataFrame, row: str, column: str, value: str, columns: list[str]) -> DataFrame:
    """Least ``value`` per ``row`` x ``column``; the column list is given, so one pass suffices."""
    return (df.where(F.col(column).isin(columns))
            .groupBy(row).pivot(column, columns).agg(F.min(value)))


def rmse(df: DataFrame, label: str, prediction: str, *, out: str = "rmse") -> DataFrame:
    """Root mean squared error over rows that have a prediction."""
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    return df.where(~F.isnan(prediction)).agg(F.sqrt(F.avg(error * error)).alias(out))


def distinct_counts(df: DataFrame, *cols: str, rows: str = "rows", approximate: bool = False) -> DataFrame:
    """Row count and distinct count per listed column, one result row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(F.count(F.lit(1)).alias(rows), *(count(c).alias(f"distinct_{c}") for c in cols))
