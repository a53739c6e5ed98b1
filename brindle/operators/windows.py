"""Window operators.

Windows run on pre-aggregated rows (one row per entity and period). Where a
result needs a statistic of a whole group next to each raw row, the group
is aggregated and joined back instead, so a hot group is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators.aggregates import spread
from brindle.operators.joins import broadcast_join
from brindle.operators.ordering import group_ranks, spread_moving_average, spread_running_total, tie_breakers
from brindle.session import as_table

MAX_WINDOW_GROUP = 5_000_000


def moving_average(df: DataFrame, entity: str, order: str | list[str], measure: str, *, out: str,
                   rows: int = 7, max_group: int | None = None) -> DataFrame:
    """Average of the current and the ``rows - 1`` preceding rows (rows, not days).

    A window sees one entity in one task, which is right for a row per entity and day. Pass ``max_group`` where an
    entity may be of any size: the input is then stored and its largest entity measured, and beyond the bound the rows
    of every entity are spread over all tasks, with rows equal in ``order`` taken in the order of the other columns.
    """
    order = [order] if isinstance(order, str) else list(order)
    if max_group is not None:
        df = as_table(df, "to-smooth")
        if largest_group(df, entity) > max_group:
            return spread_moving_average(df, entity, order, measure, out=out, rows=rows)
    frame = Window.partitionBy(entity).orderBy(*order).rowsBetween(1 - rows, Window.currentRow)
    return df.withColumn(out, F.avg(measure).over(frame))


def running_total(df: DataFrame, entity: str, order: str | list[str], measure: str, *, out: str,
                  max_group: int | None = None) -> DataFrame:
    """Cumulative sum per entity; ``max_group`` as in :func:`moving_average`."""
    order = [order] if isinstance(order, str) else list(order)
    if max_group is not None:
        df = as_table(df, "to-total")
        if largest_group(df, entity) > max_group:
            return spread_running_total(df, entity, order, measure, out=out)
    frame = (Window.partitionBy(entity).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, F.sum(measure).over(frame))


def largest_group(df: DataFrame, *keys: str) -> int:
    """Rows of the largest group of ``df``, 0 without rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def ranked(df: DataFrame, keys: list[str], measure: str, *, out: str = "rnk",
           method: str = "rank", tie_break: list[str] | None = None,
           max_group: int = MAX_WINDOW_GROUP) -> DataFrame:
    """Number rows of each group by descending measure.

    ``rank`` gives ties one number; ``row_number`` numbers them in ``tie_break`` order and
    then by all other columns, so the numbers do not depend on row order or group size. The input is stored once and its largest group measured: up to ``max_group`` rows a
    window per group does it, beyond that a sort spread over all tasks.
    """
    rows = as_table(df, "to-rank")
    if largest_group(rows, *keys) > max_group:
        return group_ranks(rows, keys, measure, out=out, method=method, tie_break=tie_break)
    order = [F.col(measure).desc_nulls_last()]
    if method == "row_number":
        order += [F.col(c) for c in tie_breakers(df, keys, measure, tie_break)]
    number = {"rank": F.rank, "row_number": F.row_number}[method]()
    return rows.withColumn(out, number.over(Window.partitionBy(*keys).orderBy(*order)))


def top_per_group(df: DataFrame, keys: list[str], k: int, *order, out: str = "rank") -> DataFrame:
    """First ``k`` rows per group in the given total order, numbered from 1.

    Plans as WindowGroupLimit: every task cuts its groups to ``k`` before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)


def outliers(df: DataFrame, keys: list[str], measure: str, *, sigmas: float = 3.0,
             sd: str = "samp", columns: list[str] | None = None,
             mean_out: str = "group_mean", sd_out: str = "group_sd", **bound) -> DataFrame:
    """Rows above group mean + ``sigmas`` standard deviations.

    Equivalent to an unordered window per group. Group statistics are written once
    and joined back, which needs no shuffle of the rows while they fit a broadcast.
    A group of one row has no sample deviation and reports nothing.
    """
    rows = df.where(F.col(measure).isNotNull())
    stats = as_table(spread(rows, keys, measure, sd=sd, mean_out=mean_out, sd_out=sd_out), "spread")
    if columns is not None:
        rows = rows.select(*dict.fromkeys([*keys, *columns, measure]))
    order = [*rows.columns, mean_out, sd_out]
    return (broadcast_join(rows, stats, keys, **bound)
            .where(F.col(measure) > F.col(mean_out) + F.lit(sigmas) * F.col(sd_out))
            .select(*order))


def latest_per_key(df: DataFrame, keys: list[str], order: str,
                   tie_break: list[str] | None = None) -> DataFrame:
    """One row per key: the newest by ``order`` (nulls oldest), then by ``tie_break``.

    An aggregate, not a window: copies of one key collapse before the shuffle. Ties
    left after ``tie_break`` are settled by the remaining columns, so the result does
    not depend on row order.
    """
    ranked_cols = list(dict.fromkeys([order, *(tie_break or []),
                                      *(c for c in df.columns if c not in keys)]))
    newest = df.groupBy(*keys).agg(F.max(F.struct(*ranked_cols)).alias("__newest"))
    return newest.select(*(F.col(c) if c in keys else F.col(f"__newest.{c}").alias(c)
                           for c in df.columns))


def latest_slice(df: DataFrame, marker: str) -> DataFrame:
    """Rows that carry the greatest ``marker`` (newest batch or window)."""
    return df.where(F.col(marker) == df.agg(F.max(marker)).scalar())
