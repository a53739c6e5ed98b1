"""Global order without a single-task window: dense ids and exact quantiles.

Rows are range-partitioned by the order, written with (task, position) and
renumbered with per-task offsets. Only one row per task meets in one place.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.session import as_table

_POSITION_BITS = (1 << 33) - 1

#: Rows of a sort task whose rows a window works on after that, so that its memory does not grow with the input.
TASK_ROWS = 500_000


def _sorted_parts(df: DataFrame, *order, tasks: int = 0) -> DataFrame:
    """Stored rows of ``df`` with their task number and position in a total order, sorted by ``tasks`` tasks if given."""
    ordered = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order) if tasks else df.orderBy(*order)
    placed = ordered.select(
        "*",
        F.spark_partition_id().alias("__part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("__pos"))
    return as_table(placed, "sorted")


def _offsets(parts: DataFrame, amount: Column) -> DataFrame:
    """``amount`` of all earlier parts, per part: as many rows as there were sort tasks."""
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.groupBy("__part").agg(amount.alias("__amount"))
            .withColumn("__offset", F.coalesce(F.sum("__amount").over(before), F.lit(0))))


def dense_ids(df: DataFrame, *order, out: str = "id") -> DataFrame:
    """Append 0, 1, 2, … in the given total order."""
    return _numbered(df, *order).withColumnRenamed("__at", out).drop("__part", "__pos")


def _enough_tasks(stored: DataFrame) -> int:
    """Tasks among which no one has many more than ``TASK_ROWS`` rows of a stored table; 0 if the session's number will do."""
    spark = stored.sparkSession
    usual = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                               spark.conf.get("spark.sql.shuffle.partitions")))
    tasks = -(-stored.count() // TASK_ROWS)
    return tasks if tasks > min(usual, spark.sparkContext.defaultParallelism) else 0


def _together(placed: DataFrame, tasks: int) -> DataFrame:
    """Rows of a sort task in one task again, for windows within it."""
    return placed.repartition(tasks, "__part") if tasks else placed


def _numbered(df: DataFrame, *order, tasks: int = 0) -> DataFrame:
    """Stored rows with ``__part`` and their global position ``__at``."""
    parts = _sorted_parts(df, *order, tasks=tasks)
    offsets = _offsets(parts, F.count(F.lit(1))).select("__part", "__offset")
    return (parts.join(F.broadcast(offsets), "__part")
            .withColumn("__at", F.col("__pos") + F.col("__offset")).drop("__offset"))


def tie_breakers(df: DataFrame, keys: list[str], measure: str, tie_break: list[str] | None) -> list[str]:
    """Columns that order rows of equal keys and measure: ``tie_break``, then all others."""
    return [c for c in dict.fromkeys([*(tie_break or []), *df.columns]) if c not in keys and c != measure]


def group_ranks(df: DataFrame, keys: list[str], measure: str, *, out: str = "rnk",
                method: str = "rank", tie_break: list[str] | None = None) -> DataFrame:
    """``rank`` or ``row_number`` by descending measure, for groups of any size.

    ``df`` is a stored table. Rows are sorted by (keys, measure, rest) over all tasks, so a large group is spread
    over many of them. A rank is the distance between two global positions: the start of
    the run of equal measures (or the row itself) and the start of the group.
    """
    rest = tie_breakers(df, keys, measure, tie_break)
    order = [*(F.col(k) for k in keys), F.col(measure).desc_nulls_last(), *(F.col(c) for c in rest)]
    # Copies of one row would all sort into one task; the row number of the scan parts them.
    tasks = _enough_tasks(df)
    rows = _numbered(df.withColumn("__copy", F.monotonically_increasing_id()), *order, "__copy", tasks=tasks)
    placed = _with_run_start(_together(rows, tasks), rows, list(keys), "__group")
    if method == "rank":
        placed = _with_run_start(placed, rows, [*keys, measure], "__tie")
    else:
        placed = placed.withColumn("__tie", F.col("__at"))
    return placed.select(*df.columns, (F.col("__tie") - F.col("__group") + 1).alias(out))


def _with_run_start(placed: DataFrame, rows: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Append the position where the row's run of equal ``cols`` starts.

    The start is looked for within the sort task. Only the first run of a task can have
    begun in an earlier one; those runs (one per task) are looked up over all rows.
    """
    heads = rows.where(F.col("__pos") == 0).select(
        F.col("__part").alias("__p"), *(F.col(c).alias(f"__h{i}") for i, c in enumerate(cols)))
    names = [f"__h{i}" for i in range(len(cols))]
    same_run = reduce(and_, (F.col(c).eqNullSafe(F.col(h)) for c, h in zip(cols, names)))

    values = heads.select(*names).distinct()
    first = (rows.join(F.broadcast(values), same_run)
             .groupBy(*names).agg(F.min("__at").alias("__first")))
    same_head = reduce(and_, (F.col(f"h.{h}").eqNullSafe(F.col(f"f.{h}")) for h in names))
    starts = as_table(heads.alias("h").join(first.alias("f"), same_head)
                      .select("__p", *(f"h.{h}" for h in names), "__first"), "run-starts")

    local = F.min("__at").over(Window.partitionBy("__part", *cols))
    joined = placed.withColumn(out, local).join(
        F.broadcast(starts), (F.col("__part") == F.col("__p")) & same_run, "left")
    return joined.withColumn(out, F.coalesce("__first", out)).drop("__p", "__first", *names)


def _in_order(df: DataFrame, entity: str, order: list[str], tasks: int = 0) -> DataFrame:
    """Numbered rows of the stored table ``df`` by entity and order, then by all other columns; an entity may run over many sort tasks."""
    rest = [c for c in df.columns if c != entity and c not in order]
    return _numbered(df.withColumn("__copy", F.monotonically_increasing_id()), entity, *order, *rest, "__copy", tasks=tasks)


def spread_moving_average(df: DataFrame, entity: str, order: list[str], measure: str, *, out: str, rows: int) -> DataFrame:
    """Moving average whose entities are spread over all tasks: the rows are sorted once, and every sort task gets the
    ``rows - 1`` rows before its first one as a halo, from however many tasks they lie in."""
    tasks = _enough_tasks(df)
    numbered = _in_order(df, entity, order, tasks).withColumn("__halo", F.lit(False))
    placed = numbered
    if rows > 1:
        start = F.col("__at")
        wanted = as_table(numbered.where("__pos = 0").select(
            F.col("__part").alias("__to"), F.explode(F.sequence(start - (rows - 1), start - 1)).alias("__at")), "halo")
        halo = numbered.join(wanted, "__at").drop("__part", "__halo").withColumnRenamed("__to", "__part")
        placed = numbered.unionByName(halo.withColumn("__halo", F.lit(True)))
    frame = Window.partitionBy("__part", entity).orderBy("__at").rowsBetween(1 - rows, Window.currentRow)
    return _together(placed, tasks).withColumn(out, F.avg(measure).over(frame)).where(~F.col("__halo")).select(*df.columns, out)


def spread_running_total(df: DataFrame, entity: str, order: list[str], measure: str, *, out: str) -> DataFrame:
    """Running total whose entities are spread over all tasks: totals within a sort task, plus what the entity of its
    first row adds up to in earlier tasks. Sums of floating-point numbers may differ from a plain window in their last digits."""
    tasks = _enough_tasks(df)
    numbered = _in_order(df, entity, order, tasks)
    local = Window.partitionBy("__part", entity).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = _together(numbered, tasks).withColumn(out, F.sum(measure).over(local))
    # Only the entity of a task's first row has rows in earlier tasks, so there is about one total a task.
    heads = numbered.where("__pos = 0").select(F.col(entity).alias("__head")).distinct()
    totals = (numbered.join(F.broadcast(heads), F.col(entity).eqNullSafe(F.col("__head")))
              .groupBy(F.col("__part").alias("__to"), "__head").agg(F.sum(measure).alias("__sum")))
    before = Window.partitionBy("__head").orderBy("__to").rowsBetween(Window.unboundedPreceding, -1)
    carried = as_table(totals.withColumn("__carry", F.sum("__sum").over(before).cast(placed.schema[out].dataType))
                       .where("__carry IS NOT NULL").drop("__sum"), "carried")
    same = (F.col("__part") == F.col("__to")) & F.col(entity).eqNullSafe(F.col("__head"))
    return placed.join(F.broadcast(carried), same, "left").select(
        *df.columns, F.coalesce((F.col(out) + F.col("__carry")).cast(placed.schema[out].dataType), out, "__carry").alias(out))


#: Size of the sketch that brackets quantiles (its rank error is about 0.3 % then), and the share of the rows on each
#: side of a rank that a bracket takes; wider ones follow if the rank is not inside.
SKETCH, MARGINS = 1024, (0.005, 0.05, 1.0)


def _brackets(df: DataFrame, measure: Column, places: list[tuple[float, int, int]]):
    """Disjoint spans of values that hold the wanted ranks: (lowest, highest, rows below, rows inside).

    ``places`` has a probability with the ranks on its two sides. One pass makes a mergeable sketch, another counts
    the rows below and inside of the spans that it suggests.
    """
    for margin in MARGINS:
        if margin == 1.0:
            spans = [(None, None)]
        else:
            sketch = df.agg(F.kll_sketch_agg_double(measure, F.lit(SKETCH)).alias("s"))
            # A sketch of rows that are all no numbers is empty.
            ends = [F.when(F.kll_sketch_get_n_double("s") > 0, F.array(*(
                F.kll_sketch_get_quantile_double("s", F.lit(min(1.0, max(0.0, p + side * margin)))) for side in (-1, 1))))
                .otherwise(F.array(F.lit(None), F.lit(None)).cast("array<double>")) for p, *_ in places]
            # What lies beyond the first or last rank has no bound: it may be infinite or no number.
            spans = _joined([(None if p <= margin else low, None if p + margin >= 1 else high)
                             for (p, *_), (low, high) in zip(places, sketch.select(*ends).first())])
        inside = [_within(measure, low, high) for low, high in spans]
        below = [F.lit(False) if low is None else measure < low for low, _ in spans]
        counted = df.agg(*(F.count_if(c) for c in below), *(F.count_if(c) for c in inside)).first()
        out = [(*span, counted[i], counted[len(spans) + i]) for i, span in enumerate(spans)]
        if all(any(n <= rank < n + many for *_, n, many in out) for _, low, high in places for rank in (low, high)):
            return out
    raise AssertionError("the span of all values holds every rank")


def _within(measure: Column, low: float | None, high: float | None) -> Column:
    found = F.lit(True) if low is None else measure >= low
    return found if high is None else found & (measure <= high)


def _joined(spans: list[tuple]) -> list[tuple]:
    """Spans in ascending order with those joined that touch; None is without bound."""
    least = [(-math.inf if low is None else low, math.inf if high is None else high) for low, high in spans]
    out: list[list[float]] = []
    for low, high in sorted(least):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(None if low == -math.inf else low, None if high == math.inf else high) for low, high in out]


def exact_quantiles(df: DataFrame, measure: str, probabilities: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: rows ``(probability, value)``.

    A sketch brackets the wanted ranks, one pass counts the rows below and inside of the brackets, and only rows inside
    are sorted (about a hundredth of them for each probability). Equal values collapse to (value, count) before that
    sort, and only the sort tasks that contain a wanted rank are cumulated. ``df`` is read three times,
    so pass a table. Nulls are left out, what is no number counts as greatest, and without rows there are no quantiles.
    """
    spark = df.sparkSession
    rows = df.where(F.col(measure).isNotNull()).select(F.col(measure).cast("double").alias("value"))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "probability double, value double")
    value = F.col("value")
    places = [(float(p), math.floor(p * (total - 1)), min(math.floor(p * (total - 1)) + 1, total - 1)) for p in probabilities]
    spans = _brackets(rows, value, places)
    chosen = reduce(or_, (_within(value, low, high) for low, high, *_ in spans), F.lit(False))
    parts = _sorted_parts(rows.where(chosen).groupBy("value").agg(F.count(F.lit(1)).alias("n")), "value")
    offsets = as_table(_offsets(parts, F.sum("n")), "quantile-offsets")

    def moved(rank: int) -> int:
        """The rank among the rows inside of brackets."""
        before = 0
        for *_, below, inside in spans:
            if below <= rank < below + inside:
                return rank - below + before
            before += inside
        raise AssertionError(rank)
    wanted = spark.createDataFrame([(p, moved(low), moved(high), p * (total - 1) - low) for p, low, high in places],
                                   "probability double, low long, high long, weight double")
    # Two ranks per probability: the broadcast size is fixed by the caller's list.
    ranks = F.broadcast(wanted.select(F.explode(F.array("low", "high")).alias("rank")).distinct())

    covers = ((F.col("rank") >= F.col("__offset"))
              & (F.col("rank") < F.col("__offset") + F.col("__amount")))
    needed = F.broadcast(offsets.join(ranks, covers, "left_semi").select("__part", "__offset"))
    within = Window.partitionBy("__part").orderBy("__pos")
    spans = (parts.join(needed, "__part")
             .withColumn("__end", F.col("__offset") + F.sum("n").over(within)))
    hit = (F.col("rank") < F.col("__end")) & (F.col("rank") >= F.col("__end") - F.col("n"))
    found = as_table(spans.join(ranks, hit).select("rank", "value"), "quantile-ranks")

    low = found.select(F.col("rank").alias("low"), F.col("value").alias("__low"))
    high = found.select(F.col("rank").alias("high"), F.col("value").alias("__high"))
    value = F.col("__low") + F.col("weight") * (F.col("__high") - F.col("__low"))
    return wanted.join(low, "low").join(high, "high").select("probability", value.alias("value"))
