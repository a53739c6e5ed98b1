"""Report queries over the tables the stream writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.aggregates import distinct_counts, top
from brindle.operators.ordering import exact_quantiles
from brindle.operators.windows import latest_slice

# Valid latency range, budget and bin count.
LATENCY_RANGE = (0, 600_000)
BUDGET_MS = 5_000
BINS = 40

#: Precision of activity sketches: the estimate's relative standard error is 1.04 / sqrt(2 ** LG_K), 0.8 %; a sketch
#: takes at most 2 ** LG_K bytes. While it holds few values it keeps them all.
LG_K = 14


def activity(windows: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys of a window table."""
    return distinct_counts(windows, key)


def activity_sketches(windows: DataFrame, *keys: str) -> DataFrame:
    """One row per window end of a window table: ``rows``, and for every key a mergeable sketch of its values
    (``sketch_<key>``). Values collapse in every task, so no key is shuffled. Nulls are counted as rows only."""
    return windows.groupBy("window_end").agg(
        F.count(F.lit(1)).alias("rows"), *(F.hll_sketch_agg(k, F.lit(LG_K)).alias(f"sketch_{k}") for k in keys))


def merged_activity(sketches: DataFrame, *keys: str, since: Column | None = None) -> DataFrame:
    """Like :func:`activity`, from stored sketches alone: rows and estimated distinct keys over all windows, or over
    those that end at ``since`` or later. What it reads grows with the windows, not with their rows."""
    if since is not None:
        sketches = sketches.where(F.col("window_end") >= since)
    return sketches.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{k}")), F.lit(0)).alias(f"distinct_{k}") for k in keys))


def activity_bitmaps(windows: DataFrame, key: str) -> DataFrame:
    """Exact counterpart of :func:`activity_sketches` for one integer key: per window end and bucket of 32,768 ids the
    ``rows`` and a bitmap of the ids (``bitmap_<key>``, 4 KB). Meant for ids that lie close together, such as those of a
    dictionary: a lone id far from all others takes a bitmap of its own. Nulls are counted as rows only."""
    return windows.groupBy("window_end", F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(f"bitmap_{key}"))


def merged_bitmaps(bitmaps: DataFrame, key: str, *, since: Column | None = None) -> DataFrame:
    """Like :func:`merged_activity`, from stored bitmaps and exact. Buckets are merged apart from each other, so no
    task holds the ids of all."""
    if since is not None:
        bitmaps = bitmaps.where(F.col("window_end") >= since)
    buckets = bitmaps.groupBy("bucket").agg(F.sum("rows").alias("rows"),
                                            F.bitmap_count(F.bitmap_or_agg(f"bitmap_{key}")).alias("ids"))
    return buckets.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                       F.coalesce(F.sum("ids"), F.lit(0)).alias(f"distinct_{key}"))


def latency_quantiles(latency: DataFrame, measure: str = "latency_ms",
                      probabilities=(0.5, 0.95, 0.99), bounds=LATENCY_RANGE) -> DataFrame:
    """Exact p50 / p95 / p99 of the samples inside the sane range: (probability, value, left_out).

    ``left_out`` counts the samples outside it, so that extreme lags do not go unseen.
    """
    inside = F.col(measure).between(*bounds)
    left_out = latency.agg(F.count(F.when(~inside, 1))).scalar()
    return exact_quantiles(latency.where(inside), measure, list(probabilities)).withColumn("left_out", left_out)


def histogram(df: DataFrame, measure: str, bins: int = BINS) -> DataFrame:
    """Equal-width bins over the value range: (bin, low, high, n), empty bins left out.

    The greatest value belongs to the last bin.
    """
    least, most = df.agg(F.min(measure)).scalar(), df.agg(F.max(measure)).scalar()
    framed = df.select(F.col(measure).cast("double").alias("v"),
                       least.cast("double").alias("lo"), most.cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    number = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(bins - 1)))
    return (framed.where(F.col("v").isNotNull())
            .groupBy(number.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.col("lo") + F.col("bin") * width).alias("low"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), "n"))


def recent(df: DataFrame, order: str, *tie_break: str, k: int) -> DataFrame:
    """The ``k`` newest rows."""
    return top(df, k, F.col(order).desc_nulls_last(), *(F.col(c).desc() for c in tie_break))


def over_budget(df: DataFrame, measure: str = "latency_ms", budget: float = BUDGET_MS) -> DataFrame:
    """Samples and the share of them above the budget."""
    return df.agg(F.count(measure).alias("samples"),
                  F.avg(F.when(F.col(measure) > budget, 1.0)
                        .when(F.col(measure).isNotNull(), 0.0)).alias("share_over_budget"))


def busiest(windows: DataFrame, key: str = "user_id", count: str = "count", k: int = 15) -> DataFrame:
    """Keys with the highest total count."""
    totals = windows.groupBy(key).agg(F.sum(count).alias("total"))
    return top(totals, k, F.col("total").desc(), key)


def trending_now(windows: DataFrame, k: int = 10) -> DataFrame:
    """Best items of the newest window."""
    return top(latest_slice(windows, "window_end"), k, F.col("trending_score").desc(), "item_id")


def newest_recommendations(recs: DataFrame, k: int = 50) -> DataFrame:
    """First rows of the newest recommendation batch, by user and rank."""
    return top(latest_slice(recs, "batch_id"), k, "user_id", "rank")


def newest_alerts(alerts: DataFrame, k: int = 20) -> DataFrame:
    """Newest alerts first."""
    return top(alerts, k, F.col("window_end").desc(), "alert_type", "subject")
