"""The flight-delay questions, as presets of the generic operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators import aggregates, filters, joins, windows
from brindle.session import as_table
from brindle.sources.readers import register

# Thresholds and the delay-cause columns, in their order of precedence.
WINTER = (12, 1, 2)
LONG_DELAY, LONG_DISTANCE, ON_TIME = 60, 500, 15
CAUSES = ["DELAY_DUE_CARRIER", "DELAY_DUE_WEATHER", "DELAY_DUE_NAS", "DELAY_DUE_SECURITY",
          "DELAY_DUE_LATE_AIRCRAFT"]


def airlines(flights: DataFrame, view: str | None = "airlines_dim") -> DataFrame:
    """Airline dimension derived from the flights."""
    return register(aggregates.dimension(flights, "AIRLINE_CODE", "AIRLINE", "DOT_CODE"), view)


def airports(flights: DataFrame, view: str | None = "airport_stats") -> DataFrame:
    """Flights and city per origin airport."""
    stats = aggregates.key_profile(flights, "ORIGIN", "ORIGIN_CITY", rows="ORIGIN_FLIGHT_COUNT")
    return register(stats, view)


def winter_long_delays(flights: DataFrame) -> DataFrame:
    """Flown long-distance winter flights that arrived at least an hour late."""
    return filters.all_of(flights, F.col("MONTH").isin(*WINTER), F.col("ARR_DELAY") >= LONG_DELAY,
                          F.col("CANCELLED") == 0, F.col("DISTANCE") > LONG_DISTANCE)


def airline_summary(flights: DataFrame, ordered: bool = False) -> DataFrame:
    """Flights, cancellations and arrival-delay statistics per airline, ``ordered`` by most flights."""
    stats = aggregates.summary(flights, ["AIRLINE_CODE"], "ARR_DELAY", "CANCELLED",
                               rows="total_flights", flagged="cancellations")
    stats = stats.withColumnsRenamed({f"{f}_ARR_DELAY": f"{f}_arr_delay" for f in ("avg", "max", "min")})
    return stats.orderBy(F.col("total_flights").desc(), "AIRLINE_CODE") if ordered else stats


def delay_by_airline_origin_month(flights: DataFrame, drop_null: bool = True) -> DataFrame:
    """Average arrival delay per airline, origin and month."""
    return aggregates.group_average(flights, ["AIRLINE_CODE", "ORIGIN", "MONTH"], "ARR_DELAY",
                                    out="avg_arr_delay", drop_null=drop_null)


def most_delayed_routes(flights: DataFrame, min_count: int | None = 100, k: int = 20) -> DataFrame:
    """Routes with the highest average arrival delay."""
    return aggregates.top_groups(flights, ["ORIGIN", "DEST"], "ARR_DELAY", out="avg_delay",
                                 rows="flights", min_count=min_count, k=k)


def delay_moving_average(flights: DataFrame) -> DataFrame:
    """Daily average arrival delay per airline with its 7-row moving average."""
    daily = aggregates.per_day(flights, "AIRLINE_CODE", "FL_DATE", "ARR_DELAY", out="daily_avg",
                               drop_null=True)
    return windows.moving_average(daily, "AIRLINE_CODE", "FL_DATE", "daily_avg", out="ma7")


def cumulative_cancellations(flights: DataFrame, null_as_zero: bool = False) -> DataFrame:
    """Daily and running cancellations per airline."""
    daily = aggregates.per_day(flights, "AIRLINE_CODE", "FL_DATE", "CANCELLED", out="daily_cancel",
                               how="sum", null_as_zero=null_as_zero)
    return windows.running_total(daily, "AIRLINE_CODE", "FL_DATE", "daily_cancel", out="cum_cancel")


def on_time_ranking(flights: DataFrame, method: str = "rank", ordered: bool = False) -> DataFrame:
    """Airlines ranked by monthly on-time share, ``ordered`` by month and rank."""
    monthly = aggregates.share_within(flights, ["YEAR", "MONTH", "AIRLINE_CODE"], "ARR_DELAY",
                                      ON_TIME, out="on_time_rate")
    ranks = windows.ranked(monthly, ["YEAR", "MONTH"], "on_time_rate", method=method,
                           tie_break=["AIRLINE_CODE"])
    return ranks.orderBy("YEAR", "MONTH", "rnk", "AIRLINE_CODE") if ordered else ranks


def worse_than_average(flights: DataFrame, ordered: bool = False) -> DataFrame:
    """Airlines whose average arrival delay is above that of all flights, ``ordered`` by the worst."""
    worse = aggregates.above_overall_average(flights, "AIRLINE_CODE", "ARR_DELAY", out="avg_delay")
    return worse.orderBy(F.col("avg_delay").desc(), "AIRLINE_CODE") if ordered else worse


def delay_by_airline_name(flights: DataFrame, how: str = "inner") -> DataFrame:
    """Average arrival delay per airline name (join with the dimension of the same flights).

    ``how="left"`` looks names up instead: one name per code, ``UNKNOWN`` without one,
    null delays left out.
    """
    if how == "left":
        names = as_table(airlines(flights, None), "airlines").groupBy("AIRLINE_CODE").agg(
            F.max("AIRLINE").alias("AIRLINE"))
        return joins.average_by_dimension(flights, names, "AIRLINE_CODE", "AIRLINE", "ARR_DELAY",
                                          out="avg_delay", how="left", default="UNKNOWN",
                                          drop_null=True)
    return joins.average_by_own_label(flights, "AIRLINE_CODE", "AIRLINE", "ARR_DELAY", out="avg_delay",
                                      extra=["DOT_CODE"])


def delay_by_origin_city(flights: DataFrame, drop_null: bool = False) -> DataFrame:
    """Average arrival delay per origin city, each airport under its least city name."""
    return joins.average_by_own_label(flights, "ORIGIN", "ORIGIN_CITY", "ARR_DELAY", out="avg_delay",
                                      one_label=True, drop_null=drop_null)


def top_delay_cause(flights: DataFrame) -> DataFrame:
    """Delay minutes per cause and the largest cause, per airline."""
    return aggregates.largest_total(flights, "AIRLINE_CODE", CAUSES, out="top_cause")


def delay_outliers(flights: DataFrame, sd: str = "samp", **bound) -> DataFrame:
    """Flights more than three standard deviations above their route's average."""
    return windows.outliers(flights, ["ORIGIN", "DEST"], "ARR_DELAY", sd=sd, mean_out="route_mean",
                            columns=["FL_DATE", "AIRLINE_CODE"], sd_out="route_sd", **bound)


QUERIES = {f.__name__: f for f in (
    winter_long_delays, airline_summary, delay_by_airline_origin_month, most_delayed_routes,
    delay_moving_average, cumulative_cancellations, on_time_ranking, worse_than_average,
    delay_by_airline_name, delay_by_origin_city, top_delay_cause, delay_outliers)}
