"""Catalog: the flight presets, on line items dressed up as flights.

The supplier is the airline, nations are the airports and their region the city. The
delay grows with the sixth power of the quantity, so that routes have outliers, is a
whole number, and is missing for one return flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.dates import with_date_parts
from brindle.plans import flights as presets
from brindle.plans.catalog import Tables, bigint, query, rounded
from brindle.session import as_table

_PARTS = {cause: number for number, cause in enumerate(presets.CAUSES, start=1)}


def flights(t: Tables) -> DataFrame:
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))

    def airport(key: str, name: str, city: str) -> DataFrame:
        return nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name),
                             F.col("r_name").alias(city))

    orders = (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
              .join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
              .join(airport("c_nationkey", "DEST", "DEST_CITY"), "c_nationkey"))
    lines = (t.lineitem.withColumn("s_suppkey", F.col("l_suppkey"))
             .join(t.supplier.select("s_suppkey", "s_nationkey", "s_name"), "s_suppkey")
             .join(airport("s_nationkey", "ORIGIN", "ORIGIN_CITY"), "s_nationkey"))
    quantity = F.col("l_quantity")
    sixth = quantity * quantity * quantity * quantity * quantity * quantity
    rows = lines.join(orders, "l_orderkey").select(
        F.to_date("l_shipdate").alias("FL_DATE"), F.col("s_name").alias("AIRLINE"),
        F.concat(F.lit("S"), "l_suppkey").alias("AIRLINE_CODE"), F.col("l_suppkey").cast("int").alias("DOT_CODE"),
        "ORIGIN", "ORIGIN_CITY", "DEST", "DEST_CITY",
        F.when(F.col("l_returnflag") != "N", F.floor(sixth / 1e7).cast("double") - 5).alias("ARR_DELAY"),
        F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0).alias("CANCELLED"),
        F.col("l_extendedprice").alias("DISTANCE"),
        *(F.when(F.col("l_linenumber") == n, quantity).alias(cause) for cause, n in _PARTS.items()))
    return with_date_parts(rows, "FL_DATE")


def stored_flights(t: Tables, *cols: str) -> DataFrame:
    """For a question that reads the flights twice: one write of its columns beats a second join."""
    return as_table(flights(t).select(*cols), "flights")


_CAUSE_SQL = ", ".join(f'CASE WHEN l_linenumber = {n} THEN l_quantity END AS {cause}' for cause, n in _PARTS.items())
FLIGHTS = f"""(SELECT CAST(l_shipdate AS DATE) AS FL_DATE, s_name AS AIRLINE, 'S' || l_suppkey AS AIRLINE_CODE,
    o.n_name AS ORIGIN, r.r_name AS ORIGIN_CITY, d.n_name AS DEST,
    CASE WHEN l_returnflag <> 'N' THEN floor(l_quantity * l_quantity * l_quantity * l_quantity * l_quantity
      * l_quantity / 1e7) - 5 END AS ARR_DELAY,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS CANCELLED, l_extendedprice AS DISTANCE,
    year(l_shipdate) AS "YEAR", month(l_shipdate) AS "MONTH", {_CAUSE_SQL}
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation o ON s_nationkey = o.n_nationkey
  JOIN region r ON o.n_regionkey = r.r_regionkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation d ON c_nationkey = d.n_nationkey)"""


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("FL_DATE", F.col("FL_DATE").cast("string"))


@query(f"""SELECT CAST(FL_DATE AS VARCHAR) AS FL_DATE, AIRLINE_CODE, ORIGIN, DEST, ARR_DELAY, DISTANCE FROM {FLIGHTS}
           WHERE "MONTH" IN (12, 1, 2) AND ARR_DELAY >= 60 AND CANCELLED = 0 AND DISTANCE > 500""")
def flights_winter_long_delays(t):
    return _dated(presets.winter_long_delays(flights(t))).select(
        "FL_DATE", "AIRLINE_CODE", "ORIGIN", "DEST", "ARR_DELAY", "DISTANCE")


@query(f"""SELECT AIRLINE_CODE, count(*) AS total_flights, CAST(sum(CANCELLED) AS DOUBLE) AS cancellations,
             avg(ARR_DELAY) AS avg_arr_delay, max(ARR_DELAY) AS max_arr_delay, min(ARR_DELAY) AS min_arr_delay
           FROM {FLIGHTS} GROUP BY AIRLINE_CODE""")
def flights_airline_summary(t):
    return presets.airline_summary(flights(t))


@query(f"""SELECT AIRLINE_CODE, ORIGIN, "MONTH", avg(ARR_DELAY) AS avg_arr_delay, count(*) AS n FROM {FLIGHTS}
           WHERE ARR_DELAY IS NOT NULL GROUP BY ALL""")
def flights_delay_by_airline_origin_month(t):
    return presets.delay_by_airline_origin_month(flights(t)).withColumns(bigint("MONTH"))


@query(f"""SELECT ORIGIN, DEST, avg(ARR_DELAY) AS avg_delay, count(*) AS flights FROM {FLIGHTS}
           GROUP BY ORIGIN, DEST HAVING count(*) > 100 ORDER BY avg_delay DESC, ORIGIN, DEST LIMIT 20""")
def flights_most_delayed_routes(t):
    return presets.most_delayed_routes(flights(t))


@query(f"""SELECT AIRLINE_CODE, CAST(FL_DATE AS VARCHAR) AS FL_DATE, daily_avg, round(avg(daily_avg) OVER (
             PARTITION BY AIRLINE_CODE ORDER BY FL_DATE ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS ma7
           FROM (SELECT AIRLINE_CODE, FL_DATE, avg(ARR_DELAY) AS daily_avg FROM {FLIGHTS}
                 WHERE ARR_DELAY IS NOT NULL GROUP BY ALL)""")
def flights_delay_moving_average(t):
    return _dated(presets.delay_moving_average(flights(t))).withColumns(rounded(4, "ma7"))


@query(f"""SELECT AIRLINE_CODE, CAST(FL_DATE AS VARCHAR) AS FL_DATE, CAST(daily AS DOUBLE) AS daily_cancel,
             CAST(sum(daily) OVER (PARTITION BY AIRLINE_CODE ORDER BY FL_DATE) AS DOUBLE) AS cum_cancel
           FROM (SELECT AIRLINE_CODE, FL_DATE, sum(CANCELLED) AS daily FROM {FLIGHTS} GROUP BY ALL)""")
def flights_cumulative_cancellations(t):
    return _dated(presets.cumulative_cancellations(flights(t)))


@query(f"""SELECT *, rank() OVER (PARTITION BY "YEAR", "MONTH" ORDER BY on_time_rate DESC) AS rnk FROM (
             SELECT "YEAR", "MONTH", AIRLINE_CODE, sum(CASE WHEN ARR_DELAY <= 15 THEN 1 ELSE 0 END) / count(*)
               AS on_time_rate FROM {FLIGHTS} WHERE ARR_DELAY IS NOT NULL GROUP BY ALL)""")
def flights_on_time_ranking(t):
    return presets.on_time_ranking(flights(t)).withColumns(bigint("YEAR", "MONTH", "rnk"))


@query(f"""SELECT AIRLINE_CODE, avg(ARR_DELAY) AS avg_delay FROM {FLIGHTS} GROUP BY AIRLINE_CODE
           HAVING avg(ARR_DELAY) > (SELECT avg(ARR_DELAY) FROM {FLIGHTS})""")
def flights_worse_than_average(t):
    return presets.worse_than_average(flights(t))


def _positions(df: DataFrame) -> DataFrame:
    """Number the (few) rows of a display in the order in which they come."""
    return df.coalesce(1).withColumn("position", F.monotonically_increasing_id())


@query(f"""SELECT AIRLINE_CODE, row_number() OVER (ORDER BY count(*) DESC, AIRLINE_CODE) - 1 AS position
           FROM {FLIGHTS} GROUP BY AIRLINE_CODE""")
def flights_airline_summary_ordered(t):
    return _positions(presets.airline_summary(flights(t), ordered=True)).select("AIRLINE_CODE", "position")


@query(f"""SELECT "YEAR", "MONTH", AIRLINE_CODE, row_number() OVER (ORDER BY "YEAR", "MONTH", on_time_rate DESC, AIRLINE_CODE) - 1
             AS position FROM (SELECT "YEAR", "MONTH", AIRLINE_CODE, sum(CASE WHEN ARR_DELAY <= 15 THEN 1 ELSE 0 END) / count(*)
               AS on_time_rate FROM {FLIGHTS} WHERE ARR_DELAY IS NOT NULL GROUP BY ALL)""")
def flights_on_time_ranking_ordered(t):
    """Months in order, in each of them the airlines by rank."""
    shown = _positions(presets.on_time_ranking(flights(t), ordered=True))
    return shown.select("YEAR", "MONTH", "AIRLINE_CODE", "position").withColumns(bigint("YEAR", "MONTH"))


@query(f"""SELECT AIRLINE_CODE, row_number() OVER (ORDER BY avg(ARR_DELAY) DESC, AIRLINE_CODE) - 1 AS position
           FROM {FLIGHTS} GROUP BY AIRLINE_CODE HAVING avg(ARR_DELAY) > (SELECT avg(ARR_DELAY) FROM {FLIGHTS})""")
def flights_worse_than_average_ordered(t):
    return _positions(presets.worse_than_average(flights(t), ordered=True)).select("AIRLINE_CODE", "position")


@query(f"SELECT AIRLINE, avg(ARR_DELAY) AS avg_delay FROM {FLIGHTS} GROUP BY AIRLINE")
def flights_delay_by_airline_name(t):
    return presets.delay_by_airline_name(flights(t))


@query(f"SELECT ORIGIN_CITY, avg(ARR_DELAY) AS avg_delay FROM {FLIGHTS} GROUP BY ORIGIN_CITY")
def flights_delay_by_origin_city(t):
    return presets.delay_by_origin_city(flights(t))


@query(f"""WITH s AS (SELECT AIRLINE_CODE, {", ".join(f"sum({c}) AS {c}" for c in presets.CAUSES)}
                      FROM {FLIGHTS} GROUP BY AIRLINE_CODE)
           SELECT *, CASE greatest({", ".join(presets.CAUSES)})
             {" ".join(f"WHEN {c} THEN '{c}'" for c in presets.CAUSES)} END AS top_cause FROM s""")
def flights_top_delay_cause(t):
    return presets.top_delay_cause(flights(t))


@query(f"""SELECT CAST(FL_DATE AS VARCHAR) AS FL_DATE, AIRLINE_CODE, ORIGIN, DEST, ARR_DELAY, route_mean,
             round(route_sd, 6) AS route_sd
           FROM (SELECT *, avg(ARR_DELAY) OVER r AS route_mean, stddev_samp(ARR_DELAY) OVER r AS route_sd
                 FROM {FLIGHTS} WHERE ARR_DELAY IS NOT NULL WINDOW r AS (PARTITION BY ORIGIN, DEST))
           WHERE ARR_DELAY > route_mean + 3 * route_sd""")
def flights_delay_outliers(t):
    table = stored_flights(t, "FL_DATE", "AIRLINE_CODE", "ORIGIN", "DEST", "ARR_DELAY")
    return _dated(presets.delay_outliers(table)).withColumns(rounded(6, "route_sd"))
