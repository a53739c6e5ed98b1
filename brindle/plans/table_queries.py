"""Catalog: filters, aggregates, joins, windows, sources and sinks on the sales tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.dates import with_date_parts
from brindle.operators import aggregates, filters, joins, ordering, reports, windows
from brindle.plans import studies
from brindle.plans.catalog import Tables, bigint, query, rounded
from brindle.session import as_table, scratch_path
from brindle.sources import readers, writers


def shipments(t: Tables) -> DataFrame:
    """Line items as trips: carrier, day, nullable quantity, 0/1 cancelled flag."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("carrier"), "l_orderkey", "l_partkey", "l_returnflag",
        F.to_date("l_shipdate").alias("day"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("qty"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(0).alias("cancelled"))


SHIPMENTS = """(SELECT l_suppkey AS carrier, l_orderkey, l_partkey, l_returnflag,
    CAST(l_shipdate AS DATE) AS day,
    CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS qty,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS cancelled
  FROM lineitem)"""


def trips(t: Tables) -> DataFrame:
    """Line items with the supplier's nation as origin and the customer's as destination.

    No side is hinted: Catalyst broadcasts a table below its size threshold and
    otherwise sort-merges, where AQE splits a key that holds many rows. Dimensions are
    joined one by one, since the size of a pre-joined dimension would be overestimated.
    """
    def nation(key: str, name: str) -> DataFrame:
        return t.nation.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))

    lines = (t.lineitem.select("l_orderkey", F.col("l_suppkey").alias("s_suppkey"), "l_quantity")
             .join(t.supplier.select("s_suppkey", "s_nationkey"), "s_suppkey")
             .join(nation("s_nationkey", "origin"), "s_nationkey")
             .select(F.col("l_orderkey").alias("o_orderkey"), "origin", F.col("l_quantity").alias("qty")))
    orders = (t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
              .join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
              .join(nation("c_nationkey", "dest"), "c_nationkey")
              .select("o_orderkey", "dest"))
    return lines.join(orders, "o_orderkey").select("origin", "dest", "qty")


TRIPS = """(SELECT sn.n_name AS origin, cn.n_name AS dest, l_quantity AS qty
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey)"""


# --- filters and projections -------------------------------------------------------

@query("""SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate,
                            CAST(l_linenumber AS BIGINT) AS l_linenumber)
          FROM lineitem WHERE month(l_shipdate) IN (12, 1, 2) AND l_quantity >= 40
            AND l_returnflag <> 'R' AND l_extendedprice > 50000""")
def winter_filter(t):
    rows = filters.all_of(t.lineitem, F.month("l_shipdate").isin(12, 1, 2), F.col("l_quantity") >= 40,
                          F.col("l_returnflag") != "R", F.col("l_extendedprice") > 50000)
    return rows.withColumns({"l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
                             **bigint("l_linenumber")})


@query(f"SELECT carrier, CAST(day AS VARCHAR) AS day, qty FROM {SHIPMENTS} WHERE qty IS NOT NULL")
def present_measures(t):
    rows = filters.present(shipments(t), "qty")
    return rows.select("carrier", F.col("day").cast("string").alias("day"), "qty")


@query("""SELECT o_orderkey, year(o_orderdate) AS "YEAR", month(o_orderdate) AS "MONTH",
                 dayofweek(o_orderdate) + 1 AS "DAY_OF_WEEK" FROM orders""")
def date_parts(t):
    parts = with_date_parts(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")
    return parts.drop("o_orderdate").withColumns(bigint("YEAR", "MONTH", "DAY_OF_WEEK"))


@query("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20
            AND l_returnflag <> 'N'""")
def valid_range(t):
    rows = t.lineitem.withColumn("flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return filters.valid_range(rows, "l_quantity", 10, 20, "flag").select(
        "l_orderkey", "l_partkey", "l_quantity")


@query("SELECT count(*) AS total, CAST(0 AS BIGINT) AS on_both_sides FROM orders")
def hash_split_cover(t):
    train, test = filters.hash_split(t.orders.select("o_orderkey"), ["o_orderkey"], 80)
    sides = train.withColumn("side", F.lit(0)).unionByName(test.withColumn("side", F.lit(1)))
    twice = sides.groupBy("o_orderkey").agg(F.count_distinct("side").alias("sides"),
                                            F.count(F.lit(1)).alias("n"))
    return twice.agg(F.sum("n").alias("total"),
                     F.count(F.when(F.col("sides") > 1, 1)).alias("on_both_sides"))


_MD5_BUCKET = "CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8) AS BIGINT) % {}"


@query(f"SELECT o_orderkey, {_MD5_BUCKET.format('o_orderkey', 100)} < 80 AS train FROM orders")
def hash_split_sides(t):
    train, test = filters.hash_split(t.orders.select("o_orderkey"), ["o_orderkey"], 80)
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


@query(f"SELECT o_orderkey FROM orders WHERE {_MD5_BUCKET.format('o_custkey', 4)} < 1")
def hash_share_rows(t):
    return filters.hash_share(t.orders, ["o_custkey"], 1, 4).select("o_orderkey")


@query("SELECT count(DISTINCT o_custkey) AS keys, CAST(0 AS BIGINT) AS cut_keys FROM orders")
def hash_share_keeps_whole_keys(t):
    rows = t.orders.select("o_custkey")
    kept = filters.hash_share(rows, ["o_custkey"], 1, 4).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("kept"))
    sizes = rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(kept, "o_custkey", "left").agg(
        F.count("n").alias("keys"), F.count(F.when(F.col("kept") != F.col("n"), 1)).alias("cut_keys"))


# --- aggregates ------------------------------------------------------------------------

@query(f"""SELECT carrier, count(*) AS total, CAST(sum(cancelled) AS BIGINT) AS flagged,
             avg(qty) AS avg_qty, max(qty) AS max_qty, min(qty) AS min_qty
           FROM {SHIPMENTS} GROUP BY carrier""")
def carrier_summary(t):
    return aggregates.summary(shipments(t), ["carrier"], "qty", "cancelled")


@query(f"""SELECT carrier, l_returnflag, month(day) AS mon, avg(qty) AS avg_qty, count(*) AS n
           FROM {SHIPMENTS} WHERE qty IS NOT NULL GROUP BY ALL""")
def carrier_flag_month_average(t):
    rows = shipments(t).withColumn("mon", F.month("day").cast("bigint"))
    return aggregates.group_average(rows, ["carrier", "l_returnflag", "mon"], "qty", out="avg_qty")


@query(f"""SELECT carrier, l_returnflag, month(day) AS mon, avg(qty) AS avg_qty, count(*) AS n
           FROM {SHIPMENTS} GROUP BY ALL""")
def carrier_flag_month_average_all_groups(t):
    rows = shipments(t).withColumn("mon", F.month("day").cast("bigint"))
    return aggregates.group_average(rows, ["carrier", "l_returnflag", "mon"], "qty", out="avg_qty",
                                    drop_null=False)


@query(f"""SELECT origin, dest, avg(qty) AS avg_qty, count(*) AS trips FROM {TRIPS}
           GROUP BY origin, dest HAVING count(*) > 20
           ORDER BY avg_qty DESC, origin, dest LIMIT 20""")
def top_routes(t):
    return aggregates.top_groups(trips(t), ["origin", "dest"], "qty", out="avg_qty", rows="trips",
                                 min_count=20)


@query(f"""SELECT origin, dest, avg(qty) AS avg_qty, count(*) AS trips FROM {TRIPS}
           GROUP BY origin, dest ORDER BY avg_qty DESC, origin, dest LIMIT 20""")
def top_routes_any_size(t):
    return aggregates.top_groups(trips(t), ["origin", "dest"], "qty", out="avg_qty", rows="trips",
                                 min_count=None)


@query(f"""SELECT carrier, CAST(day AS VARCHAR) AS day, avg(qty) AS daily_avg FROM {SHIPMENTS}
           WHERE qty IS NOT NULL GROUP BY carrier, day""")
def daily_average(t):
    daily = aggregates.per_day(shipments(t), "carrier", "day", "qty", out="daily_avg", drop_null=True)
    return daily.withColumn("day", F.col("day").cast("string"))


@query(f"""SELECT carrier, avg(qty) AS avg_qty FROM {SHIPMENTS} GROUP BY carrier
           HAVING avg(qty) > (SELECT avg(qty) FROM {SHIPMENTS})""")
def above_average_carriers(t):
    return aggregates.above_overall_average(shipments(t), "carrier", "qty", out="avg_qty")


@query("""WITH s AS (SELECT l_suppkey,
              sum(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS first,
              sum(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS second,
              sum(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS third,
              sum(CASE WHEN l_linenumber = 4 THEN l_quantity END) AS fourth,
              sum(CASE WHEN l_linenumber > 4 THEN l_quantity END) AS later
            FROM lineitem GROUP BY l_suppkey)
          SELECT *, CASE greatest(first, second, third, fourth, later) WHEN first THEN 'first'
              WHEN second THEN 'second' WHEN third THEN 'third' WHEN fourth THEN 'fourth'
              WHEN later THEN 'later' END AS top_part FROM s""")
def largest_total_part(t):
    line = F.col("l_linenumber")
    parts = {"first": line == 1, "second": line == 2, "third": line == 3, "fourth": line == 4,
             "later": line > 4}
    rows = t.lineitem.select("l_suppkey", *(F.when(c, F.col("l_quantity")).alias(n)
                                            for n, c in parts.items()))
    return aggregates.largest_total(rows, "l_suppkey", list(parts), out="top_part")


@query("""SELECT event_type, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd
          FROM events GROUP BY event_type""")
def spread_sample(t):
    return aggregates.spread(t.events, ["event_type"], "value").withColumns(rounded(6, "mean", "sd"))


@query("""SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd
          FROM events GROUP BY event_type""")
def spread_population(t):
    return aggregates.spread(t.events, ["event_type"], "value", sd="pop").withColumns(
        rounded(6, "mean", "sd"))


@query("SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1")
def customer_profile(t):
    return aggregates.key_profile(t.orders, "o_custkey", "o_orderpriority")


@query("SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def derived_dimension(t):
    return aggregates.dimension(t.lineitem, "l_suppkey", "l_returnflag", "l_linestatus")


@query("""SELECT o_orderpriority, min(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS "F",
            min(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS "O",
            min(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS "P"
          FROM orders GROUP BY o_orderpriority""")
def pivot_least(t):
    return aggregates.pivot_min(t.orders, "o_orderpriority", "o_orderstatus", "o_totalprice",
                                ["F", "O", "P"])


@query("""SELECT round(sqrt(avg((l_quantity - m) * (l_quantity - m))), 6) AS rmse FROM
          (SELECT l_quantity, avg(l_quantity) OVER (PARTITION BY l_partkey) AS m FROM lineitem)""")
def rmse_of_part_average(t):
    guess = t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("prediction"))
    rows = t.lineitem.select("l_partkey", "l_quantity").join(guess, "l_partkey")
    return aggregates.rmse(rows, "l_quantity", "prediction").withColumns(rounded(6, "rmse"))


@query("""SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_user_id,
                 count(DISTINCT event_type) AS distinct_event_type FROM events""")
def distinct_users_and_types(t):
    return aggregates.distinct_counts(t.events, "user_id", "event_type")


# --- joins -------------------------------------------------------------------------------

CARRIERS = """(SELECT s_suppkey AS carrier, n_name AS nation, s_acctbal AS balance FROM supplier
               JOIN nation ON s_nationkey = n_nationkey)"""


def carriers(t: Tables) -> DataFrame:
    return (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("carrier"), F.col("n_name").alias("nation"),
                    F.col("s_acctbal").alias("balance")))


@query(f"""SELECT nation, avg(qty) AS avg_qty FROM {SHIPMENTS} JOIN {CARRIERS} USING (carrier)
           GROUP BY nation""")
def broadcast_join_average(t):
    return joins.average_by_dimension(shipments(t), carriers(t), "carrier", "nation", "qty",
                                      out="avg_qty")


@query(f"""SELECT coalesce(nation, 'UNKNOWN') AS nation, avg(qty) AS avg_qty FROM {SHIPMENTS}
           LEFT JOIN (SELECT * FROM {CARRIERS} WHERE balance > 3000) USING (carrier)
           WHERE qty IS NOT NULL GROUP BY 1""")
def lookup_join_average(t):
    listed = carriers(t).where(F.col("balance") > 3000)
    return joins.average_by_dimension(shipments(t), listed, "carrier", "nation", "qty", out="avg_qty",
                                      how="left", default="UNKNOWN", drop_null=True)


@query(f"""SELECT l_orderkey, carrier, coalesce(nation, 'UNKNOWN') AS nation, qty FROM {SHIPMENTS}
           LEFT JOIN (SELECT * FROM {CARRIERS} WHERE balance > 3000) USING (carrier)""")
def lookup_with_default(t):
    listed = carriers(t).where(F.col("balance") > 3000)
    rows = shipments(t).select("l_orderkey", "carrier", "qty")
    return joins.lookup(rows, listed, "carrier", "nation", default="UNKNOWN")


@query("""WITH c AS (SELECT o_custkey, count(*) AS n, min(o_orderpriority) AS first_priority
                     FROM orders GROUP BY o_custkey)
          SELECT first_priority, avg(o_totalprice_cents) AS avg_cents
          FROM (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS o_totalprice_cents
                FROM orders) JOIN c USING (o_custkey) GROUP BY first_priority""")
def merge_join_average(t):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    orders = t.orders.withColumns({"cents": cents, "first_priority": F.col("o_orderpriority")})
    profile = aggregates.key_profile(orders, "o_custkey", "first_priority")
    return joins.average_by_dimension(orders, profile, "o_custkey", "first_priority", "cents",
                                      out="avg_cents", strategy="merge")


@query(f"""SELECT p_brand, avg(qty) AS avg_qty FROM {SHIPMENTS} JOIN part ON l_partkey = p_partkey
           WHERE qty IS NOT NULL GROUP BY p_brand""")
def merge_join_average_non_null(t):
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return joins.average_by_dimension(shipments(t), parts, "l_partkey", "p_brand", "qty",
                                      out="avg_qty", strategy="merge", drop_null=True)


@query("""SELECT l_orderkey, l_partkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey""")
def hot_key_join(t):
    """The beyond-broadcast path; keys with 1/1500 of the rows count as hot."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    rows = t.lineitem.select("l_orderkey", "l_partkey")
    return joins.hot_key_join(rows, parts, "l_partkey", hot_share=1 / 1500)


@query("""SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
          (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def anti_join_customers(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    return joins.excluding(t.customer.select("c_custkey", "c_name"),
                           urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


# --- windows, order, set operations ----------------------------------------------

@query(f"""SELECT carrier, CAST(day AS VARCHAR) AS day, daily_avg, round(avg(daily_avg) OVER (
             PARTITION BY carrier ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS ma7
           FROM (SELECT carrier, day, avg(qty) AS daily_avg FROM {SHIPMENTS} WHERE qty IS NOT NULL
                 GROUP BY carrier, day)""")
def moving_average(t):
    daily = aggregates.per_day(shipments(t), "carrier", "day", "qty", out="daily_avg", drop_null=True)
    smooth = windows.moving_average(daily, "carrier", "day", "daily_avg", out="ma7")
    return smooth.withColumns({"day": F.col("day").cast("string"), **rounded(4, "ma7")})


@query(f"""SELECT carrier, CAST(day AS VARCHAR) AS day, CAST(daily AS BIGINT) AS daily,
             CAST(sum(daily) OVER (PARTITION BY carrier ORDER BY day
                                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
           FROM (SELECT carrier, day, sum(cancelled) AS daily FROM {SHIPMENTS} GROUP BY carrier, day)""")
def running_total(t):
    rows = shipments(t).withColumn("cancelled", F.col("cancelled").cast("double"))
    daily = aggregates.per_day(rows, "carrier", "day", "cancelled", out="daily", how="sum",
                               null_as_zero=True)
    total = windows.running_total(daily, "carrier", "day", "daily", out="running")
    return total.withColumns({"day": F.col("day").cast("string"), **bigint("daily", "running")})


# Rows that are equal in all of these are the same to both questions.
_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


@query(f"""SELECT l_returnflag, {", ".join(_LINE_ORDER)}, round(avg(l_quantity) OVER (PARTITION BY l_returnflag
             ORDER BY {", ".join(_LINE_ORDER)} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS ma7 FROM lineitem""")
def moving_average_spread(t):
    """Raw rows, a third of them in each entity: beyond 1,000 rows an entity is spread over all tasks."""
    rows = t.lineitem.select("l_returnflag", *_LINE_ORDER)
    smooth = windows.moving_average(rows, "l_returnflag", _LINE_ORDER, "l_quantity", out="ma7", max_group=1000)
    return smooth.withColumns(rounded(4, "ma7"))


@query(f"""SELECT l_returnflag, {", ".join(_LINE_ORDER)}, CAST(sum(l_quantity) OVER (PARTITION BY l_returnflag
             ORDER BY {", ".join(_LINE_ORDER)} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM lineitem""")
def running_total_spread(t):
    rows = t.lineitem.select("l_returnflag", *_LINE_ORDER)
    total = windows.running_total(rows, "l_returnflag", _LINE_ORDER, "l_quantity", out="running", max_group=1000)
    return total.withColumns(bigint("running"))


_ON_TIME = f"""(SELECT year(day) AS yr, month(day) AS mon, carrier,
    sum(CASE WHEN qty <= 35 THEN 1 ELSE 0 END) / count(*) AS on_time
  FROM {SHIPMENTS} WHERE qty IS NOT NULL GROUP BY ALL)"""


def _on_time(t: Tables) -> DataFrame:
    rows = shipments(t).withColumns({"yr": F.year("day").cast("bigint"),
                                     "mon": F.month("day").cast("bigint")})
    return aggregates.share_within(rows, ["yr", "mon", "carrier"], "qty", 35, out="on_time")


@query(f"SELECT *, rank() OVER (PARTITION BY yr, mon ORDER BY on_time DESC) AS rnk FROM {_ON_TIME}")
def on_time_rank(t):
    return windows.ranked(_on_time(t), ["yr", "mon"], "on_time").withColumns(bigint("rnk"))


@query(f"""SELECT *, row_number() OVER (PARTITION BY yr, mon ORDER BY on_time DESC, carrier) AS rnk
           FROM {_ON_TIME}""")
def on_time_row_number(t):
    return windows.ranked(_on_time(t), ["yr", "mon"], "on_time", method="row_number",
                          tie_break=["carrier"]).withColumns(bigint("rnk"))


@query(f"SELECT *, rank() OVER (PARTITION BY yr, mon ORDER BY on_time DESC) AS rnk FROM {_ON_TIME}")
def on_time_rank_spread(t):
    """The path for groups too large for one task."""
    return windows.ranked(_on_time(t), ["yr", "mon"], "on_time", max_group=0).withColumns(bigint("rnk"))


@query(f"""SELECT *, row_number() OVER (PARTITION BY yr, mon ORDER BY on_time DESC, carrier) AS rnk
           FROM {_ON_TIME}""")
def on_time_row_number_spread(t):
    return windows.ranked(_on_time(t), ["yr", "mon"], "on_time", method="row_number",
                          tie_break=["carrier"], max_group=0).withColumns(bigint("rnk"))


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority, rank() OVER (
            PARTITION BY o_orderstatus ORDER BY o_orderpriority DESC) AS rnk FROM orders""")
def rank_with_long_ties(t):
    """Three groups and five values: every run of ties crosses sort tasks."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return windows.ranked(rows, ["o_orderstatus"], "o_orderpriority", max_group=0)


def _outlier_sql(sd: str) -> str:
    return f"""SELECT event_id, event_type, value, round(group_mean, 6) AS group_mean,
                 round(group_sd, 6) AS group_sd
               FROM (SELECT event_id, event_type, value, avg(value) OVER w AS group_mean,
                       {sd}(value) OVER w AS group_sd FROM events WINDOW w AS (PARTITION BY event_type))
               WHERE value > group_mean + 3 * group_sd"""


@query(_outlier_sql("stddev_samp"))
def outliers_sample(t):
    found = windows.outliers(t.events, ["event_type"], "value", columns=["event_id"])
    return found.withColumns(rounded(6, "group_mean", "group_sd"))


@query(_outlier_sql("stddev_pop"))
def outliers_population(t):
    found = windows.outliers(t.events, ["event_type"], "value", columns=["event_id"], sd="pop")
    return found.withColumns(rounded(6, "group_mean", "group_sd"))


@query("""SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_order(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    newest = windows.latest_per_key(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return newest.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


@query("""SELECT l_suppkey, l_orderkey, l_partkey, l_extendedprice, row_number() OVER (
            PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey) AS rank
          FROM lineitem QUALIFY rank <= 5""")
def top_per_supplier(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_extendedprice")
    return windows.top_per_group(rows, ["l_suppkey"], 5, F.col("l_extendedprice").desc(),
                                 "l_orderkey", "l_partkey").withColumns(bigint("rank"))


@query("""SELECT o_orderkey, o_custkey FROM orders
          WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def newest_orders(t):
    return windows.latest_slice(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                                "o_orderdate").drop("o_orderdate")


@query("""SELECT row_number() OVER (ORDER BY count(*) DESC, o_custkey) - 1 AS id, o_custkey,
            count(*) AS n FROM orders GROUP BY o_custkey""")
def dense_ids_by_frequency(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return ordering.dense_ids(counts, F.col("n").desc(), "o_custkey").withColumns(bigint("id"))


@query("""SELECT CAST(p AS DOUBLE) AS probability, round(v, 4) AS value FROM (SELECT
            unnest([0.5, 0.95, 0.99]) AS p,
            unnest(quantile_cont(o_totalprice, [0.5, 0.95, 0.99])) AS v FROM orders)""")
def price_quantiles(t):
    return ordering.exact_quantiles(t.orders, "o_totalprice", [0.5, 0.95, 0.99]).withColumns(
        rounded(4, "value"))


@query("""WITH b AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 40 AS w
                     FROM events)
          SELECT CAST(least(floor((value - lo) / w), 39) AS BIGINT) AS bin,
                 round(lo + least(floor((value - lo) / w), 39) * w, 6) AS low,
                 round(lo + (least(floor((value - lo) / w), 39) + 1) * w, 6) AS high, count(*) AS n
          FROM events, b GROUP BY ALL""")
def value_histogram(t):
    return reports.histogram(t.events, "value").withColumns(
        {**bigint("bin"), **rounded(6, "low", "high")})


@query("""SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 2000""")
def recent_samples(t):
    return reports.recent(t.events.select("event_id", "user_id", "ts"), "ts", "event_id", k=2000).drop("ts")


@query("""SELECT count(*) AS samples, round(avg(CASE WHEN value > 200 THEN 1.0 ELSE 0.0 END), 6)
            AS share_over_budget FROM events""")
def share_over_budget(t):
    return reports.over_budget(t.events, "value", 200).withColumns(rounded(6, "share_over_budget"))


@query("""SELECT l_orderkey AS "key", 'line' AS kind, l_quantity AS amount FROM lineitem
          UNION ALL SELECT o_orderkey, 'order', o_totalprice FROM orders""")
def union_by_name(t):
    lines = t.lineitem.select(F.col("l_quantity").alias("amount"), F.col("l_orderkey").alias("key"),
                              F.lit("line").alias("kind"))
    orders = t.orders.select(F.col("o_orderkey").alias("key"), F.lit("order").alias("kind"),
                             F.col("o_totalprice").alias("amount"))
    return lines.unionByName(orders)


# --- sources and sinks -------------------------------------------------------------

@query(f"""SELECT carrier, avg(qty) AS avg_qty, count(*) AS n FROM {SHIPMENTS}
           GROUP BY carrier""")
def sql_over_view(t):
    readers.register(shipments(t), "shipments")
    return t.spark.sql("SELECT carrier, avg(qty) AS avg_qty, count(*) AS n FROM shipments "
                       "GROUP BY carrier")


@query("""SELECT o_orderkey, o_custkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
            AS o_orderdate, o_orderpriority FROM orders""")
def csv_scan(t):
    path = scratch_path(t.spark, "orders-csv")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice",
                           F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority")
    rows.write.option("header", True).csv(path)
    scanned = readers.read_csv(t.spark, path, "o_orderkey bigint, o_custkey bigint, "
                               "o_totalprice double, o_orderdate date, o_orderpriority string")
    return scanned.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("""SELECT doc_id, text, lang, CASE WHEN lang <> 'de' THEN n_chars END AS n_chars
          FROM documents""")
def quoted_csv_scan(t):
    path = scratch_path(t.spark, "documents-csv")
    chars = F.when(F.col("lang") == "de", "n/a").otherwise(F.col("n_chars").cast("string"))
    (t.documents.select("doc_id", "text", "lang", chars.alias("n_chars")).write
     .option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return readers.read_quoted_csv(t.spark, path, {"doc_id": "bigint", "text": "string",
                                                   "lang": "string", "n_chars": "bigint"})


@query("""SELECT o_orderkey, o_custkey, year(o_orderdate) AS "YEAR" FROM orders
          WHERE year(o_orderdate) = 1997""")
def partition_pruning(t):
    rows = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("YEAR"))
    table = studies.partitioned_copy(rows, scratch_path(t.spark, "orders-by-year"))
    return studies.pruned(table, "YEAR = 1997").withColumns(bigint("YEAR"))


@query("""SELECT DISTINCT w AS word FROM (SELECT unnest(string_split(lower(p_name), ' ')) AS w FROM part)
          WHERE w <> ''""")
def word_list(t):
    path = scratch_path(t.spark, "words")
    words = t.part.select(F.explode(F.split(F.upper("p_name"), " ")).alias("w"))
    words.select(F.concat(F.lit("  "), "w", F.lit("\t"))).union(
        t.region.select(F.lit(" "))).write.text(path)
    return readers.read_word_list(t.spark, path)


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def sink_read_back(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
    path = scratch_path(t.spark, "sink")
    rows.write.parquet(path)
    return readers.read_sink(t.spark, path, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint")


@query("""SELECT study, setting, count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows FROM
            (SELECT l_suppkey, l_returnflag, year(l_shipdate) AS y, count(*) AS n FROM lineitem GROUP BY ALL),
            (VALUES ('cache', 'cold'), ('cache', 'warm'), ('format', 'csv'), ('format', 'parquet'),
                    ('shuffle', '8'), ('shuffle', '50'), ('shuffle', '200'), ('shuffle', '400')) AS s(study, setting)
          GROUP BY ALL""")
def tuning_studies(t):
    """One question under cache, format and shuffle settings: every setting gives the same answer.

    The studies time the question; here each answer is stored once more, under the same setting, and counted.
    """
    path = scratch_path(t.spark, "study-csv")
    rows = shipments(t).select("carrier", "l_returnflag", "day", "qty").withColumn("YEAR", F.year("day"))
    rows.write.option("header", True).csv(path)
    text = readers.read_csv(t.spark, path, rows.schema)
    table = studies.partitioned_copy(rows, scratch_path(t.spark, "study-table"))

    def question(df: DataFrame) -> DataFrame:
        return aggregates.group_average(df, ["carrier", "l_returnflag", "YEAR"], "qty", out="avg_qty", drop_null=False)

    answers: list[tuple[str, str, DataFrame]] = []

    def kept(study: str, names: list[str]):
        """The question; each of its answers is also stored under the next name of the study, beside what is timed."""
        left = list(names)

        def ask(df: DataFrame) -> DataFrame:
            answers.append((study, left.pop(0), as_table(question(df), "study")))
            return question(df)
        return ask

    studies.cache_study(table, kept("cache", ["cold", "warm"]))
    studies.format_study(text, table, kept("format", ["csv", "parquet"]))
    studies.shuffle_study(table, kept("shuffle", [str(n) for n in studies.SWEEP]))
    counted = [answer.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).select(
        F.lit(study).alias("study"), F.lit(setting).alias("setting"), "groups", "rows")
        for study, setting, answer in answers]
    return reduce(DataFrame.unionByName, counted)
