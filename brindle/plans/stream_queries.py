"""Catalog: the event stream. Every query runs the stream over the whole events table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.dates import utc_instant, utc_text
from brindle.operators import als, reports
from brindle.plans.catalog import Tables, bigint, query, rounded
from brindle.session import scratch_path
from brindle.sources import readers, schemas
from brindle.streaming import app, ingest, sinks, windows
from brindle.streaming.trending import TrendingTable

# The test events are sparse, so windows are longer and thresholds lower than the defaults.
SIZE, SLIDE, LATENESS = "1 hour", "20 minutes", "10 minutes"
RULES = {"min_rating": 4.5, "min_item_count": 2, "min_user_count": 2}


def messages(t: Tables, *, stream: bool = True, reader=None) -> DataFrame:
    """The events table as raw messages: ratings 0 to 6, of which 1 to 5 are valid, and
    error events whose payload is not JSON."""
    schema = t.events.schema
    # A glob, so that the table may be one file or a directory of files.
    path = f"{t.folder}/event[s].parquet"
    reader = reader or (t.spark.readStream if stream else t.spark.read)
    events = reader.schema(schema).parquet(path)
    at = utc_instant("ts")
    rating = (F.floor("value") % 7).cast("double")
    body = F.to_json(F.struct(
        F.col("user_id"), F.get_json_object("props", "$.k").cast("int").alias("item_id"),
        rating.alias("rating"), at.alias("timestamp"), F.unix_millis(at).alias("event_time_ms"),
        F.concat(F.lit("u"), "user_id").alias("user_key")), ingest.JSON_OPTIONS)
    return events.select(F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(body)
                         .alias("value"), at.alias("timestamp"))


_GOOD = """(SELECT user_id, CAST(regexp_extract(props, '[0-9]+') AS INT) AS item_id, ts,
    CAST(floor(value) AS BIGINT) % 7 AS rating
  FROM events WHERE event_type <> 'error' AND CAST(floor(value) AS BIGINT) % 7 BETWEEN 1 AND 5)"""
# Sliding windows of one hour every 20 minutes; closed once the watermark has passed them.
_WINDOWED = f"""(SELECT *, ws + INTERVAL 1 HOUR AS we FROM (
    SELECT *, time_bucket(INTERVAL 20 MINUTE, ts) - back * INTERVAL 20 MINUTE AS ws
    FROM {_GOOD}, (VALUES (0), (1), (2)) AS b(back))
  WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) FROM {_GOOD}) - INTERVAL 10 MINUTE)"""
_ITEMS = f"""(SELECT ws, we, item_id, count(*) AS "count", avg(rating) AS avg_rating,
    count(*) * avg(rating) * exp(-((epoch(we) - floor(epoch(max(ts)))) / 60.0) / 5.0) AS trending_score
  FROM {_WINDOWED} GROUP BY ws, we, item_id)"""
_USERS = f"""(SELECT ws, we, user_id, count(*) AS "count" FROM {_WINDOWED} GROUP BY ws, we, user_id)"""
_BOUNDS = "strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(we, '%Y-%m-%d %H:%M:%S') AS window_end"


def _events(t: Tables, **kind) -> DataFrame:
    return ingest.good_events(ingest.parse_events(messages(t, **kind)), LATENESS)


def _items(t: Tables, **kind) -> DataFrame:
    return windows.item_windows(_events(t, **kind), SIZE, SLIDE)


def _users(t: Tables, **kind) -> DataFrame:
    return windows.user_windows(_events(t, **kind), SIZE, SLIDE)


def _through_sink(t: Tables, df: DataFrame, schema: str) -> DataFrame:
    """Run ``df`` into the Parquet sink until the input is used up; scan of the result."""
    out = scratch_path(t.spark, "stream")
    sinks.to_parquet(df, f"{out}/data", f"{out}/checkpoint", once=True).awaitTermination()
    return readers.read_sink(t.spark, f"{out}/data", schema)


def _through_callback(df: DataFrame, callback, out: str) -> None:
    sinks.for_each_batch(df, callback, f"{out}/checkpoint", once=True).awaitTermination()


def _text_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns({c: utc_text(c) for c in ("window_start", "window_end")})


@query(f"""SELECT {_BOUNDS}, CAST(item_id AS BIGINT) AS item_id, "count", avg_rating,
             round(trending_score, 6) AS trending_score FROM {_ITEMS}""")
def stream_item_windows(t):
    rows = _through_sink(t, _items(t), schemas.ITEM_WINDOWS)
    return _text_bounds(rows).withColumns({**bigint("item_id"), **rounded(6, "trending_score")})


@query(f"""SELECT {_BOUNDS}, user_id, "count" FROM {_USERS}""")
def stream_user_windows(t):
    return _text_bounds(_through_sink(t, _users(t), schemas.USER_WINDOWS)).withColumns(bigint("user_id"))


@query(f"""SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, user_id, count(*) AS "count"
           FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS ws FROM {_GOOD})
           WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) FROM {_GOOD}) - INTERVAL 10 MINUTE
           GROUP BY ws, user_id""")
def stream_tumbling_user_windows(t):
    rows = _through_sink(t, windows.user_windows(_events(t), SIZE, None), schemas.USER_WINDOWS)
    return _text_bounds(rows).drop("window_end").withColumns(bigint("user_id"))


@query(f"""SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, user_id, count(*) AS "count"
           FROM (SELECT user_id, time_bucket(INTERVAL 1 HOUR, ts) AS ws FROM events
                 WHERE event_type <> 'error' AND CAST(floor(value) AS BIGINT) % 7 BETWEEN 1 AND 5
                   AND NOT (event_id % 10 = 0 AND ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)))
           WHERE ws + INTERVAL 1 HOUR <= (SELECT max(ts) FROM {_GOOD}) - INTERVAL 10 MINUTE
           GROUP BY ws, user_id""")
def stream_late_events(t):
    """A tenth of the first half of the events comes after all others: too late for their windows."""
    cut = t.events.agg((F.unix_micros(F.min("ts").cast("timestamp")) + F.unix_micros(F.max("ts").cast("timestamp"))) / 2).first()[0]
    path, files = scratch_path(t.spark, "late"), 8
    early = F.unix_micros(F.col("ts").cast("timestamp")) < F.lit(cut)
    late = early & (F.col("event_id") % 10 == 0)
    newest = t.events.agg(F.max("ts")).scalar()
    copies = t.events.where(F.col("ts") == newest).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(8 * files)))).drop("n")
    # As many files each, so that every trigger takes one batch; the third lets the watermark catch up.
    for batch in (t.events.where(early & ~late), t.events.where(~early), copies, t.events.where(late)):
        batch.repartition(files).write.mode("append").parquet(f"{path}/events.parquet")
    marked = Tables(t.spark, path)
    reader = t.spark.readStream.option("maxFilesPerTrigger", files)
    raw = messages(marked, reader=reader)
    events = ingest.good_events(ingest.parse_events(raw), LATENESS)
    rows = _through_sink(t, windows.user_windows(events, SIZE, None), schemas.USER_WINDOWS)
    return _text_bounds(rows).drop("window_end").withColumns(bigint("user_id"))


@query(f"""SELECT 'trending_item' AS alert_type, CAST(item_id AS VARCHAR) AS subject, avg_rating AS metric,
             "count" AS magnitude, {_BOUNDS} FROM {_ITEMS} WHERE avg_rating > 4.5 AND "count" >= 2
           UNION ALL SELECT 'user_burst', CAST(user_id AS VARCHAR), CAST("count" AS DOUBLE), "count", {_BOUNDS}
           FROM {_USERS} WHERE "count" >= 2""")
def stream_alerts(t):
    events = _events(t)
    alerts = windows.alerts(windows.item_windows(events, SIZE, SLIDE),
                            windows.user_windows(events, SIZE, SLIDE), **RULES)
    return _text_bounds(_through_sink(t, alerts, schemas.ALERTS))


@query("""SELECT CASE WHEN event_type = 'error' THEN 'malformed' ELSE 'rating out of range' END AS reason,
            count(*) AS n FROM events
          WHERE event_type = 'error' OR CAST(floor(value) AS BIGINT) % 7 NOT BETWEEN 1 AND 5 GROUP BY 1""")
def stream_dead_letters(t):
    letters = ingest.dead_letters(ingest.parse_events(messages(t)))
    rows = _through_sink(t, letters, "payload string, kafka_ts timestamp, reason string")
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT user_id, item_id::BIGINT AS item_id, epoch_us(ts) // 1000 AS event_time_ms, epoch_us(ts) // 1000 AS ingest_ms, "
       f"TRUE AS consistent FROM {_GOOD}")
def stream_latency(t):
    """Wall-clock columns are reduced to whether they agree with each other."""
    out = scratch_path(t.spark, "latency")
    _through_callback(_events(t), sinks.latency_writer(f"{out}/data"), out)
    rows = readers.read_batches(t.spark, f"{out}/data", schemas.LATENCY)
    consistent = (F.col("latency_ms") == F.col("process_ms") - F.col("event_time_ms")) & (F.col("latency_ms") > 0)
    return rows.select("user_id", "item_id", "event_time_ms", "ingest_ms",
                       consistent.alias("consistent")).withColumns(bigint("user_id", "item_id"))


@query(f"""SELECT CAST(item_id AS BIGINT) AS item_id, round(max(trending_score), 6) AS score
           FROM {_ITEMS} GROUP BY item_id""")
def stream_trending_table(t):
    out = scratch_path(t.spark, "trending")
    table = TrendingTable(t.spark, f"{out}/table")
    _through_callback(_items(t), table.update, out)
    return table.scores().withColumns({**bigint("item_id"), **rounded(6, "score")})


@query(f"""SELECT CAST(user_id % 3 AS VARCHAR) AS "key", count(*) AS n, CAST(sum(rating) AS DOUBLE) AS ratings
           FROM {_GOOD} GROUP BY 1""")
def event_messages_by_key(t):
    """Message form of events: key, and JSON that parses back."""
    sent = ingest.event_messages(_events(t, stream=False).select("user_id", "item_id", "rating"))
    rating = F.get_json_object("value", "$.rating").cast("double")
    return sent.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(rating).alias("ratings"))


@query("""SELECT l_partkey AS item_id, round(max(l_extendedprice), 2) AS score FROM lineitem GROUP BY l_partkey""")
def trending_many_items(t):
    """A table of all parts, updated by two batches; every item stays."""
    path = scratch_path(t.spark, "trending")
    table = TrendingTable(t.spark, path)
    rows = t.lineitem.select(F.col("l_partkey").cast("int").alias("item_id"),
                             F.col("l_extendedprice").alias("trending_score"),
                             F.col("l_shipdate").cast("timestamp").alias("window_end"))
    table.update(rows.where("item_id % 2 = 0"), 0)
    table.update(rows.where("item_id % 2 = 1"), 1)
    return table.scores().withColumns({**bigint("item_id"), **rounded(2, "score")})


def _given_model(t: Tables):
    """Factors from the embeddings: users and items are both numbered by vector."""
    factors = t.embeddings.select(F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features"))
    return als.model_from_factors(factors, factors, 64)


_TRENDING_NOW = f"(SELECT item_id, max(trending_score) AS raw FROM {_ITEMS} GROUP BY item_id)"
# A tie between equal scores may go either way in single precision, so ranks are compared by score.
_RECOMMENDED = f"""(WITH dot AS (SELECT u.vec_id AS user_id, i.vec_id AS item_id,
      list_dot_product(CAST(u.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score
    FROM (SELECT DISTINCT user_id FROM {_GOOD}) g JOIN embeddings u ON u.vec_id = g.user_id, embeddings i),
  pool AS (SELECT * FROM dot QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) <= 20),
  a AS (SELECT user_id, item_id, (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) AS a
        FROM pool WINDOW w AS (PARTITION BY user_id)),
  t AS (SELECT item_id, raw, (raw - min(raw) OVER ()) / (max(raw) OVER () - min(raw) OVER ()) AS t FROM {_TRENDING_NOW}),
  pairs AS (SELECT user_id, item_id FROM a UNION
            SELECT user_id, item_id FROM (SELECT DISTINCT user_id FROM a), t),
  blend AS (SELECT user_id, item_id, 0.7::DOUBLE * coalesce(a, 0) + 0.3::DOUBLE * coalesce(t, 0) AS score
            FROM pairs LEFT JOIN a USING (user_id, item_id) LEFT JOIN t USING (item_id)
            UNION ALL SELECT user_id, item_id, raw FROM (SELECT DISTINCT user_id FROM {_GOOD}
              WHERE user_id NOT IN (SELECT vec_id FROM embeddings)), t)
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank, score
  FROM blend QUALIFY rank <= 5)"""


@query(f"SELECT user_id, rank, round(score, 3) AS score FROM {_RECOMMENDED}")
def stream_recommendations(t):
    """Hybrid top 5 from given factors and the stream's trending table, for the users of the stream."""
    out = scratch_path(t.spark, "recs")
    table = TrendingTable(t.spark, f"{out}/trending")
    _through_callback(_items(t), table.update, f"{out}/t")
    _through_callback(_events(t), sinks.recommendation_writer(f"{out}/recs", _given_model(t), table), f"{out}/r")
    found = readers.read_batches(t.spark, f"{out}/recs", schemas.RECOMMENDATIONS)
    return found.select("user_id", "rank", F.round("score", 3).alias("score"))


@query(f"""SELECT 'windows/items' AS sink, count(*) AS rows FROM {_ITEMS}
           UNION ALL SELECT 'windows/users', count(*) FROM {_USERS}
           UNION ALL SELECT 'alerts', (SELECT count(*) FROM {_ITEMS} WHERE avg_rating > 4.5 AND "count" >= 2)
             + (SELECT count(*) FROM {_USERS} WHERE "count" >= 2)
           UNION ALL SELECT 'latency', count(*) FROM {_GOOD}
           UNION ALL SELECT 'dead_letters', (SELECT count(*) FROM events) - count(*) FROM {_GOOD}
           UNION ALL SELECT 'trending', count(DISTINCT item_id) FROM {_ITEMS}
           UNION ALL SELECT 'recs for known users', 5 * count(DISTINCT user_id) FROM {_GOOD}
             WHERE user_id IN (SELECT vec_id FROM embeddings)""")
def stream_all_sinks(t):
    """All queries of the full stream at once, each with its own checkpoint.

    Recommendations run beside the trending table they read, so an unknown user's depend on how
    far it is; known users always get five.
    """
    out = scratch_path(t.spark, "app")
    running = app.start(messages(t), out, _given_model(t), size=SIZE, slide=SLIDE, watermark=LATENESS, once=True, **RULES)
    for started in running.values():
        started.awaitTermination()
    sinks_read = {"windows/items": schemas.ITEM_WINDOWS, "windows/users": schemas.USER_WINDOWS,
                  "alerts": schemas.ALERTS, "latency": schemas.LATENCY}
    counted = [readers.read_batches(t.spark, f"{out}/{name}", schema).select(F.lit(name).alias("sink"))
               for name, schema in sinks_read.items()]
    counted.append(readers.read_sink(t.spark, f"{out}/dead_letters", "payload string, kafka_ts timestamp, reason string")
                   .select(F.lit("dead_letters").alias("sink")))
    recs = readers.read_batches(t.spark, f"{out}/recs", schemas.RECOMMENDATIONS)
    known = t.embeddings.select(F.col("vec_id").alias("user_id"))
    counted.append(recs.join(known, "user_id", "left_semi").select(F.lit("recs for known users").alias("sink")))
    counted.append(TrendingTable(t.spark, f"{out}/trending").scores().select(F.lit("trending").alias("sink")))
    return reduce(DataFrame.unionByName, counted).groupBy("sink").agg(F.count(F.lit(1)).alias("rows"))


# --- reports over the stream's output (window functions run on the batch table) -------

@query(f"""SELECT CAST(item_id AS BIGINT) AS item_id, "count", round(trending_score, 6) AS trending_score
           FROM {_ITEMS} WHERE we = (SELECT max(we) FROM {_ITEMS})
           ORDER BY _ITEMS_ORDER LIMIT 10""".replace("_ITEMS_ORDER", "round(trending_score, 6) DESC, item_id"))
def trending_now(t):
    rows = _through_sink(t, _items(t), schemas.ITEM_WINDOWS).withColumns(rounded(6, "trending_score"))
    return reports.trending_now(rows).select("item_id", "count", "trending_score").withColumns(
        bigint("item_id"))


_ALL_USERS = f"""(SELECT ws, user_id, count(*) AS "count" FROM (
    SELECT *, time_bucket(INTERVAL 20 MINUTE, ts) - back * INTERVAL 20 MINUTE AS ws
    FROM {_GOOD}, (VALUES (0), (1), (2)) AS b(back)) GROUP BY ws, user_id)"""


@query(f"""SELECT user_id, CAST(sum("count") AS BIGINT) AS total FROM {_ALL_USERS} GROUP BY user_id
           ORDER BY total DESC, user_id LIMIT 15""")
def busiest_users(t):
    return reports.busiest(_users(t, stream=False)).withColumns(bigint("user_id"))


@query(f"SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_user_id FROM {_ALL_USERS}")
def active_users(t):
    return reports.activity(_users(t, stream=False), "user_id")


@query(f"SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_user_id FROM {_USERS}")
def active_users_sketched(t):
    """Counts over the closed windows, read from the bitmaps of the batches alone, which are exact for any number of users."""
    out = scratch_path(t.spark, "activity")
    _through_callback(_users(t), sinks.window_writer(
        f"{out}/windows", f"{out}/alerts", lambda users: windows.user_alerts(users, RULES["min_user_count"]),
        bitmaps=(f"{out}/activity", "user_id")), out)
    stored = readers.read_batches(t.spark, f"{out}/activity", schemas.USER_BITMAPS)
    return reports.merged_bitmaps(stored, "user_id")


_ALL_ITEMS = f"""(SELECT ws, item_id, count(*) AS "count", avg(rating) AS avg_rating FROM (
    SELECT *, time_bucket(INTERVAL 20 MINUTE, ts) - back * INTERVAL 20 MINUTE AS ws
    FROM {_GOOD}, (VALUES (0), (1), (2)) AS b(back)) GROUP BY ws, item_id)"""


@query(f"""SELECT * FROM (
             SELECT 'user_burst' AS alert_type, CAST(user_id AS VARCHAR) AS subject,
               CAST("count" AS DOUBLE) AS metric, "count" AS magnitude,
               strftime(ws + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end
             FROM {_ALL_USERS} WHERE "count" >= 2
             UNION ALL SELECT 'trending_item', CAST(item_id AS VARCHAR), avg_rating, "count",
               strftime(ws + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S')
             FROM {_ALL_ITEMS} WHERE avg_rating > 4.5 AND "count" >= 2)
           ORDER BY window_end DESC, alert_type, subject LIMIT 20""")
def newest_alerts(t):
    alerts = windows.alerts(_items(t, stream=False), _users(t, stream=False), **RULES)
    return reports.newest_alerts(alerts).drop("window_start").withColumn("window_end", utc_text("window_end"))


@query("""SELECT CAST(p AS DOUBLE) AS probability, round(v, 4) AS value,
            (SELECT count(*) FROM events WHERE round(value * 1000) NOT BETWEEN 0 AND 600000) AS left_out FROM (SELECT
            unnest([0.5, 0.95, 0.99]) AS p, unnest(quantile_cont(lag, [0.5, 0.95, 0.99])) AS v FROM
            (SELECT CAST(round(value * 1000) AS BIGINT) AS lag FROM events) WHERE lag BETWEEN 0 AND 600000)""")
def latency_quantiles(t):
    lags = t.events.select(F.round(F.col("value") * 1000).cast("bigint").alias("latency_ms"))
    return reports.latency_quantiles(lags).withColumns(rounded(4, "value"))
