"""Streaming: parsing, watermark, windows, alerts, sinks, trending table, full run."""

import json
import math
import os
from datetime import datetime, timedelta, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from brindle.operators import als, reports
from brindle.operators.factor_table import FactorTable
from brindle.session import finished_batches, folders, scratch_path, shared_dir
from brindle.plans import catalog, stream_queries  # noqa: F401
from brindle.plans.studies import physical_plan
from brindle.sources import readers, schemas
from brindle.streaming import app, ingest, sinks, windows
from brindle.streaming.trending import TrendingTable

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def event(seconds, user=1, item=1, rating=5.0, **extra):
    at = START + timedelta(seconds=seconds)
    return json.dumps({"user_id": user, "item_id": item, "rating": rating, "timestamp": at.isoformat(),
                       "event_time_ms": int(at.timestamp() * 1000), "user_key": f"u{user}", "item_key": f"i{item}",
                       **extra})


def raw(spark, values):
    return spark.createDataFrame([(v, START) for v in values], "value string, timestamp timestamp")


@pytest.fixture
def feed(spark, tmp_path):
    """A directory source; every list of messages becomes one file and one micro-batch."""
    def write(*batches):
        for i, batch in enumerate(batches):
            (tmp_path / f"{i:03d}.json").write_text("\n".join(batch) + "\n")
            os.utime(tmp_path / f"{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
        return ingest.text_source(spark, str(tmp_path), maxFilesPerTrigger=1)
    return write


def test_payload_cases(spark):
    bad = [None, "not json", "{}", '{"user_id":"x","rating":3}', event(0, rating=0.5), event(0, rating=5.5)]
    parsed = ingest.parse_events(raw(spark, [*bad, event(1)]))
    flags = [r["malformed"] for r in parsed.collect()]
    assert flags == [True, True, False, True, False, False, False]
    good = ingest.good_events(parsed).collect()
    assert len(good) == 1 and good[0]["user_key"] == "u1" and good[0]["kafka_ts"] is not None
    reasons = sorted(r["reason"] for r in ingest.dead_letters(parsed).collect())
    assert reasons == ["malformed"] * 3 + ["missing id"] + ["rating out of range"] * 2


def test_item_window_score(spark):
    events = ingest.good_events(ingest.parse_events(raw(spark, [event(3, rating=4.0), event(12, rating=5.0)])))
    out = {r["window_start"]: r for r in windows.item_windows(events, "30 seconds", "30 seconds").collect()}
    (row,) = out.values()
    assert row["count"] == 2 and row["avg_rating"] == 4.5
    assert row["trending_score"] == pytest.approx(2 * 4.5 * math.exp(-(18 / 60) / 5))
    sliding = windows.item_windows(events)  # 30 s every 10 s
    assert sliding.agg(F.sum("count")).first()[0] == 6


def test_alerts(spark):
    burst = [event(i / 10, user=7, item=i % 3, rating=5.0) for i in range(60)]
    events = ingest.good_events(ingest.parse_events(raw(spark, burst)))
    items, users = windows.item_windows(events, "30 seconds", None), windows.user_windows(events, "30 seconds", None)
    got = sorted((r["alert_type"], r["subject"], r["metric"], r["magnitude"])
                 for r in windows.alerts(items, users).collect())
    assert got == [("trending_item", str(i), 5.0, 20) for i in range(3)] + [("user_burst", "7", 60.0, 60)]
    assert windows.alerts(items, users, min_item_count=21, min_user_count=61).count() == 0


def test_late_events(spark, feed):
    """The late filter uses the watermark of the batch before."""
    source = feed([event(0), event(600)], [event(10)], [event(20)], [event(1200)])
    events = ingest.good_events(ingest.parse_events(source), "1 minute")
    out = scratch_path(spark, "late")
    sinks.to_parquet(windows.user_windows(events, "30 seconds", None), f"{out}/d", f"{out}/c",
                     once=True).awaitTermination()
    got = {r["window_start"].second + 60 * r["window_start"].minute: r["count"]
           for r in readers.read_sink(spark, f"{out}/d", "window_start timestamp, window_end timestamp, "
                                      "user_id int, count bigint").collect()}
    # 0 s and 10 s share a window (10 s came in time), 20 s is dropped, 1200 s is still open.
    assert got == {0: 2, 600: 1}


def test_latency_batches_replace_themselves(spark):
    events = ingest.good_events(ingest.parse_events(raw(spark, [event(0), event(1)])))
    path = scratch_path(spark, "latency")
    write = sinks.latency_writer(path)
    write(events, 0), write(events, 1), write(events, 1)
    rows = spark.read.parquet(path)
    assert rows.count() == 4
    assert rows.where("latency_ms != process_ms - event_time_ms or ingest_ms is null").count() == 0
    assert rows.where("batch_id = 1").select("process_ms").distinct().count() == 1


def window_rows(spark, values):
    return spark.createDataFrame([(i, float(s), START) for i, s in values],
                                 "item_id int, trending_score double, window_end timestamp")


def state(table):
    return {r["item_id"]: r["score"] for r in table.scores().collect()}


def test_trending_table_updates_and_replays(spark):
    table = TrendingTable(spark, scratch_path(spark, "trend"))
    assert state(table) == {}
    table.update(window_rows(spark, [(1, 5), (1, 9), (2, 4)]), 0)
    table.update(window_rows(spark, [(1, 3)]), 1)
    assert state(table) == {1: 3.0, 2: 4.0}  # the newest batch wins, even if lower
    table.update(window_rows(spark, [(1, 3)]), 1)  # replay
    assert state(table) == {1: 3.0, 2: 4.0}
    for batch in range(2, 9):
        table.update(window_rows(spark, [(batch, batch)]), batch)
    assert state(table) == {1: 3.0, 2: 4.0, **{b: float(b) for b in range(3, 9)}} | {2: 2.0}
    table.update(window_rows(spark, []), 9)
    assert len(state(table)) == 8
    restarted = TrendingTable(spark, table.path)
    assert state(restarted) == state(table)


def test_trending_table_keeps_every_item_or_expires_by_age(spark):
    table = TrendingTable(spark, scratch_path(spark, "trend"))
    for batch in range(3):
        rows = spark.range(batch * 4000, (batch + 1) * 4000).selectExpr(
            "cast(id as int) as item_id", "cast(id as double) as trending_score", "timestamp'2024-01-01' as window_end")
        table.update(rows, batch)
    assert table.scores().count() == 12_000
    aging = TrendingTable(spark, scratch_path(spark, "trend"), expire_after=60)
    aging.update(window_rows(spark, [(1, 1)]), 0)
    later = window_rows(spark, [(2, 2)]).withColumn("window_end", F.col("window_end") + F.expr("interval 2 minutes"))
    aging.update(later, 1)
    assert state(aging) == {2: 2.0}


def test_trending_readers_survive_updates(spark):
    table = TrendingTable(spark, scratch_path(spark, "trend"))
    table.update(window_rows(spark, [(1, 1)]), 0)
    held = table.scores()
    for batch in range(1, 6):
        table.update(window_rows(spark, [(1, batch), (batch + 1, 1)]), batch)
    assert [tuple(r) for r in held.collect()] == [(1, 1.0)]
    assert state(table)[1] == 5.0
    before = state(table)
    short = TrendingTable(spark, table.path, keep_seconds=-1, compact_after=3)
    short.update(window_rows(spark, []), 6)
    assert sorted(finished_batches(spark, f"{table.path}/base")) == [6]
    assert not finished_batches(spark, f"{table.path}/delta") and state(short) == before


def test_trending_batches_write_what_they_hold(spark):
    """A batch of one item writes one row, however large the table is; bases come now and then."""
    table = TrendingTable(spark, scratch_path(spark, "trend"), compact_after=4)
    many = spark.range(20_000).selectExpr("cast(id as int) as item_id", "cast(id as double) as trending_score",
                                          "timestamp'2024-01-01' as window_end")
    table.update(many, 0)
    for batch in range(1, 10):
        table.update(window_rows(spark, [(7, batch)]), batch)
        assert spark.read.parquet(f"{table.path}/delta/batch_id={batch}").count() == 1
        assert state(table)[7] == batch and table.scores().count() == 20_000
    assert sorted(finished_batches(spark, f"{table.path}/base")) == [3, 7]
    files = spark.read.parquet(f"{table.path}/delta/batch_id=9").inputFiles()
    table.update(window_rows(spark, [(7, 9)]), 9)  # a replay finds its delta and leaves it
    assert spark.read.parquet(f"{table.path}/delta/batch_id=9").inputFiles() == files
    table.update(window_rows(spark, [(7, 5)]), 5)  # one that a base holds already
    assert state(table)[7] == 9.0


def test_an_unfinished_base_is_not_read(spark):
    table = TrendingTable(spark, scratch_path(spark, "trend"))
    table.update(window_rows(spark, [(1, 1)]), 0)
    table.update(window_rows(spark, [(2, 2)]), 1)
    spark.range(1).selectExpr("9 as item_id", "9.0D as score", "timestamp'2024-01-01' as window_end").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{table.path}/base/batch_id=1")
    assert state(table) == {1: 1.0, 2: 2.0}
    table.compact()
    assert finished_batches(spark, f"{table.path}/base") and state(table) == {1: 1.0, 2: 2.0}


@pytest.mark.parametrize("size,slide", [("30 seconds", "10 seconds"), ("25 seconds", "10 seconds"), ("1 minute", None)])
def test_windows_of_panes_equal_direct_windows(spark, size, slide):
    """Also where the slide does not divide the size; null ratings count as events, not as ratings."""
    rows = spark.range(3000).selectExpr(
        "timestamp_seconds(1700000000 + cast(id * 7919 % 900 as int)) as event_time", "cast(id % 5 as int) as item_id",
        "if(id % 11 = 0, null, cast(id % 6 as double)) as rating")
    window = F.window("event_time", size, slide) if slide else F.window("event_time", size)
    want = rows.groupBy(window.alias("w"), "item_id").agg(F.count(F.lit(1)).alias("count"), F.avg("rating").alias("avg"))
    want = {(r.w.start, r.w.end, r.item_id): (r["count"], r.avg) for r in want.collect()}
    got = windows.item_windows(rows, size, slide).collect()
    assert {(r.window_start, r.window_end, r.item_id): (r["count"], r.avg_rating) for r in got} == want


def test_panes_keep_less_state(spark):
    """Rows updated in the state: one per event and pane, not one for each of an event's three windows."""
    events = spark.range(2000).selectExpr("timestamp_seconds(1700000000 + id) as event_time", "cast(id as int) as item_id",
                                          "1.0D as rating")
    path = scratch_path(spark, "panes")
    events.repartition(2).write.parquet(f"{path}/in")

    def updated(build, name):
        stream = spark.readStream.schema(events.schema).parquet(f"{path}/in").withWatermark("event_time", "10 seconds")
        run = build(stream).writeStream.format("parquet").option("checkpointLocation", f"{path}/c-{name}").trigger(
            availableNow=True).start(f"{path}/{name}")
        run.awaitTermination()
        progress = [p["stateOperators"] for p in map(json.loads, (x.json for x in run.recentProgress))]
        return progress, spark.read.parquet(f"{path}/{name}")

    paned, got = updated(lambda s: windows.user_windows(s.withColumnRenamed("item_id", "user_id")), "paned")
    direct, want = updated(lambda s: s.groupBy(F.window("event_time", "30 seconds", "10 seconds"), "item_id").count().select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        F.col("item_id").alias("user_id"), "count"), "direct")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    at_events = max(op[-1]["numRowsUpdated"] for op in paned)  # operators are listed from the sink to the source
    assert len(paned[0]) == 2 and 3 * at_events == max(op[0]["numRowsUpdated"] for op in direct)


def test_empty_batches_write_nothing(spark):
    empty = ingest.good_events(ingest.parse_events(raw(spark, ["junk"])))
    out = scratch_path(spark, "empty")
    sinks.latency_writer(f"{out}/l")(empty, 0)
    factors = spark.createDataFrame([(1, [1.0])], "id int, features array<float>")
    model = als.model_from_factors(factors, factors, 1)
    sinks.recommendation_writer(f"{out}/r", model, TrendingTable(spark, f"{out}/t"))(empty, 0)
    sinks.window_writer(f"{out}/w", f"{out}/a", windows.item_alerts)(windows.item_windows(empty), 0)
    assert not any(finished_batches(spark, f"{out}/{name}") for name in "lrwa")
    assert readers.read_batches(spark, f"{out}/l", "user_id int, batch_id bigint").columns == ["user_id", "batch_id"]


def test_recommendation_batches_leave_no_scratch(spark):
    factors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "id int, features array<float>")
    model = als.model_from_factors(factors, factors, 2)
    out = scratch_path(spark, "clean")
    table = TrendingTable(spark, f"{out}/t")
    table.update(window_rows(spark, [(i, i) for i in range(6)]), 0)
    batch = ingest.good_events(ingest.parse_events(raw(spark, [event(0, user=1), event(1, user=99)])))
    seen = spark.createDataFrame([(1, 5)], "user_id int, item_id int")
    write = sinks.recommendation_writer(f"{out}/r", model, table, k=1, exclude=seen)
    before = folders(spark, f"{shared_dir(spark)}/brindle", "*")
    for number in range(3):
        write(batch, number)
    assert folders(spark, f"{shared_dir(spark)}/brindle", "*") == before
    assert readers.read_batches(spark, f"{out}/r", "user_id bigint").count() == 6


def test_recommendations_from_a_saved_factor_table(spark, rows):
    """The same rows as from all factors of the model; the batch's folders are read in place of the model's factors."""
    factors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(200)], "id int, features array<float>")
    model = als.model_from_factors(factors, factors, 2)
    table = FactorTable.write(factors, scratch_path(spark, "f"), buckets=20)
    trending = spark.createDataFrame([(3, 2.0), (199, 1.0)], "item_id int, score double")
    users = spark.createDataFrame([(5,), (5,), (150,), (900,)], "user_id int")
    blocks = als.item_blocks(model)
    got = sinks.recommend(users, model, trending, 3, blocks=blocks, user_factors=table)
    assert rows(got) == rows(sinks.recommend(users, model, trending, 3, blocks=blocks))
    assert got.where("user_id = 900").count() == 2


def test_kafka_options_and_messages(spark):
    options = ingest.kafka_source_options("host:9092")
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "interactions",
                       "startingOffsets": "latest", "failOnDataLoss": "true"}
    bounded = ingest.kafka_source_options("h", max_offsets=500, tolerate_loss=True)
    assert (bounded["maxOffsetsPerTrigger"], bounded["failOnDataLoss"]) == ("500", "false")
    df = spark.createDataFrame([(7, 2.5)], "user_id int, score double")
    row = ingest.message(df, ["score"], "user_id").first()
    assert (row["key"], json.loads(row["value"])) == ("7", {"score": 2.5})
    assert ingest.message(df).first()["key"] is None
    assert ingest.event_messages(df).first()["key"] == "1"


def test_text_source_and_console(spark, feed):
    events = ingest.good_events(ingest.parse_events(feed([event(0), "junk"], [event(5)])))
    query = sinks.to_console(events.select("user_id"), "print", scratch_path(spark, "c"), once=True)
    query.awaitTermination()
    assert query.name == "print" and "Console" in query.lastProgress.sink.description


def test_full_run(spark, feed):
    factors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "id int, features array<float>")
    model = als.model_from_factors(factors, factors, 2)
    quiet = [event(i, user=i % 4, item=i % 6, rating=5.0) for i in range(24)]
    later = [event(400, user=3, item=2), event(401, user=99, item=2), "oops"]
    out = scratch_path(spark, "app")
    source = feed(quiet, later, [event(800, user=99)])
    running = app.start(source, out, None, once=True, min_item_count=2, min_user_count=4)
    for query in running.values():
        query.awaitTermination()
    assert set(running) == {"items", "users", "dead_letters", "latency"}
    assert spark.read.parquet(f"{out}/latency").count() == 27
    assert spark.read.parquet(f"{out}/dead_letters").count() == 1
    kinds = {r[0] for r in spark.read.parquet(f"{out}/alerts").select("alert_type").distinct().collect()}
    assert kinds == {"trending_item", "user_burst"}
    # Recommendations on top of the trending table the first run left behind.
    table = TrendingTable(spark, f"{out}/trending")
    assert table.scores().count() == 6
    published = []
    events = ingest.good_events(ingest.parse_events(source))
    writer = sinks.recommendation_writer(f"{out}/recs", model, table, k=2, publish=lambda df: published.append(df.count()))
    sinks.for_each_batch(events, writer, f"{out}/checkpoints/recs", once=True).awaitTermination()
    recs = spark.read.parquet(f"{out}/recs")
    per_user = recs.groupBy("batch_id", "user_id").count()
    assert per_user.where("count != 2").count() == 0
    assert sorted(published) == [2, 4, 8]
    stranger = recs.where("user_id = 99 and batch_id = 1 and rank = 1").first()
    best = table.scores().orderBy(F.col("score").desc(), "item_id").first()
    assert (stranger["item_id"], stranger["score"]) == (best["item_id"], best["score"])


def test_stream_equals_closed_batch_windows(spark, feed):
    batches = [[event(60 * b + s, user=s % 5, item=s % 3) for s in range(0, 60, 2)] for b in range(4)]
    events = ingest.good_events(ingest.parse_events(feed(*batches)), "1 minute")
    out = scratch_path(spark, "closed")
    sinks.to_parquet(windows.item_windows(events), f"{out}/d", f"{out}/c", once=True).awaitTermination()
    flat = ingest.good_events(ingest.parse_events(raw(spark, [m for b in batches for m in b])))
    closed = windows.item_windows(flat).where(
        F.col("window_end") <= F.lit(START + timedelta(seconds=238)) - F.expr("interval 1 minute"))
    got = spark.read.parquet(f"{out}/d")
    assert got.count() == closed.count() > 0
    assert got.select(*closed.columns).exceptAll(closed).count() == 0


def test_restart_continues_without_duplicates(spark, tmp_path):
    source, out = tmp_path / "in", scratch_path(spark, "restart")
    source.mkdir()

    def run():
        raw_messages = ingest.text_source(spark, str(source))
        for query in app.start(raw_messages, out, once=True, min_user_count=2).values():
            query.awaitTermination()

    (source / "a.json").write_text("\n".join(event(i, user=i % 3, item=i % 2) for i in range(0, 200, 5)))
    run()
    first = spark.read.parquet(f"{out}/windows/items").count()
    (source / "b.json").write_text("\n".join(event(i, user=i % 3, item=i % 2) for i in range(200, 400, 5)))
    run()
    items = spark.read.parquet(f"{out}/windows/items")
    assert items.count() > first > 0
    assert items.groupBy("window_start", "item_id").count().where("count > 1").count() == 0
    assert spark.read.parquet(f"{out}/latency").count() == 80
    alerts = spark.read.parquet(f"{out}/alerts")
    assert alerts.groupBy("subject", "window_start").count().where("count > 1").count() == 0 < alerts.count()


def test_window_writer_replay(spark):
    items = windows.item_windows(ingest.good_events(ingest.parse_events(raw(spark, [event(1), event(2)]))))
    out, seen = scratch_path(spark, "w"), []
    table = TrendingTable(spark, f"{out}/trending")
    write = sinks.window_writer(f"{out}/items", f"{out}/alerts", lambda df: windows.item_alerts(df, 4.0, 2),
                                update=table.update, publish=lambda df: seen.append(df.count()))
    write(items, 3), write(items, 3)
    assert spark.read.parquet(f"{out}/items").count() == items.count() == 3
    assert spark.read.parquet(f"{out}/alerts").count() == 3 and seen == [3, 3]
    assert table.scores().count() == 1


def test_activity_sketches_estimate_within_their_error(spark):
    """60,000 users over windows that overlap: merged sketches are within three standard errors of the exact counts."""
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5 * 60)
    closed = spark.range(150_000).select(start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
                                         F.when(F.col("id") % 10 != 0, F.col("id") * 7 % 60_000).cast("int").alias("user_id"),
                                         F.lit(1).cast("long").alias("count"))
    kept = reports.activity_sketches(closed, "user_id")
    assert kept.count() == 5
    last = closed.agg(F.max("window_end")).scalar()
    for found, exact in ((reports.merged_activity(kept, "user_id"), reports.activity(closed, "user_id")),
                         (reports.merged_activity(kept, "user_id", since=last), reports.activity(closed.where(F.col("window_end") == last), "user_id"))):
        found, exact = found.first(), exact.first()
        assert found["rows"] == exact["rows"]
        assert abs(found["distinct_user_id"] / exact["distinct_user_id"] - 1) < 3 * 1.04 / 2 ** (reports.LG_K / 2)
    nothing = reports.merged_activity(kept.where("false"), "user_id").first()
    assert tuple(nothing) == (0, 0)
    nulls = reports.activity_sketches(closed.withColumn("user_id", F.lit(None).cast("int")), "user_id")
    assert tuple(reports.merged_activity(nulls, "user_id").first()) == (150_000, 0)


def test_reports_read_sketches_only(spark):
    """Replayed batches replace their sketches, and the report scans nothing but these."""
    out = scratch_path(spark, "activity")
    write = sinks.window_writer(f"{out}/w", f"{out}/a", windows.user_alerts, sketches=(f"{out}/s", ["user_id"]))
    for number, users in enumerate(([1, 2, 2], [2, 3])):
        found = windows.user_windows(ingest.good_events(ingest.parse_events(raw(spark, [event(0, user=u) for u in users]))))
        write(found, number), write(found, number)
    report = reports.merged_activity(readers.read_batches(spark, f"{out}/s", schemas.USER_ACTIVITY), "user_id")
    assert tuple(report.first()) == (12, 3)  # two users and two users, in three windows each
    assert f"{out}/w" not in physical_plan(report)


def test_activity_bitmaps_are_exact(spark):
    """Counts of 60,000 users, negative ids and nulls among them, equal those over the windows, in all and since a time."""
    start = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5 * 60)
    closed = spark.range(150_000).select(start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
                                         F.when(F.col("id") % 10 != 0, F.col("id") * 7 % 60_000 - 100).cast("int").alias("user_id"),
                                         F.lit(1).cast("long").alias("count"))
    out = scratch_path(spark, "activity")
    write = sinks.window_writer(f"{out}/w", f"{out}/a", windows.user_alerts, bitmaps=(f"{out}/b", "user_id"))
    for number in (0, 1):
        half = closed.where(F.col("user_id").isNull() if number else F.col("user_id").isNotNull())
        write(half, number), write(half, number)
    kept = readers.read_batches(spark, f"{out}/b", schemas.USER_BITMAPS)
    last = closed.agg(F.max("window_end")).scalar()
    for found, exact in ((reports.merged_bitmaps(kept, "user_id"), reports.activity(closed, "user_id")),
                         (reports.merged_bitmaps(kept, "user_id", since=last), reports.activity(closed.where(F.col("window_end") == last), "user_id"))):
        assert tuple(found.first()) == tuple(exact.first())
        assert f"{out}/w" not in physical_plan(found)
    assert tuple(reports.merged_bitmaps(kept.where("false"), "user_id").first()) == (0, 0)


def test_active_users_are_exact_beyond_a_sketch(spark):
    """30,000 users, at which the estimate of a sketch was off."""
    folder = scratch_path(spark, "tables")
    spark.range(30_000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.lit(3.0).alias("value"),
        F.lit('{"k": 1}').alias("props")).write.parquet(f"{folder}/events.parquet")
    found = catalog.QUERIES["active_users_sketched"](spark, folder).first()
    files = f"'{folder.removeprefix('file:')}/events.parquet/*.parquet'"
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW events AS SELECT * FROM {files}")
        assert (found["rows"], found["distinct_user_id"]) == duck.execute(catalog.ORACLE["active_users_sketched"]).fetchone()
    assert found["distinct_user_id"] > 20_000


def test_message_keys_name_a_row_for_good(spark):
    df = spark.createDataFrame([(7, 3, 1), (7, 3, 2), (None, 3, 1)], "user_id int, batch_id long, rank long")
    assert [r["key"] for r in ingest.message(df, key=ingest.identity("user_id", "batch_id", "rank")).collect()] == ["7/3/1", "7/3/2", "/3/1"]
    alerts = windows.user_alerts(windows.user_windows(ingest.good_events(ingest.parse_events(raw(spark, [event(0)])))), 1)
    keys = [r["key"] for r in ingest.message(alerts, key=ingest.identity("alert_type", "subject", "window_end")).collect()]
    assert len(set(keys)) == len(keys) == 3 and all(k.startswith("user_burst/1/1704067") for k in keys)


def test_state_partitions_leave_the_session_alone(spark):
    key = "spark.sql.shuffle.partitions"
    before, path = spark.conf.get(key), scratch_path(spark, "feed")
    raw(spark, [event(0), event(200)]).write.parquet(path)
    out = scratch_path(spark, "app")
    feed = spark.readStream.schema("value string, timestamp timestamp").parquet(path)
    running = app.start(feed, out, state_partitions=3, once=True)
    assert spark.conf.get(key) == before
    for query in running.values():
        query.awaitTermination()
    assert {p.rsplit("/", 1)[1] for p in folders(spark, f"{out}/checkpoints/users/state/0", "[0-9]*")} == {"0", "1", "2"}
