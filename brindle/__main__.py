"""Command line: ``python -m brindle <command>`` (or ``spark-submit`` this file)."""

from __future__ import annotations

import argparse

from pyspark.sql import Observation
from pyspark.sql import functions as F

from brindle.operators import als, filters, inverted_index, ratings, reports
from brindle.operators.factor_table import FactorTable
from brindle.plans import flights as presets
from brindle.session import as_table, build_session, release_scratch, size_for
from brindle.sources import readers, schemas, writers
from brindle.streaming import app, ingest

SMOKE_LIMIT = 2.0  # fixed value: highest acceptable error of a smoke run


def flights(spark, args) -> None:
    """Answer the named question (default: all) and store each result."""
    table = readers.read_flights(spark, args.input)
    for name in args.question or presets.QUERIES:
        presets.QUERIES[name](table).write.mode("overwrite").parquet(f"{args.output}/{name}")


def index(spark, args) -> None:
    """Build the inverted index of a text folder: table, lines and stop-word shares."""
    docs = readers.read_documents(spark, args.input)
    words = (readers.read_word_list(spark, args.stopwords) if args.stopwords
             else inverted_index.english_stop_words(spark))
    stop = as_table(inverted_index.stop_terms(words), "stop")
    writers.write_index(inverted_index.build_index(docs, stop=stop), f"{args.output}/index")
    stored = readers.read_parquet(spark, f"{args.output}/index")
    lists = inverted_index.posting_lists(stored, stored=True)
    writers.write_index_text(lists, f"{args.output}/lines")
    inverted_index.stop_share(docs, stop).write.mode("overwrite").parquet(f"{args.output}/stop_share")


def train(spark, args) -> None:
    """Clean and index reviews, fit the model and store it with its dictionaries."""
    clean = as_table(ratings.clean_ratings(readers.read_reviews(spark, args.input)), "ratings")
    if args.smoke:
        clean = filters.hash_share(clean, ["reviewerID"], 1, args.smoke)
    indexed, users, items = ratings.index_ratings(clean)
    train_rows, test_rows = filters.hash_split(as_table(indexed, "indexed"), ["user_id", "item_id"])
    model, error, params = als.fit_tuned(train_rows, test_rows)
    als.save_artifacts(model, users, items, args.output)
    print(f"rmse={error:.4f} {params}")
    if args.smoke and error > SMOKE_LIMIT:
        raise SystemExit(f"smoke run failed: rmse {error:.4f} > {SMOKE_LIMIT}")


def replay(spark, args) -> None:
    """Turn reviews into event messages: JSON files, or a topic with --brokers."""
    users, items = readers.read_dictionaries(spark, args.model)
    matched = ratings.matched_reviews(readers.read_reviews(spark, args.input), users, items)
    counted = Observation("replay")
    messages = ingest.event_messages(ratings.known_events(matched.observe(counted, ratings.skipped_count())))
    if args.brokers:
        (messages.write.format("kafka").option("kafka.bootstrap.servers", args.brokers)
         .option("topic", ingest.INTERACTIONS).save())
    else:
        messages.select("value").write.mode("overwrite").text(args.output)
    print(f"skipped={counted.get['skipped']}")


def stream(spark, args) -> None:
    """Run the full stream from a topic (--brokers) or a folder of JSON lines."""
    raw = (ingest.kafka_source(spark, args.brokers, max_offsets=args.max_offsets,
                               tolerate_loss=args.tolerate_loss) if args.brokers
           else ingest.text_source(spark, args.input))
    model = als.load_model(args.model) if args.model else None
    factors = FactorTable(spark, f"{args.model}/user_factors") if args.model else None
    running = app.start(raw, args.output, model, brokers=args.brokers, once=args.once, user_factors=factors,
                        state_partitions=args.state_partitions)
    if args.once:
        for query in running.values():
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def report(spark, args) -> None:
    """Print the reports over a stream's output folder."""
    items = readers.read_batches(spark, f"{args.input}/windows/items", schemas.ITEM_WINDOWS)
    users = readers.read_batches(spark, f"{args.input}/windows/users", schemas.USER_WINDOWS)
    alerts = readers.read_batches(spark, f"{args.input}/alerts", schemas.ALERTS)
    latency = readers.read_batches(spark, f"{args.input}/latency", schemas.LATENCY)
    recs = readers.read_batches(spark, f"{args.input}/recs", schemas.RECOMMENDATIONS)
    judged = latency
    if args.recent:
        judged = reports.recent(latency, "process_ms", "event_time_ms", "user_id", "item_id", k=args.recent)
    for frame in (reports.activity(items, "item_id"), reports.activity(users, "user_id"),
                  recs.agg(F.count(F.lit(1)).alias("recommendations")),
                  reports.newest_recommendations(recs), reports.trending_now(items),
                  reports.busiest(users), reports.newest_alerts(alerts),
                  reports.latency_quantiles(latency), reports.histogram(judged, "latency_ms"),
                  reports.over_budget(judged)):
        frame.show(50, truncate=False)


COMMANDS = {f.__name__: f for f in (flights, index, train, replay, stream, report)}


def main(argv: list[str] | None = None, spark=None) -> None:
    parser = argparse.ArgumentParser(prog="brindle", description=__doc__)
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("--input", help="input path")
    parser.add_argument("--output", help="output path")
    parser.add_argument("--question", action="append", choices=sorted(presets.QUERIES))
    parser.add_argument("--stopwords", help="word list, one per line (default: built-in English)")
    parser.add_argument("--model", help="folder written by train")
    parser.add_argument("--brokers", help="Kafka bootstrap servers")
    parser.add_argument("--max-offsets", type=int, help="stream: read at most this many messages per trigger")
    parser.add_argument("--tolerate-loss", action="store_true",
                        help="stream: go on if messages were deleted before they were read")
    parser.add_argument("--state-partitions", type=int,
                        help="stream: partitions of the window state, fixed by the first start of a checkpoint")
    parser.add_argument("--recent", type=int, metavar="N",
                        help="report: histogram and budget over the newest N samples only (default: all)")
    parser.add_argument("--smoke", type=int, metavar="N",
                        help="train: a trial run whose training rows are bounded to one in N users")
    parser.add_argument("--once", action="store_true", help="stream: work off what is there and stop")
    args = parser.parse_args(argv)
    session = spark or build_session(f"brindle-{args.command}")
    if args.input:
        size_for(session, args.input)
    try:
        COMMANDS[args.command](session, args)
    finally:
        release_scratch(session)
        if spark is None:
            session.stop()


if __name__ == "__main__":
    main()
