"""Message sources and the parse / validate / watermark step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.operators.ratings import HIGHEST, LOWEST
from brindle.sources import schemas

# Default topics, allowed lateness, time format.
INTERACTIONS, ALERTS, RECOMMENDATIONS = "interactions", "alerts", "recommendations"
WATERMARK = "1 minute"
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}  # keeps microseconds

_CORRUPT = "_corrupt"


def kafka_source_options(brokers: str, topic: str = INTERACTIONS, *, starting: str = "latest",
                         max_offsets: int | None = None, tolerate_loss: bool = False) -> dict[str, str]:
    """Reader options: from the latest offset; ``max_offsets`` bounds a trigger (default: all there is).

    Messages deleted before they were read stop the stream unless ``tolerate_loss``.
    """
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic,
               "startingOffsets": starting, "failOnDataLoss": str(not tolerate_loss).lower()}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_source(spark: SparkSession, brokers: str, topic: str = INTERACTIONS, **options) -> DataFrame:
    """Raw messages of a topic; needs Spark's Kafka connector on the class path."""
    return (spark.readStream.format("kafka")
            .options(**kafka_source_options(brokers, topic, **options)).load())


def text_source(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw messages from files of JSON lines, with the file time as append time."""
    lines = spark.readStream.options(**options).text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def parse_events(raw: DataFrame) -> DataFrame:
    """Parse message values: event fields, ``kafka_ts``, ``payload`` and ``malformed``.

    A value that is null, not JSON or of the wrong field types is malformed.
    """
    payload = F.col("value").cast("string")
    event = F.from_json("payload", f"{schemas.EVENT}, {_CORRUPT} string",
                        {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"})
    parsed = (raw.select(payload.alias("payload"), F.col("timestamp").alias("kafka_ts"))
              .withColumn("evt", event))
    malformed = F.col("evt").isNull() | F.col("payload").isNull() | F.col(f"evt.{_CORRUPT}").isNotNull()
    return parsed.select(
        "evt.user_id", "evt.item_id", "evt.rating", F.col("evt.timestamp").alias("event_time"),
        "evt.event_time_ms", "evt.user_key", "evt.item_key", "kafka_ts", "payload",
        malformed.alias("malformed"))


def _valid() -> Column:
    ok = (~F.col("malformed") & F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
          & F.col("rating").between(LOWEST, HIGHEST))
    return F.coalesce(ok, F.lit(False))


def good_events(parsed: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Valid events with their watermark."""
    return (parsed.where(_valid()).drop("payload", "malformed")
            .withWatermark("event_time", watermark))


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Everything :func:`good_events` leaves out, with the reason."""
    reason = (F.when(F.col("malformed"), "malformed")
              .when(F.col("user_id").isNull() | F.col("item_id").isNull(), "missing id")
              .otherwise("rating out of range"))
    return parsed.where(~_valid()).select("payload", "kafka_ts", reason.alias("reason"))


def identity(*cols: str) -> Column:
    """Message key of several columns, joined by ``/`` in the given order; a null is empty, instants are milliseconds."""
    return F.concat_ws("/", *(F.coalesce((F.unix_millis(c) if c.startswith("window_") else F.col(c)).cast("string"), F.lit(""))
                              for c in cols))


def message(df: DataFrame, value_cols: list[str] | None = None, key: str | Column | None = None) -> DataFrame:
    """Message form of rows: optional string key, JSON of the chosen columns as value."""
    key = F.lit(None) if key is None else (F.col(key) if isinstance(key, str) else key)
    return df.select(key.cast("string").alias("key"),
                     F.to_json(F.struct(*(value_cols or df.columns)), JSON_OPTIONS).alias("value"))


def event_messages(events: DataFrame, partitions: int = 3) -> DataFrame:
    """Events as messages, keyed by user modulo ``partitions``."""
    return message(events, key=F.pmod("user_id", F.lit(partitions)))
