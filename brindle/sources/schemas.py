"""Table schemas. Field names, order and types are fixed values."""

FLIGHTS = """
    FL_DATE date, AIRLINE string, AIRLINE_DOT string, AIRLINE_CODE string, DOT_CODE int,
    FL_NUMBER int, ORIGIN string, ORIGIN_CITY string, DEST string, DEST_CITY string,
    CRS_DEP_TIME int, DEP_TIME double, DEP_DELAY double, TAXI_OUT double, WHEELS_OFF double,
    WHEELS_ON double, TAXI_IN double, CRS_ARR_TIME int, ARR_TIME double, ARR_DELAY double,
    CANCELLED double, CANCELLATION_CODE string, DIVERTED double, CRS_ELAPSED_TIME double,
    ELAPSED_TIME double, AIR_TIME double, DISTANCE double, DELAY_DUE_CARRIER double,
    DELAY_DUE_WEATHER double, DELAY_DUE_NAS double, DELAY_DUE_SECURITY double,
    DELAY_DUE_LATE_AIRCRAFT double
"""

# One interaction, as it travels in a message value.
EVENT = """
    user_id int, item_id int, rating double, timestamp timestamp, event_time_ms bigint,
    user_key string, item_key string
"""

# Snapshot of the trending table: one row per item.
TRENDING = "item_id int, score double, window_end timestamp"

PERFORMANCE = "query string, api string, seconds double, rows bigint"

# What the stream writes.
ITEM_WINDOWS = ("window_start timestamp, window_end timestamp, item_id int, count bigint, "
                "avg_rating double, trending_score double")
USER_WINDOWS = "window_start timestamp, window_end timestamp, user_id int, count bigint"
USER_ACTIVITY = "window_end timestamp, rows bigint, sketch_user_id binary"
USER_BITMAPS = "window_end timestamp, bucket bigint, rows bigint, bitmap_user_id binary"
ALERTS = ("alert_type string, subject string, metric double, magnitude bigint, "
          "window_start timestamp, window_end timestamp")
LATENCY = ("user_id int, item_id int, event_time_ms bigint, ingest_ms bigint, process_ms bigint, "
           "latency_ms bigint, batch_id bigint")
RECOMMENDATIONS = ("user_id bigint, rank bigint, item_id bigint, score double, "
                   "generated_at_ms bigint, batch_id bigint")
