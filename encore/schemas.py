"""Explicit schemas of every table and message (no inference anywhere)."""

from pyspark.sql import types as T

# Event message as produced upstream. duration_seconds is optional: it is not
# read by bronze/silver/gold, only by the listening-duration metric.
EVENT_MESSAGE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
])

EVENT_MESSAGE_WITH_DURATION = T.StructType(
    EVENT_MESSAGE.fields + [T.StructField("duration_seconds", T.IntegerType())])

# Songs landing file (JSON array or JSON lines).
SONGS_LANDING = T.StructType([
    T.StructField("song_id", T.StringType()),
    T.StructField("song_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("genre", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])

# Users landing CSV: every column is text, as written by the landing job.
USERS_LANDING = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
])

BRONZE_VALID = T.StructType(EVENT_MESSAGE.fields + [
    T.StructField("ingestion_time", T.TimestampType()),
    T.StructField("source", T.StringType()),
])

BRONZE_INVALID = T.StructType(BRONZE_VALID.fields + [
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("raw_value", T.StringType()),
])

DIM_SONGS = T.StructType([
    T.StructField("song_id", T.StringType()),
    T.StructField("song_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("genre", T.StringType()),
])

DIM_USERS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("is_current", T.BooleanType()),
])

SILVER = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("song_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
])

# Gold column order is the order of the analytical table definition; writes
# are always by name. event_month (yyyymm) is the storage partition.
GOLD_COLUMNS = [
    "event_id", "user_id", "user_name", "song_id", "song_name", "artist_name",
    "genre", "subscription_type", "country", "event_type", "event_timestamp",
    "processed_at",
]

GOLD = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.IntegerType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("song_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("event_month", T.IntegerType()),
])

RECOMMENDATIONS = T.StructType([
    T.StructField("user_id", T.IntegerType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("recommended_songs", T.ArrayType(T.StringType())),
    T.StructField("updated_at", T.TimestampType()),
])

# Landed chart page: {"tracks": {"track": [{"name", "mbid", "artist": {"name"}}]}}
TRACK = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("mbid", T.StringType()),
    T.StructField("artist", T.StructType([T.StructField("name", T.StringType())])),
])

CHART_PAGE = T.StructType([
    T.StructField("tracks", T.StructType([
        T.StructField("track", T.ArrayType(TRACK)),
    ])),
])
