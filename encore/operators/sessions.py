"""Listening sessions (G10): a user's events with no pause longer than a gap.
The same aggregation serves batch tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GAP = "30 minutes"


def sessions(events: DataFrame, gap: str = GAP) -> DataFrame:
    """user_id, started, ended (first and last event), events, plays and skips.

    Session windows are merged by user after a partial merge within each map
    task, so a user with very many events is pre-aggregated before the
    shuffle. Events without user or time are left out. A stream needs a
    watermark on event_timestamp, and gives a session once it has passed."""
    is_play, is_skip = (F.when(F.col("event_type") == t, 1) for t in ("PLAY", "SKIP"))
    return (events.filter("user_id is not null and event_timestamp is not null")
            .groupBy("user_id", F.session_window("event_timestamp", gap).alias("w"))
            .agg(F.min("event_timestamp").alias("started"), F.max("event_timestamp").alias("ended"),
                 F.count("*").alias("events"), F.count(is_play).alias("plays"), F.count(is_skip).alias("skips"))
            .drop("w"))


def stream_sessions(gold_stream: DataFrame, gap: str = GAP, delay: str = "1 hour") -> DataFrame:
    """:func:`sessions` of a gold stream, in append mode: each session once,
    when the watermark shows that nothing can join it any more."""
    timed = gold_stream.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return sessions(timed.withWatermark("event_timestamp", delay), gap)


def listening_patterns(found: DataFrame) -> DataFrame:
    """Order statistics of each user's sessions: sessions, events,
    median_seconds, p90_seconds, longest_seconds, median_events and
    median_pause_seconds (end of a session to the start of the next; null with
    one session). Exact: percentiles are taken over counted values, so a user's
    state follows the distinct lengths, not the sessions."""
    seconds = F.unix_seconds("ended") - F.unix_seconds("started")
    before = F.lag("ended").over(Window.partitionBy("user_id").orderBy("started"))
    s = found.withColumn("seconds", seconds).withColumn(
        "pause", F.unix_seconds("started") - F.unix_seconds(before))
    return s.groupBy("user_id").agg(
        F.count("*").alias("sessions"), F.sum("events").alias("events"),
        F.percentile("seconds", F.lit(0.5)).alias("median_seconds"),
        F.percentile("seconds", F.lit(0.9)).alias("p90_seconds"),
        F.max("seconds").alias("longest_seconds"),
        F.percentile("events", F.lit(0.5)).alias("median_events"),
        F.percentile("pause", F.lit(0.5)).alias("median_pause_seconds"))
