"""Dashboard queries over the gold table (Q1-Q9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions import minutes_for, song_label
from encore.functions.scalar import event_month
from encore.operators.dims import latest_per_key
from encore.operators.topn import top_k


def latest_recommendations(recs: DataFrame) -> DataFrame:
    """Replace semantics: the newest row per user (ties: user_name)."""
    return latest_per_key(recs, ["user_id"], [F.col("updated_at").desc_nulls_last()],
                          [F.col("user_name").asc_nulls_last()])


def user_recommendations(recs: DataFrame, user_id: int) -> DataFrame:
    """Q1: one user's current recommendations, one row per song with its
    rank (1-based position in the list)."""
    cur = latest_recommendations(recs.filter(F.col("user_id") == F.lit(user_id)))
    return cur.select("user_name", F.posexplode("recommended_songs").alias("pos", "song"),
                      "updated_at").select(
        "user_name", (F.col("pos") + 1).alias("rank"), "song", "updated_at")


def total_plays(gold: DataFrame) -> DataFrame:
    """Q2: number of PLAY events (0 on an empty table)."""
    return gold.filter(F.col("event_type") == "PLAY").agg(F.count(F.lit(1)).alias("total_plays"))


def avg_listening_minutes(gold: DataFrame) -> DataFrame:
    """Q3: average minutes per event by event-type constants (null when
    empty)."""
    return gold.agg(F.avg(minutes_for("event_type")).alias("avg_minutes"))


def top_songs(gold: DataFrame, k: int = 5, day: str | None = None) -> DataFrame:
    """Q4 (and G1 with ``day``): top k songs by plays, grouped by
    (song_name, artist_name); ties by label."""
    g = gold.filter((F.col("event_type") == "PLAY") & (F.col("song_name") != ""))
    if day is not None:
        d = F.lit(day).cast("date")
        ts = F.col("event_timestamp")
        # A month-partition predicate plus a timestamp range (pushed to the
        # parquet scan), rather than a to_date() comparison nothing can push.
        g = g.filter((F.col("event_month") == event_month(d))
                     & (ts >= d.cast("timestamp")) & (ts < F.date_add(d, 1).cast("timestamp")))
    agg = g.groupBy("song_name", "artist_name").agg(F.count(F.lit(1)).alias("plays"))
    out = agg.select(song_label("song_name", "artist_name").alias("song"), "plays")
    return top_k(out, [F.col("plays").desc(), F.col("song").asc()], k)


def genre_distribution(gold: DataFrame) -> DataFrame:
    """Q5: events per genre over all event types (genre != ''), with the
    share of the total. The total is a one-row scalar subquery over the
    per-genre counts (the same shuffle stage, so gold is scanned once), not
    an unpartitioned window, so no single task ever holds all groups."""
    g = gold.filter(F.col("genre") != "")
    agg = g.groupBy("genre").agg(F.count(F.lit(1)).alias("total"))
    total = agg.agg(F.sum("total").alias("n")).scalar()
    return (agg.withColumn("share", F.col("total") / total)
               .orderBy(F.col("total").desc(), F.col("genre").asc()))


def listening_trend(gold: DataFrame, interval: str = "1 hour", lo: str | None = None,
                    hi: str | None = None) -> DataFrame:
    """Q6: events per (time bucket, event_type) in [lo, hi] (inclusive),
    ascending. The range also becomes a predicate on the month partition
    so only the months touched are scanned."""
    g = gold
    if lo is not None:
        t = F.lit(lo).cast("timestamp")
        g = g.filter((F.col("event_month") >= event_month(t)) & (F.col("event_timestamp") >= t))
    if hi is not None:
        t = F.lit(hi).cast("timestamp")
        g = g.filter((F.col("event_month") <= event_month(t)) & (F.col("event_timestamp") <= t))
    agg = (g.groupBy(F.window("event_timestamp", interval).start.alias("time"), "event_type")
            .agg(F.count(F.lit(1)).alias("count")))
    return agg.orderBy("time", "event_type")


def country_distribution(gold: DataFrame, k: int = 10) -> DataFrame:
    """Q7: top k countries by number of events (country != '')."""
    agg = (gold.filter(F.col("country") != "").groupBy("country")
               .agg(F.count(F.lit(1)).alias("events")))
    return top_k(agg, [F.col("events").desc(), F.col("country").asc()], k)


def recent_users(gold: DataFrame, k: int = 20) -> DataFrame:
    """Q8: last event time per (user_name, country, subscription_type),
    newest k."""
    agg = (gold.groupBy("user_name", "country", "subscription_type")
               .agg(F.max("event_timestamp").alias("last_seen")))
    return top_k(agg, [F.col("last_seen").desc(), "user_name", "country", "subscription_type"], k)


def recommendation_users(recs: DataFrame) -> DataFrame:
    """Q9: selectable user ids, ascending."""
    return recs.select("user_id").distinct().orderBy("user_id")
