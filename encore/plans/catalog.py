"""Registry of named queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query runs the full chain over the driver's tables (messages ->
bronze -> dimensions -> silver -> gold) and then its own plan, so its work
grows with the tables. Wall-clock columns are either fixed by ``as_of`` or
left out of the compared output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.operators.backfill import backfill_gold, dimension_changes
from encore.operators.bronze import bronze
from encore.operators.contract import field_types
from encore.operators.dims import build_dim_songs, build_dim_users, upsert
from encore.operators.enrich import enrich
from encore.operators.gold import gold_layout, split_gold, standardize_gold
from encore.operators.history import (
    SONG_ATTRIBUTES, USER_ATTRIBUTES, enrich_as_of, song_history, user_history,
)
from encore.operators.sessions import listening_patterns, sessions
from encore.operators.sketches import (
    daily_leaders, daily_song_plays, error_bound, listener_sketches, top_songs_between,
)
from encore.operators.tracks import explode_pages, normalize_tracks
from encore.plans import dashboard, insights, lake, recommend, streams
from encore.schemas import DIM_USERS, EVENT_MESSAGE_WITH_DURATION, RECOMMENDATIONS
from encore.session import scratch_path
from encore.sinks import writers
from encore.sinks.buckets import read_buckets, upsert_buckets
from encore.sources import fixtures
from encore.sources.readers import read_gold, read_songs, read_track_pages, read_users

# Fixed parameters of the registered dashboard queries.
TREND_INTERVAL = "1 hour"
TREND_FROM = "2024-01-01 00:00:00"
TREND_TO = "2024-01-31 23:59:59"

_BRONZE_COLS = ["event_id", "user_id", "song_id", "timestamp", "event_type", "source"]


def _lake(spark: SparkSession, sf_dir: str) -> lake.Lake:
    return lake.from_tables(spark, sf_dir)


def q_bronze_valid(spark, sf_dir):
    return _lake(spark, sf_dir).valid.select(*_BRONZE_COLS)


def q_bronze_invalid(spark, sf_dir):
    return _lake(spark, sf_dir).invalid.select(*_BRONZE_COLS, "is_valid", "error_type")


def q_dim_users(spark, sf_dir):
    return _lake(spark, sf_dir).dim_users


def q_dim_songs(spark, sf_dir):
    return _lake(spark, sf_dir).dim_songs


def q_silver_enriched(spark, sf_dir):
    return _lake(spark, sf_dir).silver.drop("processed_at")


def q_gold_events(spark, sf_dir):
    return _lake(spark, sf_dir).gold.drop("processed_at")


def _gold(spark, sf_dir) -> DataFrame:
    return _lake(spark, sf_dir).gold


def q_total_plays(spark, sf_dir):
    return dashboard.total_plays(_gold(spark, sf_dir))


def q_avg_listening_minutes(spark, sf_dir):
    return dashboard.avg_listening_minutes(_gold(spark, sf_dir))


def q_top_songs(spark, sf_dir):
    return dashboard.top_songs(_gold(spark, sf_dir), k=5)


def q_genre_distribution(spark, sf_dir):
    return dashboard.genre_distribution(_gold(spark, sf_dir))


def q_listening_trend(spark, sf_dir):
    return dashboard.listening_trend(_gold(spark, sf_dir), TREND_INTERVAL, TREND_FROM, TREND_TO)


def q_country_distribution(spark, sf_dir):
    return dashboard.country_distribution(_gold(spark, sf_dir), k=10)


def q_recent_users(spark, sf_dir):
    return dashboard.recent_users(_gold(spark, sf_dir), k=20)


def q_active_users(spark, sf_dir):
    return recommend.active_users(_gold(spark, sf_dir))


def q_plays_by_country(spark, sf_dir):
    return recommend.plays_by_country(_gold(spark, sf_dir)).orderBy(
        F.col("country"), F.col("plays").desc(), "song_name", "artist_name")


def q_recommendations(spark, sf_dir):
    recs = recommend.recommend(_gold(spark, sf_dir), n=3, as_of=lake.FIXED_AS_OF)
    return recommend.recommendation_rows(recs)


# Two recommendation generations: one made from the first half of the
# month, one from the second half. Users active only in the first half keep
# their older list, everybody else gets the newer one.
RECS_SPLIT = "2024-01-16 00:00:00"
RECS_USER = 7          # the dashboard's selected user
TOP_DAY = "2024-01-15"


def recommendation_table(gold: DataFrame) -> DataFrame:
    ts = F.col("event_timestamp")
    split = F.lit(RECS_SPLIT).cast("timestamp")
    first = recommend.recommend(gold.filter(ts < split), n=3, as_of=RECS_SPLIT)
    second = recommend.recommend(gold.filter(ts >= split), n=3, as_of=lake.FIXED_AS_OF)
    return first.unionByName(second)


def q_latest_recommendations(spark, sf_dir):
    cur = dashboard.latest_recommendations(recommendation_table(_gold(spark, sf_dir)))
    return recommend.recommendation_rows(cur, keep=("updated_at",))


def q_user_recommendations(spark, sf_dir):
    return dashboard.user_recommendations(recommendation_table(_gold(spark, sf_dir)), RECS_USER)


def q_recommendation_users(spark, sf_dir):
    return dashboard.recommendation_users(recommendation_table(_gold(spark, sf_dir)))


def q_recommendation_engagement(spark, sf_dir):
    g = _gold(spark, sf_dir)
    return insights.recommendation_engagement(recommendation_table(g), g)


def q_top_songs_day(spark, sf_dir):
    return dashboard.top_songs(_gold(spark, sf_dir), k=5, day=TOP_DAY)


def q_top_artists(spark, sf_dir):
    return insights.top_artists(_gold(spark, sf_dir), k=10)


def q_most_active_users(spark, sf_dir):
    return insights.most_active_users(_gold(spark, sf_dir), k=10)


def q_daily_active_users(spark, sf_dir):
    return insights.daily_active_users(_gold(spark, sf_dir))


def q_daily_volume(spark, sf_dir):
    return insights.daily_volume(_gold(spark, sf_dir))


def q_genre_trend(spark, sf_dir):
    return insights.genre_trend(_gold(spark, sf_dir))


def q_growing_artists(spark, sf_dir):
    return insights.growing_artists(_gold(spark, sf_dir), k=10)


def q_trending_songs(spark, sf_dir):
    return insights.trending_songs(_gold(spark, sf_dir), window_hours=48, k=10)


def q_avg_duration(spark, sf_dir):
    valid, _ = bronze(fixtures.event_messages(spark, sf_dir), as_of=lake.FIXED_AS_OF,
                      schema=EVENT_MESSAGE_WITH_DURATION)
    return insights.avg_duration(valid)


def q_user_engagement(spark, sf_dir):
    return insights.user_engagement(_gold(spark, sf_dir))


def q_hourly_pattern(spark, sf_dir):
    return insights.hourly_pattern(_gold(spark, sf_dir))


def q_country_activity(spark, sf_dir):
    return insights.country_activity(_gold(spark, sf_dir))


def q_platform_growth(spark, sf_dir):
    return insights.platform_growth(_gold(spark, sf_dir))


def q_data_quality(spark, sf_dir):
    from encore.operators.bronze import parse_events
    parsed = parse_events(_messages_with_faults(spark, sf_dir), as_of=lake.FIXED_AS_OF)
    return insights.data_quality_report(parsed)


def _messages_with_faults(spark, sf_dir):
    return fixtures.event_messages(spark, sf_dir).unionByName(fixtures.faulty_messages(spark, sf_dir))


def _lake_with_faults(spark, sf_dir) -> lake.Lake:
    return lake.build(_messages_with_faults(spark, sf_dir), fixtures.users_landing(spark, sf_dir),
                      fixtures.songs_landing(spark, sf_dir), as_of=lake.FIXED_AS_OF)


def q_bronze_quarantine(spark, sf_dir):
    """Quarantined messages with their payload, faults included."""
    return _lake_with_faults(spark, sf_dir).invalid.select(
        "event_id", "user_id", "song_id", "timestamp", "event_type", "raw_value", "error_type")


def q_gold_rejects(spark, sf_dir):
    """Events whose time does not parse, enriched (the song id is padded)."""
    return _lake_with_faults(spark, sf_dir).gold_rejects.select(
        "event_id", "user_id", "user_name", "song_id", "song_name", "event_type")


def q_gold_event_types(spark, sf_dir):
    """events per type, faults included (a missing type is 'N/A')."""
    return _lake_with_faults(spark, sf_dir).gold.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"))


def q_dim_songs_newest(spark, sf_dir):
    """Every third song landed again, half of them newer, half older."""
    songs = fixtures.songs_landing(spark, sf_dir)
    key = F.expr("cast(substring(song_id, 6) as bigint)")
    again = songs.filter(key % 3 == 0).withColumn("song_name", F.concat("song_name", F.lit(" v2"))) \
        .withColumn("ingested_at", F.when(key % 2 == 0, F.lit("2024-03-01T00:00:00"))
                    .otherwise(F.lit("2023-03-01T00:00:00")))
    return build_dim_songs(songs.unionByName(again))


def q_dim_users_newest(spark, sf_dir):
    """Every third user landed again, half of them newer, half older."""
    users = fixtures.users_landing(spark, sf_dir)
    key = F.col("user_id").cast("bigint")
    again = users.filter(key % 3 == 0).withColumn("country", F.lit("MOVED")) \
        .withColumn("ingested_at", F.when(key % 2 == 0, F.lit("2024-03-01T00:00:00"))
                    .otherwise(F.lit("2023-03-01T00:00:00")))
    return build_dim_users(users.unionByName(again))


def q_songs_landing_roundtrip(spark, sf_dir):
    """K8 -> S2: the songs landed as JSON lines and, under the same folder, as
    array files; read back without saying which is which."""
    root = scratch_path(spark, "songs")
    songs = fixtures.songs_landing(spark, sf_dir)
    odd = F.expr("cast(substring(song_id, 6) as bigint) % 2 = 1")
    writers.land_songs(songs.filter(odd), root, "20240101_000000")
    # One array per hundred songs, each a file of its own line.
    writers.land_song_arrays(songs.filter(~odd), root, "20240102_000000")
    return read_songs(spark, f"{root}/*")


def q_users_landing_roundtrip(spark, sf_dir):
    """K9 -> S3: the users landed as CSV files and read back."""
    path = scratch_path(spark, "users")
    writers.land_users(fixtures.users_landing(spark, sf_dir), path)
    return read_users(spark, path)


def q_track_pages_roundtrip(spark, sf_dir):
    """Chart pages landed as JSON lines and read back as tracks."""
    path = scratch_path(spark, "pages")
    fixtures.chart_pages(spark, sf_dir).drop("page").write.json(path)
    return read_track_pages(spark, path).select("name", "mbid", F.col("artist.name").alias("artist"))


def q_recommendation_history(spark, sf_dir):
    """K7: two generations appended to the history and read back."""
    path = scratch_path(spark, "history")
    g = _gold(spark, sf_dir)
    ts, split = F.col("event_timestamp"), F.lit(RECS_SPLIT).cast("timestamp")
    writers.write_recommendations(recommend.recommend(g.filter(ts < split), n=3, as_of=RECS_SPLIT), path)
    writers.write_recommendations(recommend.recommend(g.filter(ts >= split), n=3,
                                                      as_of=lake.FIXED_AS_OF), path)
    back = spark.read.schema(RECOMMENDATIONS).parquet(path)
    return recommend.recommendation_rows(back, keep=("updated_at",))


def q_track_catalog(spark, sf_dir):
    pages = fixtures.chart_pages(spark, sf_dir)
    return normalize_tracks(explode_pages(pages), ingested_at=lake.FIXED_AS_OF)


# Dimension update batch for the upsert query: every landed customer of the
# AUTOMOBILE segment changes country to a fixed value, and every customer of
# the BUILDING segment opens a second account under a new key.
UPSERT_SEGMENT = "AUTOMOBILE"
UPSERT_COUNTRY = "RELOCATED"
UPSERT_NEW_SEGMENT = "BUILDING"


def _user_updates(spark, sf_dir) -> DataFrame:
    c = fixtures.table(spark, sf_dir, "customer")
    n = fixtures.table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    moved = F.col("c_mktsegment") == UPSERT_SEGMENT
    upd = j.filter(moved | (F.col("c_mktsegment") == UPSERT_NEW_SEGMENT))
    landing = upd.select(
        F.when(moved, F.col("c_custkey")).otherwise(F.col("c_custkey") + fixtures.STRANGER_OFFSET)
         .cast("string").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.when(moved, F.lit(UPSERT_COUNTRY))
         .otherwise(F.col("n_name")).alias("country"),
        F.lit("Free").alias("subscription_type"),
        F.lit("2024-02-01T00:00:00").alias("ingested_at"))
    return build_dim_users(landing)


def q_dim_users_upsert(spark, sf_dir):
    target = build_dim_users(fixtures.users_landing(spark, sf_dir))
    return upsert(target, _user_updates(spark, sf_dir), ["user_id"])


def q_recommendation_candidates(spark, sf_dir):
    from encore.plans.ml import candidates, user_song_plays
    return candidates(user_song_plays(_gold(spark, sf_dir)))


def q_als_recommend(spark, sf_dir):
    from encore.plans.ml import als_recommend
    return als_recommend(_gold(spark, sf_dir), n=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_valid": q_bronze_valid,
    "bronze_invalid": q_bronze_invalid,
    "dim_users": q_dim_users,
    "dim_songs": q_dim_songs,
    "silver_enriched": q_silver_enriched,
    "gold_events": q_gold_events,
    "total_plays": q_total_plays,
    "avg_listening_minutes": q_avg_listening_minutes,
    "top_songs": q_top_songs,
    "genre_distribution": q_genre_distribution,
    "listening_trend": q_listening_trend,
    "country_distribution": q_country_distribution,
    "recent_users": q_recent_users,
    "active_users": q_active_users,
    "plays_by_country": q_plays_by_country,
    "recommendations": q_recommendations,
    "latest_recommendations": q_latest_recommendations,
    "user_recommendations": q_user_recommendations,
    "recommendation_users": q_recommendation_users,
    "recommendation_engagement": q_recommendation_engagement,
    "top_songs_day": q_top_songs_day,
    "top_artists": q_top_artists,
    "most_active_users": q_most_active_users,
    "daily_active_users": q_daily_active_users,
    "daily_volume": q_daily_volume,
    "genre_trend": q_genre_trend,
    "growing_artists": q_growing_artists,
    "trending_songs": q_trending_songs,
    "avg_duration": q_avg_duration,
    "user_engagement": q_user_engagement,
    "hourly_pattern": q_hourly_pattern,
    "country_activity": q_country_activity,
    "platform_growth": q_platform_growth,
    "data_quality": q_data_quality,
    "track_catalog": q_track_catalog,
    "bronze_quarantine": q_bronze_quarantine,
    "gold_rejects": q_gold_rejects,
    "gold_event_types": q_gold_event_types,
    "dim_songs_newest": q_dim_songs_newest,
    "dim_users_newest": q_dim_users_newest,
    "songs_landing_roundtrip": q_songs_landing_roundtrip,
    "users_landing_roundtrip": q_users_landing_roundtrip,
    "track_pages_roundtrip": q_track_pages_roundtrip,
    "recommendation_history": q_recommendation_history,
    "dim_users_upsert": q_dim_users_upsert,
    "recommendation_candidates": q_recommendation_candidates,
    "als_recommend": q_als_recommend,
    "streaming_gold": streams.streaming_gold,
    "streaming_trend": streams.streaming_trend,
    "streaming_dedupe": streams.streaming_dedupe,
    "streaming_late_rows": streams.streaming_late_rows,
    "recommendations_incremental": streams.recommendations_incremental,
}


def _histories(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return (user_history(fixtures.user_versions(spark, sf_dir)),
            song_history(fixtures.song_versions(spark, sf_dir)))


def q_dim_users_history(spark, sf_dir):
    """J1/P6 over time: validity intervals of the landed user versions."""
    return _histories(spark, sf_dir)[0]


def q_silver_point_in_time(spark, sf_dir):
    """J1/J2 over time: each event with the versions valid at its time."""
    users, songs = _histories(spark, sf_dir)
    return enrich_as_of(_lake(spark, sf_dir).valid, users, songs,
                        as_of=lake.FIXED_AS_OF).drop("processed_at")


def q_gold_backfilled(spark, sf_dir):
    """J3 backwards, S6: gold is written with the dimensions as first landed
    (some users missing, others and some songs different), then the changes to
    the present dimensions are filled in, and the table is read again."""
    now = _lake(spark, sf_dir)
    users = (now.dim_users.filter("user_id % 6 <> 0").withColumn(
        "country", F.when(F.col("user_id") % 6 == 1, "OLD").otherwise(F.col("country"))))
    songs = now.dim_songs.withColumn(
        "genre", F.when(F.col("song_id").endswith("7"), F.lit(None)).otherwise(F.col("genre")))
    gold, _ = split_gold(standardize_gold(enrich(now.valid, users, songs, as_of=lake.FIXED_AS_OF)))
    path = scratch_path(spark, "gold-backfill")
    gold_layout(gold).write.partitionBy("event_month").parquet(path)
    backfill_gold(spark, path, dimension_changes(users, now.dim_users, "user_id", USER_ATTRIBUTES),
                  dimension_changes(songs, now.dim_songs, "song_id", SONG_ATTRIBUTES), as_of=lake.FIXED_AS_OF)
    return read_gold(spark, path).drop("processed_at")


ATTRIBUTION_TIMES = ["2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00"]


def q_recommendation_attribution(spark, sf_dir):
    """G13 by generation: three generations, each made from the events since
    the one before; every play belongs to the generation in force."""
    path = scratch_path(spark, "gold-attribution")
    gold_layout(_gold(spark, sf_dir)).write.partitionBy("event_month").parquet(path)
    gold = read_gold(spark, path)
    recs, since = None, "2000-01-01 00:00:00"
    for made in ATTRIBUTION_TIMES:
        seen = gold.filter((F.col("event_timestamp") >= F.lit(since).cast("timestamp"))
                           & (F.col("event_timestamp") < F.lit(made).cast("timestamp")))
        one = recommend.recommend(seen, n=3, as_of=made)
        recs = one if recs is None else recs.unionByName(one)
        since = made
    return insights.recommendation_attribution(recs, gold)


def q_als_recommend_catalogue(spark, sf_dir):
    """G14 over the whole catalogue, exactly (blocks small enough here that
    users stop at different ones)."""
    from encore.plans.ml import als_recommend_catalogue

    return als_recommend_catalogue(_gold(spark, sf_dir), n=3, block=32)


def q_listening_sessions(spark, sf_dir):
    return sessions(_gold(spark, sf_dir))


def q_listening_patterns(spark, sf_dir):
    return listening_patterns(sessions(_gold(spark, sf_dir)))


def q_listeners_by_week(spark, sf_dir):
    """G4/G11 from stored sketches: distinct users of each calendar week and
    country, exactly, and whether the merged sketches of its days estimate
    them within the bound."""
    gold = _gold(spark, sf_dir)
    path = scratch_path(spark, "listener-sketches")
    listener_sketches(gold).write.parquet(path)
    stored = spark.read.schema("day date, country string, users binary").parquet(path)
    week = F.date_trunc("week", "day").alias("week")
    told = stored.groupBy(week, "country").agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("told"))
    exact = gold.filter("user_id is not null").groupBy(
        F.date_trunc("week", "event_timestamp").alias("week"), "country").agg(
        F.count_distinct("user_id").alias("listeners"))
    near = F.abs(F.col("told") - F.col("listeners")) <= error_bound() * F.col("listeners")
    return exact.join(told, ["week", "country"]).select("week", "country", "listeners", near.alias("within_bound"))


def q_top_songs_leaders(spark, sf_dir):
    """Q4 from stored daily counts and leaders: equal to the full ranking."""
    path = scratch_path(spark, "daily-plays")
    daily_song_plays(_gold(spark, sf_dir)).write.partitionBy("day").parquet(path)
    daily = spark.read.schema("song string, plays long, day date").parquet(path)
    best, _ = top_songs_between(daily, daily_leaders(daily, 20), 5, "2024-01-01", "2024-01-31")
    return best


def q_message_types(spark, sf_dir):
    """G15, types: events and faulty messages against the declared contract."""
    return field_types(_messages_with_faults(spark, sf_dir))


def q_dim_users_upsert_buckets(spark, sf_dir):
    """M1/M2 in buckets: the upsert of dim_users_upsert, rewriting only the
    buckets of its keys, applied twice (the second time changes nothing)."""
    path = scratch_path(spark, "dim-users-buckets")
    users = _lake(spark, sf_dir).dim_users
    upsert_buckets(users, path, ["user_id"])
    for _ in range(2):
        upsert_buckets(_user_updates(spark, sf_dir), path, ["user_id"])
    return read_buckets(spark, path, DIM_USERS)


QUERIES |= {
    "dim_users_upsert_buckets": q_dim_users_upsert_buckets,
    "message_types": q_message_types,
    "listening_sessions": q_listening_sessions,
    "listening_patterns": q_listening_patterns,
    "streaming_sessions": streams.streaming_sessions,
    "listeners_by_week": q_listeners_by_week,
    "top_songs_leaders": q_top_songs_leaders,
    "recommendation_attribution": q_recommendation_attribution,
    "als_recommend_catalogue": q_als_recommend_catalogue,
    "dim_users_history": q_dim_users_history,
    "silver_point_in_time": q_silver_point_in_time,
    "gold_backfilled": q_gold_backfilled,
}


def _in_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Event times are UTC wall-clock text: pin the session zone for
    callers whose session was not built by ``encore.session``."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(fn) for name, fn in QUERIES.items()}
