"""Listening analytics promised by the upstream documentation (our
definitions over gold). Every plan is aggregation-first: conditional counts
and partial aggregation before any shuffle; windows only over
already-aggregated, bounded series (weeks, days)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions import song_label
from encore.functions.scalar import event_month
from encore.operators.dims import latest_per_key
from encore.operators.history import join_as_of
from encore.operators.topn import top_k

EVENT_TYPES = ["PLAY", "SKIP", "LIKE"]


def _day() -> F.Column:
    """Calendar day of the event as a midnight timestamp (same type as the
    time buckets of the trend query)."""
    return F.date_trunc("day", "event_timestamp")


def _time_slice(lo: F.Column, hi: F.Column, lo_open: bool) -> F.Column:
    """Events in (lo, hi] (``lo_open``) or [lo, hi), plus the matching
    event_month range, so only the months touched are scanned. With a
    scalar-subquery bound the month filter still prunes, at run time."""
    ts = F.col("event_timestamp")
    rng = ((ts > lo) & (ts <= hi)) if lo_open else ((ts >= lo) & (ts < hi))
    m = F.col("event_month")
    return rng & (m >= event_month(lo)) & (m <= event_month(hi))


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def _is(t: str) -> F.Column:
    return F.col("event_type") == t


def top_artists(gold: DataFrame, k: int = 10) -> DataFrame:
    """PLAY count per artist, top k."""
    agg = (gold.filter(_is("PLAY") & (F.col("artist_name") != ""))
               .groupBy("artist_name").agg(F.count(F.lit(1)).alias("plays")))
    return top_k(agg, [F.col("plays").desc(), F.col("artist_name").asc()], k)


def most_active_users(gold: DataFrame, k: int = 10) -> DataFrame:
    """Events and plays per user, top k by events (the count-based
    answer to "most active users")."""
    agg = gold.groupBy("user_id", "user_name").agg(
        F.count(F.lit(1)).alias("events"), _count_if(_is("PLAY")).alias("plays"))
    return top_k(agg, [F.col("events").desc(), F.col("user_id").asc(),
                       F.col("user_name").asc()], k)


def daily_active_users(gold: DataFrame) -> DataFrame:
    """Distinct users per day."""
    return (gold.groupBy(_day().alias("day"))
                .agg(F.countDistinct("user_id").alias("active_users"))
                .orderBy("day"))


def daily_volume(gold: DataFrame) -> DataFrame:
    """Events per day, one column per event type plus the total.

    A pivot on event_type written as conditional counts: one aggregation
    pass (partial + final), where ``groupBy().pivot()`` would add a second
    aggregation and, with the total, a join."""
    return (gold.groupBy(_day().alias("day"))
                .agg(*[_count_if(_is(t)).alias(t.lower() + "s") for t in EVENT_TYPES],
                     F.count(F.lit(1)).alias("events"))
                .orderBy("day"))


def _weekly(gold: DataFrame, key: str) -> DataFrame:
    week = F.date_trunc("week", "event_timestamp").alias("week")
    return (gold.filter(_is("PLAY")).groupBy(key, week)
                .agg(F.count(F.lit(1)).alias("plays")))


def genre_trend(gold: DataFrame) -> DataFrame:
    """Plays per (genre, week starting Monday, as a timestamp) and the change against
    the calendar week before: 0 plays if that week has none, null in the
    genre's first week (lag over the weekly series, whose length is bounded
    by the number of weeks)."""
    wk = _weekly(gold, "genre")
    w = Window.partitionBy("genre").orderBy("week")
    last = F.lag("week").over(w)
    prev = F.when(last == F.col("week") - F.expr("INTERVAL 7 DAYS"), F.lag("plays").over(w)) \
        .when(last.isNotNull(), F.lit(0).cast("bigint"))
    return (wk.withColumn("prev_plays", prev)
              .withColumn("change", F.col("plays") - F.col("prev_plays"))
              .orderBy("genre", "week"))


def growing_artists(gold: DataFrame, k: int = 10, week: str | None = None) -> DataFrame:
    """Artists ranked by the growth of their plays in a week (default:
    the latest week in the data) against the week before. Conditional
    counts over a two-week slice; the latest week is a scalar subquery."""
    if week is None:
        wk = gold.agg(F.to_date(F.date_trunc("week", F.max("event_timestamp"))).alias("w")).scalar()
    else:
        wk = F.to_date(F.lit(week))
    d = F.to_date("event_timestamp")
    cur = (d >= wk) & (d < F.date_add(wk, 7))
    prev = (d >= F.date_sub(wk, 7)) & (d < wk)
    sl = gold.filter(_is("PLAY") & _time_slice(F.date_sub(wk, 7).cast("timestamp"),
                                               F.date_add(wk, 7).cast("timestamp"), False)
                     & (cur | prev))
    agg = sl.groupBy("artist_name").agg(_count_if(cur).alias("plays"),
                                         _count_if(prev).alias("prev_plays"))
    agg = agg.withColumn("growth", F.col("plays") - F.col("prev_plays"))
    return top_k(agg, [F.col("growth").desc(), F.col("plays").desc(),
                       F.col("artist_name").asc()], k)


def trending_songs(gold: DataFrame, as_of=None, window_hours: int = 48, k: int = 10) -> DataFrame:
    """Songs by the increase of plays in the last window ending at
    ``as_of`` (default: the latest event time) over the window before."""
    end = (gold.agg(F.max("event_timestamp").alias("t")).scalar() if as_of is None
           else F.lit(as_of).cast("timestamp"))
    span = F.make_dt_interval(F.lit(0), F.lit(window_hours))
    start = end - span
    before = start - span
    ts = F.col("event_timestamp")
    recent = (ts > start) & (ts <= end)
    older = (ts > before) & (ts <= start)
    sl = gold.filter(_is("PLAY") & _time_slice(before, end, True) & (recent | older))
    agg = sl.groupBy("song_name", "artist_name").agg(
        _count_if(recent).alias("recent_plays"), _count_if(older).alias("prev_plays"))
    agg = agg.select(song_label("song_name", "artist_name").alias("song"), "recent_plays",
                     "prev_plays",
                     (F.col("recent_plays") - F.col("prev_plays")).alias("trend"))
    return top_k(agg, [F.col("trend").desc(), F.col("recent_plays").desc(),
                       F.col("song").asc()], k)


def avg_duration(events: DataFrame) -> DataFrame:
    """Average listening duration (seconds) per event type, from the
    optional duration_seconds of the event messages."""
    return (events.groupBy("event_type")
                  .agg(F.count(F.lit(1)).alias("events"),
                       F.avg("duration_seconds").alias("avg_duration_seconds")))


def user_engagement(gold: DataFrame) -> DataFrame:
    """Per user plays, skips, likes, events, skip rate and distinct
    songs."""
    return gold.groupBy("user_id", "user_name").agg(
        _count_if(_is("PLAY")).alias("plays"),
        _count_if(_is("SKIP")).alias("skips"),
        _count_if(_is("LIKE")).alias("likes"),
        F.count(F.lit(1)).alias("events"),
        (_count_if(_is("SKIP")) / F.count(F.lit(1))).alias("skip_rate"),
        F.countDistinct("song_id").alias("distinct_songs"))


def hourly_pattern(gold: DataFrame) -> DataFrame:
    """Events and plays by hour of day."""
    return (gold.groupBy(F.hour("event_timestamp").alias("hour"))
                .agg(F.count(F.lit(1)).alias("events"), _count_if(_is("PLAY")).alias("plays"))
                .orderBy("hour"))


def country_activity(gold: DataFrame) -> DataFrame:
    """Plays and distinct listeners per country (PLAY only)."""
    return (gold.filter(_is("PLAY") & (F.col("country") != "")).groupBy("country")
                .agg(F.count(F.lit(1)).alias("plays"),
                     F.countDistinct("user_id").alias("listeners"))
                .orderBy(F.col("plays").desc(), "country"))


def platform_growth(gold: DataFrame) -> DataFrame:
    """New users per day (day of first event) and the running total.
    The running sum orders the per-day series (one row per day, bounded by
    the calendar), after users were reduced to their first day in a
    partially aggregated groupBy."""
    first = gold.groupBy("user_id").agg(F.min(_day()).alias("day"))
    daily = first.groupBy("day").agg(F.count(F.lit(1)).alias("new_users"))
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("total_users", F.sum("new_users").over(w)).orderBy("day")


def recommendation_engagement(recs: DataFrame, gold: DataFrame) -> DataFrame:
    """For each recommended label, how many users got it and how many
    of them played or liked it after it was first recommended to them. Only
    events after the oldest recommendation are read (months prune)."""
    r = (recs.select("user_id", "updated_at", F.explode("recommended_songs").alias("song"))
             .groupBy("user_id", "song").agg(F.min("updated_at").alias("updated_at")))
    oldest = recs.agg(F.min("updated_at").alias("t")).scalar()
    ev = (gold.filter((_is("PLAY") | _is("LIKE")) & (F.col("event_timestamp") > oldest)
                      & (F.col("event_month") >= event_month(oldest)))
              .groupBy("user_id", song_label("song_name", "artist_name").alias("song"))
              .agg(F.max("event_timestamp").alias("last_event")))
    j = r.join(ev, ["user_id", "song"], "left")
    engaged = F.col("last_event") > F.col("updated_at")
    agg = j.groupBy("song").agg(F.count(F.lit(1)).alias("recommended_users"),
                                _count_if(engaged).alias("engaged_users"))
    return (agg.withColumn("engagement_rate", F.col("engaged_users") / F.col("recommended_users"))
               .orderBy(F.col("recommended_users").desc(), "song"))


def recommendation_attribution(recs: DataFrame, gold: DataFrame, days: int = 30) -> DataFrame:
    """G13 by generation: every PLAY belongs to the list its user had at that
    moment (the newest one not after it). For each generation (updated_at):
    users who got a list, plays while it was in force, plays of a song on the
    list, users with such a play, and the share of such plays.

    The lists are validity intervals (:func:`operators.history.join_as_of`):
    an equi-join on user and time bucket, no window over a user's plays, so a
    user with very many plays is an ordinary skewed key. Plays before the first
    generation are not read (months prune)."""
    one = latest_per_key(recs.select("user_id", F.col("updated_at").alias("valid_from"), "recommended_songs"),
                         ["user_id", "valid_from"], [F.to_json("recommended_songs")])
    lists = one.withColumn("generation", F.col("valid_from")).withColumn(
        "valid_to", F.lead("valid_from").over(Window.partitionBy("user_id").orderBy("valid_from")))
    oldest = recs.agg(F.min("updated_at").alias("t")).scalar()
    plays = (gold.filter(_is("PLAY") & (F.col("event_timestamp") >= oldest)
                         & (F.col("event_month") >= event_month(oldest)))
             .select("user_id", "event_timestamp", song_label("song_name", "artist_name").alias("song")))
    hit = F.array_contains("recommended_songs", F.col("song"))
    heard = (join_as_of(plays, lists, "user_id", "event_timestamp", days).filter("generation is not null")
             .groupBy("generation", "user_id").agg(F.count("*").alias("plays"), _count_if(hit).alias("hits")))
    per = heard.groupBy("generation").agg(
        F.sum("plays").alias("plays"), F.sum("hits").alias("attributed_plays"),
        _count_if(F.col("hits") > 0).alias("attributed_users"))
    served = lists.groupBy("generation").agg(F.count("*").alias("users"))
    zero = F.lit(0).cast("long")
    return (served.join(per, "generation", "left").select(
        F.col("generation").alias("updated_at"), "users",
        *(F.coalesce(c, zero).alias(c) for c in ("plays", "attributed_plays", "attributed_users")),
        (F.coalesce("attributed_plays", zero) / F.col("plays")).alias("attributed_share"))
        .orderBy("updated_at"))


# Rules of the data-quality report (fixed names).
QUALITY_RULES = ["missing_required_fields", "malformed_message", "wrong_type", "bad_timestamp",
                 "unknown_event_type", "non_positive_user_id", "duplicate_event_id"]


def data_quality_report(parsed: DataFrame) -> DataFrame:
    """One row per rule with the number of messages checked and
    failing, over parsed (unsplit) bronze rows. One pass of conditional
    counts, plus the distinct-id count for duplicates."""
    ts_ok = F.try_to_timestamp(F.col("timestamp")).isNotNull()
    all_null = F.lit(True)
    for c in ["event_id", "user_id", "song_id", "timestamp", "event_type"]:
        all_null = all_null & F.col(c).isNull()
    agg = parsed.agg(
        F.count(F.lit(1)).alias("checked"),
        _count_if(F.col("event_id").isNull() | F.col("user_id").isNull()
                  | F.col("song_id").isNull()).alias("missing_required_fields"),
        _count_if(all_null).alias("malformed_message"),
        # The message has a user id, but not as a number.
        _count_if(F.col("user_id").isNull()
                  & F.get_json_object("raw_value", "$.user_id").isNotNull()).alias("wrong_type"),
        _count_if(~ts_ok).alias("bad_timestamp"),
        _count_if(~F.coalesce(F.col("event_type").isin(EVENT_TYPES), F.lit(False)))
        .alias("unknown_event_type"),
        _count_if(F.col("user_id") <= 0).alias("non_positive_user_id"),
        (F.count("event_id") - F.countDistinct("event_id")).alias("duplicate_event_id"),
    )
    stack = "stack({n}, {pairs}) as (rule, failed)".format(
        n=len(QUALITY_RULES),
        pairs=", ".join(f"'{r}', cast({r} as bigint)" for r in QUALITY_RULES))
    return agg.selectExpr("checked", stack).select("rule", "checked", "failed")
