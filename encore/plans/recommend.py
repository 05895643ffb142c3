"""Per-country song recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions import song_label
from encore.operators.bronze import _as_of
from encore.operators.topn import top_n_per_group
from encore.plans.dashboard import latest_recommendations



def _play_order() -> list:
    return [F.col("plays").desc(), F.col("song_name").asc(), F.col("artist_name").asc()]


def active_users(gold: DataFrame) -> DataFrame:
    """Distinct (user_id, user_name, country) with user_id > 0 and a
    non-empty name."""
    # dropDuplicates over all columns: the same plan as distinct() in batch,
    # and a supported (append-mode) deduplication on a stream.
    return (gold.filter((F.col("user_id") > 0) & (F.col("user_name") != ""))
                .select("user_id", "user_name", "country").dropDuplicates())


def plays_by_country(gold: DataFrame) -> DataFrame:
    """R2: PLAY count per (country, song_name, artist_name), song_name != ''."""
    return (gold.filter((F.col("event_type") == "PLAY") & (F.col("song_name") != ""))
                .groupBy("country", "song_name", "artist_name")
                .agg(F.count(F.lit(1)).alias("plays")))


def _label_list(key_cols: list) -> F.Column:
    """Ordered array of labels from rows carrying the sort key columns."""
    return F.transform(
        F.sort_array(F.collect_list(F.struct(*key_cols, F.col("label")))),
        lambda x: x["label"])


def recommend(gold: DataFrame, n: int = 3, fallback: str = "first_country",
              as_of=None) -> DataFrame:
    """R3 over the gold table: :func:`recommend_from` of its play counts
    (R2) and active users (R1)."""
    return recommend_from(plays_by_country(gold), active_users(gold), n=n, fallback=fallback,
                          as_of=as_of)


def recommend_from(plays: DataFrame, users: DataFrame, n: int = 3,
                   fallback: str = "first_country", as_of=None) -> DataFrame:
    """For each active user the top n songs of their country; users whose
    country has no plays get the fallback list. ``fallback="first_country"``
    is the first n rows of the (country, plays desc) ranking, i.e. the top of
    the alphabetically first country; ``"global"`` is the overall top n.
    No output when there are no users or no plays.

    ``plays`` holds PLAY counts per (country, song_name, artist_name) and
    ``users`` the distinct (user_id, user_name, country) rows: computed from
    gold, or kept current per micro-batch by
    ``streaming.pipeline.run_recommendation_inputs`` so that this job reads
    tables sized by songs and users instead of the event history.

    Plan: a partial+final window group limit for the per-country top n,
    one small array per country joined to the users, and the fallback as a
    one-row scalar subquery (bounded to one array of n labels) -- no cross
    join, nothing collected to the driver.
    """
    # Gold's country is never null; stating it makes the ranking branch (where
    # the join would infer it) and the fallback branch the same plan, so the
    # play counts are computed once and their shuffle reused.
    plays = (plays.filter(F.col("country").isNotNull())
                  .withColumn("label", song_label("song_name", "artist_name")))
    top = top_n_per_group(plays, ["country"], _play_order(), n)
    per_country = top.groupBy("country").agg(
        _label_list(["rank"]).alias("country_songs"))
    neg = (-F.col("plays")).alias("neg_plays")
    if fallback == "first_country":
        head = plays.orderBy(F.col("country").asc(), *_play_order()).limit(n)
        fb = head.agg(_label_list(["country", neg, "song_name", "artist_name"]).alias("a"))
    elif fallback == "global":
        tot = plays.groupBy("song_name", "artist_name", "label").agg(F.sum("plays").alias("plays"))
        head = tot.orderBy(*_play_order()).limit(n)
        fb = head.agg(_label_list([neg, "song_name", "artist_name"]).alias("a"))
    else:
        raise ValueError(f"unknown fallback {fallback!r}")
    recs = users.join(per_country, "country", "left").select(
        F.col("user_id").cast("int").alias("user_id"), "user_name",
        F.coalesce(F.col("country_songs"), fb.scalar()).alias("recommended_songs"),
        _as_of(as_of).alias("updated_at"))
    return recs.filter(F.size("recommended_songs") > 0)


def recommendation_rows(recs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Recommendations exploded to (user_id, user_name, rank, song), plus
    the ``keep`` columns of each list (e.g. updated_at)."""
    return recs.select("user_id", "user_name",
                       F.posexplode("recommended_songs").alias("pos", "song"), *keep).select(
        "user_id", "user_name", (F.col("pos") + 1).alias("rank"), "song", *keep)


__all__ = ["active_users", "plays_by_country", "recommend", "recommend_from",
           "recommendation_rows",
           "latest_recommendations"]
