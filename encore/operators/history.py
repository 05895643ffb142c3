"""Point-in-time dimensions (J1, J2, P6 over time): validity intervals built
from all landed versions, and a join that gives each event the version that
was valid at its own time, however late the event or the version arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.functions import to_int, to_ts
from encore.operators.bronze import _as_of
from encore.operators.dims import latest_per_key

USER_ATTRIBUTES = ["user_name", "country", "subscription_type"]
SONG_ATTRIBUTES = ["song_name", "artist_name", "genre"]
DAY = 86400


def build_history(landing: DataFrame, key: str, attributes: list[str],
                  since: str = "ingested_at") -> DataFrame:
    """key, attributes, valid_from, valid_to (null: valid until further notice).

    One row per change: versions that repeat their predecessor's attributes
    extend it. Of several versions of a key at one instant the first by its
    attributes counts (deterministic). Rows without key or landing time are
    left out. The windows run over one key's versions, so their groups are
    bounded by the number of landings."""
    rows = (landing.select(key, *attributes, to_ts(since).alias("valid_from"))
            .filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()))
    rows = latest_per_key(rows, [key, "valid_from"], [F.col(a).asc_nulls_last() for a in attributes])
    w = Window.partitionBy(key).orderBy("valid_from")
    state = F.struct(*attributes)
    changed = (rows.withColumn("_before", F.lag(state).over(w))
               .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(state)).drop("_before"))
    return changed.withColumn("valid_to", F.lead("valid_from").over(w))


def user_history(users: DataFrame) -> DataFrame:
    """Users landing (every landed version) -> history of dim_users."""
    return build_history(users.withColumn("user_id", to_int("user_id")), "user_id", USER_ATTRIBUTES)


def song_history(songs: DataFrame) -> DataFrame:
    """Songs landing (every landed version) -> history of dim_songs."""
    return build_history(songs.withColumn("song_id", F.trim("song_id")), "song_id", SONG_ATTRIBUTES)


def current(history: DataFrame) -> DataFrame:
    """The versions still valid: what the SCD type 1 dimension holds."""
    return history.filter("valid_to is null").drop("valid_from", "valid_to")


def _bucket(at: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(at.cast("timestamp")) / (days * DAY)).cast("long")


def time_span(rows: DataFrame, at: str) -> tuple[Column, Column]:
    """First and last time of the rows: one pass over one column."""
    ends = rows.agg(F.struct(F.min(at).alias("first"), F.max(at).alias("last")).alias("ends")).scalar()
    return ends.getField("first"), ends.getField("last")


def join_as_of(rows: DataFrame, history: DataFrame, key: str, at: str, days: int = 30,
               span: tuple | None = None) -> DataFrame:
    """Left join of ``rows`` to the version valid at ``rows[at]``
    (valid_from <= at < valid_to); the history's other columns are appended.

    An equi-join on the key and a time bucket of ``days`` days, with the
    interval as the remaining condition: no cross join, and a row meets only
    the versions of its key that touch its bucket. A version is repeated for
    each bucket it touches within ``span`` (first and last time of the rows;
    found by one pass over the time column when not given), so a long validity
    costs one row per bucket, and many short ones stay apart. Intervals of a
    key do not overlap, so at most one version fits. Strategy and skewed keys
    are left to Catalyst and AQE (the row side may be split)."""
    first, last = time_span(rows, at) if span is None else map(F.lit, span)
    begin = F.greatest(F.col("valid_from"), first.cast("timestamp"))
    end = F.least(F.coalesce("valid_to", last.cast("timestamp")), last.cast("timestamp"))
    versions = (history.filter((F.col("valid_from") <= last)
                               & (F.col("valid_to").isNull() | (F.col("valid_to") > first)))
                .withColumn("_bucket", F.explode(F.sequence(_bucket(begin, days), _bucket(end, days))))
                .withColumnRenamed(key, "_key"))
    rows = rows.withColumn("_row_bucket", _bucket(F.col(at), days))
    fits = ((F.col(key) == F.col("_key")) & (F.col("_row_bucket") == F.col("_bucket"))
            & (F.col(at) >= F.col("valid_from"))
            & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))))
    return rows.join(versions, fits, "left").drop(
        "_row_bucket", "_bucket", "_key", "valid_from", "valid_to")


def enrich_as_of(events: DataFrame, users: DataFrame, songs: DataFrame, as_of=None,
                 days: int = 30, span: tuple | None = None) -> DataFrame:
    """Silver rows as :func:`operators.enrich.enrich` makes them, but with the
    user and song as they were at the time of the event. Events before the
    first version, after none, or without a readable time get null attributes
    (Guest / Unknown in gold)."""
    e = events.select("event_id", "user_id", "song_id", F.col("timestamp").alias("event_timestamp"),
                      "event_type", to_ts("timestamp").alias("_at"), F.trim("song_id").alias("_song"))
    span = time_span(e, "_at") if span is None else span
    j = join_as_of(e, users, "user_id", "_at", days, span)
    j = join_as_of(j, songs.withColumnRenamed("song_id", "_song"), "_song", "_at", days, span)
    return j.select("event_id", "user_id", "song_id", "user_name", "song_name", "artist_name", "genre",
                    "event_timestamp", "event_type", "subscription_type", "country",
                    _as_of(as_of).alias("processed_at"))
