"""Silver: stream-static enrichment of valid events with the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.bronze import _as_of
from encore.operators.skew import find_hot_keys


def enrich(events: DataFrame, users: DataFrame, songs: DataFrame, as_of=None,
           split_hot_keys: bool = False, max_hot_keys: int = 1000,
           min_hot_rows: int = 1_000_000, broadcast_dims: frozenset = frozenset()) -> DataFrame:
    """Left-join events to dim_users on user_id and to dim_songs on the
    trimmed song id; every event is kept (unmatched -> null attributes).

    The join strategy is left to Catalyst: a dimension below the broadcast
    threshold (by its file statistics, or by its measured shuffle size under
    AQE) is broadcast, a larger one is joined by sort-merge on the key, with
    AQE splitting skewed (hot) event partitions. The song dimension is
    already trimmed when built, so only the event side is trimmed; the key
    expression is still an equi-join key. The event's own song_id is kept
    untrimmed in the output.

    ``split_hot_keys`` joins keys holding a large share of the events
    through a bounded broadcast (see ``operators.skew``); use it where AQE
    cannot split a skewed join, e.g. against a cached, pre-partitioned
    dimension.

    ``broadcast_dims`` names the dimensions ("users", "songs") the caller
    has checked to be small (e.g. by their row count); they are broadcast,
    which leaves no shuffle to skew, so no hot-key pass runs for them.
    """
    if split_hot_keys:
        return _enrich_split(events, users, songs, as_of, max_hot_keys, min_hot_rows,
                             broadcast_dims)
    e = events.alias("e")
    u = _dim_users(users, broadcast_dims).alias("u")
    s = _dim_songs(songs, broadcast_dims, "s_song_id").alias("s")
    j = (e.join(u, F.col("e.user_id") == F.col("u.user_id"), "left")
          .join(s, F.trim(F.col("e.song_id")) == F.col("s.s_song_id"), "left"))
    return j.select(
        F.col("e.event_id").alias("event_id"),
        F.col("e.user_id").alias("user_id"),
        F.col("e.song_id").alias("song_id"),
        F.col("u.user_name").alias("user_name"),
        F.col("s.song_name").alias("song_name"),
        F.col("s.artist_name").alias("artist_name"),
        F.col("s.genre").alias("genre"),
        F.col("e.timestamp").alias("event_timestamp"),
        F.col("e.event_type").alias("event_type"),
        F.col("u.subscription_type").alias("subscription_type"),
        F.col("u.country").alias("country"),
        _as_of(as_of).alias("processed_at"),
    )


def _dim_users(users: DataFrame, broadcast_dims) -> DataFrame:
    u = users.select("user_id", "user_name", "subscription_type", "country")
    return F.broadcast(u) if "users" in broadcast_dims else u


def _dim_songs(songs: DataFrame, broadcast_dims, key: str) -> DataFrame:
    s = songs.select(F.col("song_id").alias(key), "song_name", "artist_name", "genre")
    return F.broadcast(s) if "songs" in broadcast_dims else s


def _enrich_split(events, users, songs, as_of, max_hot_keys, min_rows,
                  broadcast_dims=frozenset()) -> DataFrame:
    """Hot-key-split form of :func:`enrich`.

    Hot user ids and hot song keys are found in one pass (bounded lists,
    see ``operators.skew``); a broadcast dimension needs no such pass.
    Without hot keys this is the plain plan. With them, events are split by
    two ``isin`` flags; each class reads the input once and takes, per
    dimension, the partitioned join (cold keys) or a broadcast of the few
    hot dimension rows. No join output is recomputed.
    """
    sk = F.trim(F.col("song_id"))
    probe = {}
    if "users" not in broadcast_dims:
        probe["u"] = F.col("user_id")
    if "songs" not in broadcast_dims:
        probe["s"] = sk
    hot = find_hot_keys(events, probe, max_hot_keys, min_rows) if probe else {}
    hot = {"u": hot.get("u", []), "s": hot.get("s", [])}
    if not hot["u"] and not hot["s"]:
        return enrich(events, users, songs, as_of=as_of, broadcast_dims=broadcast_dims)
    ev = events.select(
        "event_id", "user_id", "song_id", F.col("timestamp").alias("event_timestamp"),
        "event_type", sk.alias("_sk"))
    u = _dim_users(users, broadcast_dims)
    s = _dim_songs(songs, broadcast_dims, "_sk")
    hu = F.coalesce(F.col("user_id").cast("string").isin(hot["u"]), F.lit(False))
    hs = F.coalesce(F.col("_sk").isin(hot["s"]), F.lit(False))
    u_hot = F.broadcast(u.filter(F.col("user_id").cast("string").isin(hot["u"])))
    s_hot = F.broadcast(s.filter(F.col("_sk").isin(hot["s"])))
    parts = []
    for user_hot in ([False, True] if hot["u"] else [False]):
        for song_hot in ([False, True] if hot["s"] else [False]):
            part = ev.filter((hu == F.lit(user_hot)) & (hs == F.lit(song_hot)))
            part = part.join(u_hot if user_hot else u, "user_id", "left")
            part = part.join(s_hot if song_hot else s, "_sk", "left")
            parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(
        "event_id", "user_id", "song_id", "user_name", "song_name", "artist_name", "genre",
        "event_timestamp", "event_type", "subscription_type", "country",
        _as_of(as_of).alias("processed_at"))
