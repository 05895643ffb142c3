"""Chart track normalisation into the songs landing shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions import album_name, non_empty, track_id


def explode_pages(pages: DataFrame) -> DataFrame:
    """One row per track of nested chart pages."""
    return pages.select(F.explode("tracks.track").alias("t")).select("t.*")


def normalize_tracks(tracks: DataFrame, ingested_at=None) -> DataFrame:
    """Skip tracks whose name or artist name is missing or empty; derive a
    stable song_id, the single's album name and the landing columns.
    genre and duration are not part of the chart payload: null here."""
    ok = tracks.filter(non_empty("name") & non_empty(F.col("artist.name")))
    ts = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return ok.select(
        track_id(F.col("mbid"), F.col("name"), F.col("artist.name")).alias("song_id"),
        F.col("name").alias("song_name"),
        F.col("artist.name").alias("artist_name"),
        album_name("name").alias("album_name"),
        F.lit(None).cast("long").alias("duration_ms"),
        F.lit(None).cast("string").alias("genre"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
    )
