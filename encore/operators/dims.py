"""Silver dimensions: projection, deterministic de-duplication and keyed
upsert with atomic publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions import to_int
from encore.sinks.tables import publish_version, resolve_current, table_exists


def latest_per_key(df: DataFrame, keys: list[str], order: list, tie_break: list | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order`` (give descending columns
    for "latest"), then by ``tie_break``. A window with a row_number = 1
    filter; Spark plans it with a partial group limit before the shuffle,
    so a hot key sends at most one row per map partition."""
    w = Window.partitionBy(*keys).orderBy(*order, *(tie_break or []))
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1).drop("_rn"))


def build_dim_songs(songs: DataFrame) -> DataFrame:
    """songs landing -> dim_songs(song_id trimmed, song_name, artist_name,
    genre). Null keys are dropped; duplicates keep the newest ingested_at,
    ties broken on the remaining columns (deterministic)."""
    proj = songs.select(
        F.trim("song_id").alias("song_id"), "song_name", "artist_name", "genre",
        F.col("ingested_at"),
    ).filter(F.col("song_id").isNotNull())
    out = latest_per_key(
        proj, ["song_id"], [F.col("ingested_at").desc_nulls_last()],
        [F.col("song_name").asc_nulls_last(), F.col("artist_name").asc_nulls_last(),
         F.col("genre").asc_nulls_last()])
    return out.drop("ingested_at")


def build_dim_users(users: DataFrame) -> DataFrame:
    """users landing -> dim_users(user_id int, user_name, country,
    subscription_type, is_current=true). SCD type 1: one current row."""
    proj = users.select(
        to_int("user_id").alias("user_id"), "user_name", "country", "subscription_type",
        F.lit(True).alias("is_current"), F.col("ingested_at"),
    ).filter(F.col("user_id").isNotNull())
    out = latest_per_key(
        proj, ["user_id"], [F.col("ingested_at").desc_nulls_last()],
        [F.col("user_name").asc_nulls_last(), F.col("country").asc_nulls_last(),
         F.col("subscription_type").asc_nulls_last()])
    return out.drop("ingested_at")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Merge by key: matched rows take the source row, new keys are
    inserted, target-only rows are kept, nothing is deleted. ``source`` must
    have unique, non-null keys (the dimension builders guarantee it)."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def upsert_table(source: DataFrame, path: str, keys: list[str]) -> str:
    """Upsert into the versioned table at ``path`` (first load when absent)
    and publish the result as a new version. Returns the version path."""
    spark = source.sparkSession
    if table_exists(spark, path):
        target = spark.read.parquet(resolve_current(spark, path))
        merged = upsert(target, source.select(*target.columns), keys)
    else:
        merged = source
    return publish_version(merged, path)
