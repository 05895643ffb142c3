"""The medallion chain as one lazy plan over input frames:
messages -> bronze (valid / invalid) -> dims -> silver -> gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from encore.operators.bronze import bronze
from encore.operators.dims import build_dim_songs, build_dim_users
from encore.operators.enrich import enrich
from encore.operators.gold import standardize_gold, split_gold
from encore.sources import fixtures

# Fixed processing time used by registered queries so results are
# reproducible (wall-clock columns are otherwise current_timestamp()).
FIXED_AS_OF = "2024-02-01 00:00:00"


@dataclass
class Lake:
    messages: DataFrame
    valid: DataFrame
    invalid: DataFrame
    dim_users: DataFrame
    dim_songs: DataFrame
    silver: DataFrame
    gold: DataFrame
    gold_rejects: DataFrame


def build(messages: DataFrame, users_landing: DataFrame, songs_landing: DataFrame,
          as_of=None) -> Lake:
    valid, invalid = bronze(messages, as_of=as_of)
    dim_users = build_dim_users(users_landing)
    dim_songs = build_dim_songs(songs_landing)
    silver = enrich(valid, dim_users, dim_songs, as_of=as_of)
    gold, rejects = split_gold(standardize_gold(silver))
    return Lake(messages, valid, invalid, dim_users, dim_songs, silver, gold, rejects)


def from_tables(spark: SparkSession, sf_dir: str, as_of=FIXED_AS_OF) -> Lake:
    """The chain over the driver's test tables (see sources.fixtures)."""
    return build(fixtures.event_messages(spark, sf_dir),
                 fixtures.users_landing(spark, sf_dir),
                 fixtures.songs_landing(spark, sf_dir), as_of=as_of)
