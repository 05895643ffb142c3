"""J3 backwards: when a dimension changes after events were loaded (a late
user, a corrected song), only the gold months that hold affected events are
written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import schemas
from encore.functions import with_default
from encore.functions.scalar import DEFAULT_SUBSCRIPTION, DEFAULT_TEXT, DEFAULT_USER_NAME
from encore.operators.bronze import _as_of
from encore.operators.gold import gold_layout
from encore.operators.history import SONG_ATTRIBUTES, USER_ATTRIBUTES
from encore.sinks import fs

#: What gold shows where a dimension has nothing (fixed values of the contract).
_DEFAULTS = {"user_name": DEFAULT_USER_NAME, "subscription_type": DEFAULT_SUBSCRIPTION}


def dimension_changes(old: DataFrame, new: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Keys whose attributes differ between two versions of a dimension, with
    the new attributes and change: ``insert``, ``update`` or ``delete`` (null
    attributes). A full join on the key; equal rows go no further."""
    a = old.select(F.col(key).alias("_old_key"), F.struct(*attributes).alias("_old"))
    b = new.select(F.col(key).alias("_new_key"), F.struct(*attributes).alias("_new"))
    j = a.join(b, F.col("_old_key") == F.col("_new_key"), "full").filter(
        F.col("_old_key").isNull() | F.col("_new_key").isNull() | ~F.col("_old").eqNullSafe(F.col("_new")))
    change = (F.when(F.col("_old_key").isNull(), "insert").when(F.col("_new_key").isNull(), "delete")
              .otherwise("update"))
    return j.select(F.coalesce("_old_key", "_new_key").alias(key), "_new.*", change.alias("change"))


def _marked(gold: DataFrame, users: DataFrame, songs: DataFrame) -> DataFrame:
    """Gold with the changed attributes (struct ``_u``, ``_s``; null where the
    row's key did not change)."""
    u = users.select(F.col("user_id").alias("_user"), F.struct(*USER_ATTRIBUTES).alias("_u"))
    s = songs.select(F.col("song_id").alias("_song"), F.struct(*SONG_ATTRIBUTES).alias("_s"))
    return (gold.join(u, F.col("user_id") == F.col("_user"), "left")
            .join(s, F.trim(F.col("song_id")) == F.col("_song"), "left")
            .withColumn("_changed", F.col("_user").isNotNull() | F.col("_song").isNotNull()))


def affected_months(gold: DataFrame, users: DataFrame, songs: DataFrame) -> dict[int, int]:
    """event_month -> rows of changed users or songs. Reads the two keys and
    the month; the answer has one row per month."""
    keys = gold.select("event_month", "user_id", "song_id")
    hit = _marked(keys, users, songs).filter("_changed").groupBy("event_month").count().collect()
    return {r["event_month"]: r["count"] for r in hit}


def refresh(gold: DataFrame, users: DataFrame, songs: DataFrame, as_of=None) -> DataFrame:
    """Gold rows with the attributes of changed users and songs replaced and
    processed_at renewed; all other rows are as they were."""
    m = _marked(gold, users, songs)

    def value(name: str) -> Column:
        key, new = ("_user", "_u") if name in USER_ATTRIBUTES else ("_song", "_s")
        fresh = with_default(f"{new}.{name}", _DEFAULTS.get(name, DEFAULT_TEXT))
        return F.when(F.col(key).isNotNull(), fresh).otherwise(F.col(name)).alias(name)

    shown = set(USER_ATTRIBUTES + SONG_ATTRIBUTES)
    return m.select(*(
        value(c) if c in shown else
        F.when(F.col("_changed"), _as_of(as_of)).otherwise(F.col(c)).alias(c) if c == "processed_at" else
        F.col(c) for c in gold.columns))


def backfill_gold(spark: SparkSession, path: str, users: DataFrame, songs: DataFrame, as_of=None) -> list[int]:
    """Bring month-partitioned gold at ``path`` up to date with changed users
    and songs (:func:`dimension_changes`) and return the months rewritten.
    Other months keep their files.

    The new months are first written whole beside the table (``_backfill``,
    unseen by readers), then put in place of the old ones by a dynamic
    partition overwrite. A run that dies in between is finished by the next
    one from the same files; refreshing is repeatable. Loads into the months
    must not run at the same time."""
    path = path.rstrip("/")
    stage = f"{path}/_backfill"
    if not fs.exists(spark, f"{stage}/_SUCCESS"):
        gold = spark.read.schema(schemas.GOLD).parquet(path)
        months = sorted(affected_months(gold, users, songs))
        if not months:
            return []
        rows = refresh(gold.filter(F.col("event_month").isin(months)), users, songs, as_of)
        gold_layout(rows).write.mode("overwrite").partitionBy("event_month").parquet(stage)
    ready = spark.read.schema(schemas.GOLD).parquet(stage)
    months = sorted(int(d.split("=")[1]) for d in fs.list_dirs(spark, stage) if d.startswith("event_month="))
    (gold_layout(ready).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_month").parquet(path))
    fs.delete(spark, stage)
    return months
