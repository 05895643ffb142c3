"""Gold: typed, defaulted, second-precision rows in the analytical table's
column order, partitioned by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions import event_month, to_int, to_seconds, to_ts, with_default
from encore.functions.scalar import (
    DEFAULT_SUBSCRIPTION, DEFAULT_TEXT, DEFAULT_USER_NAME, MISSING_MARK,
)
from encore.schemas import GOLD_COLUMNS

# Storage order inside each month (the analytical table's sort key).
GOLD_SORT = ["event_type", "event_timestamp", "user_id"]


def standardize_gold(silver: DataFrame) -> DataFrame:
    """Casts, defaults and time parsing. Nulls in dimension attributes
    become Unknown / Free / Guest ('' is kept); a null event_type becomes
    'N/A'; times are parsed leniently (bad text -> null) and truncated to
    seconds; event_month = yyyymm of the event time. Columns that already
    have the target type are not re-parsed through text."""
    types = dict(silver.dtypes)

    def _int(c):
        return to_int(c) if types.get(c) == "string" else F.col(c).try_cast("int")

    def _ts(c):
        return to_ts(c) if types.get(c) == "string" else F.col(c).try_cast("timestamp")

    ts = to_seconds(_ts("event_timestamp"))
    out = silver.select(
        F.col("event_id").cast("string").alias("event_id"),
        _int("user_id").alias("user_id"),
        with_default("user_name", DEFAULT_USER_NAME).alias("user_name"),
        F.col("song_id").cast("string").alias("song_id"),
        with_default("song_name", DEFAULT_TEXT).alias("song_name"),
        with_default("artist_name", DEFAULT_TEXT).alias("artist_name"),
        with_default("genre", DEFAULT_TEXT).alias("genre"),
        with_default("subscription_type", DEFAULT_SUBSCRIPTION).alias("subscription_type"),
        with_default("country", DEFAULT_TEXT).alias("country"),
        with_default(F.col("event_type").cast("string"), MISSING_MARK).alias("event_type"),
        ts.alias("event_timestamp"),
        to_seconds(_ts("processed_at")).alias("processed_at"),
    )
    return out.withColumn("event_month", event_month("event_timestamp"))


def split_gold(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loadable, rejected): rows without event_id are dropped, rows whose
    time did not parse go to the reject output instead of spoiling a load."""
    keyed = df.filter(F.col("event_id").isNotNull())
    ok = keyed.filter(F.col("event_timestamp").isNotNull())
    rejected = keyed.filter(F.col("event_timestamp").isNull())
    return ok, rejected


def gold_layout(df: DataFrame) -> DataFrame:
    """Physical order for a write: the month partition column last and rows
    sorted by the sort key inside each task (no shuffle)."""
    return df.select(*GOLD_COLUMNS, "event_month").sortWithinPartitions("event_month", *GOLD_SORT)
