"""Bronze: parse raw messages, flag and split valid / invalid events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore import schemas

# Fixed values of the bronze contract.
SOURCE_NAME = "kafka_music_events"
ERROR_MISSING_FIELDS = "MISSING_REQUIRED_FIELDS"
REQUIRED_FIELDS = ["event_id", "user_id", "song_id"]


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(as_of).cast("timestamp")


def parse_events(raw: DataFrame, source: str = SOURCE_NAME, as_of=None,
                 schema=schemas.EVENT_MESSAGE, keep_raw: bool = True) -> DataFrame:
    """Binary/text ``value`` -> flat event columns (permissive JSON parse:
    malformed text gives null fields), plus ingestion_time and source.

    ``keep_raw`` keeps the message text as ``raw_value`` so quarantined rows
    still carry their payload; it is dropped from the valid branch. An empty
    event_type is normalised to null, the value a partitioned bronze table
    reads back for it, so batch and stream paths agree.
    """
    text = F.col("value").cast("string")
    fields = [F.from_json(text, schema).alias("data")]
    if keep_raw:
        fields.append(text.alias("raw_value"))
    # The parse sits inside a generator (one output row per message) so that
    # filters on the parsed fields stay above it: pushed below a plain
    # projection they would inline (and re-run) the JSON parse once per
    # referenced field.
    parsed = raw.select(F.inline(F.array(F.struct(*fields))))
    out = parsed.select(
        *[F.col(f"data.{f.name}").alias(f.name) for f in schema.fields],
        *(["raw_value"] if keep_raw else []),
    ).withColumn("event_type", F.when(F.col("event_type") != "", F.col("event_type")))
    return (out.withColumn("ingestion_time", _as_of(as_of))
               .withColumn("source", F.lit(source)))


def flag_valid(df: DataFrame) -> DataFrame:
    """is_valid = all required fields present (never null). '' counts as
    present; timestamp and event_type are not checked."""
    cond = F.lit(True)
    for c in REQUIRED_FIELDS:
        cond = cond & F.col(c).isNotNull()
    out = df.withColumn("is_valid", cond)
    if "raw_value" in df.columns:
        # Only quarantined rows keep their payload, so a cached batch does
        # not hold the message text of every valid event.
        out = out.withColumn("raw_value", F.when(~F.col("is_valid"), F.col("raw_value")))
    return out


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) branches of a flagged frame; disjoint and together
    exhaustive. Valid drops the flag (and raw payload); invalid keeps the flag
    and gets an error_type."""
    flagged = df if "is_valid" in df.columns else flag_valid(df)
    valid = flagged.filter(F.col("is_valid")).drop("is_valid", "raw_value")
    invalid = (flagged.filter(~F.col("is_valid"))
               .withColumn("error_type", F.lit(ERROR_MISSING_FIELDS)))
    return valid, invalid


def bronze(raw: DataFrame, as_of=None, source: str = SOURCE_NAME,
           schema=schemas.EVENT_MESSAGE) -> tuple[DataFrame, DataFrame]:
    """parse -> flag -> split in one call."""
    return split_valid(flag_valid(parse_events(raw, source=source, as_of=as_of, schema=schema)))
