"""Registered streaming plans: each runs its streaming queries to
completion (availableNow) over inputs Spark derives from the test tables,
in a fresh folder under the shared checkpoint directory, and returns the
resulting table as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore import schemas
from encore.operators.bronze import bronze
from encore.operators.dims import build_dim_songs, build_dim_users, latest_per_key, upsert_table
from encore.plans import lake
from encore.session import scratch_path
from encore.sinks import writers
from encore.sources import fixtures
from encore.sources.readers import event_stream, stream_table
from encore.streaming.pipeline import (
    LakePaths, dedupe_events, read_recommendation_inputs, refuse_late_rows, run_pipeline,
    run_recommendation_inputs, stream_listening_trend,
)

AVAILABLE_NOW = {"availableNow": True}


def land_messages(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Publish the test events as JSON text messages (one per line)."""
    writers.publish_messages(fixtures.event_messages(spark, sf_dir), path)
    return path


def streaming_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages -> bronze (two queries) -> silver (dimension versions
    resolved per batch) -> gold (exactly-once batch publication)."""
    paths = LakePaths(scratch_path(spark, "lake"))
    msgs = land_messages(spark, sf_dir, f"{paths.root}/landing/messages")
    upsert_table(build_dim_users(fixtures.users_landing(spark, sf_dir)), paths.dim_users,
                 ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, sf_dir)), paths.dim_songs,
                 ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 4})
    run_pipeline(spark, raw, paths, trigger=AVAILABLE_NOW, as_of=lake.FIXED_AS_OF,
                 single_read=True)
    gold_schema = T.StructType(schemas.GOLD.fields + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(gold_schema).parquet(paths.gold).drop("processed_at", "batch_id")


def streaming_trend(spark: SparkSession, sf_dir: str, interval: str = "1 hour") -> DataFrame:
    """Windowed counts in update mode; every update is appended with its
    batch id and the current value per window is the latest update. The files
    hold any time, so no watermark: every row counts in every file layout."""
    root = scratch_path(spark, "trend")
    g = lake.from_tables(spark, sf_dir).gold
    g.write.partitionBy("event_month").parquet(f"{root}/gold")
    src = stream_table(spark, f"{root}/gold", schemas.GOLD, max_files=2)
    counts = stream_listening_trend(src, interval)

    def _batch(df: DataFrame, batch_id: int) -> None:
        writers.publish_batch(df, f"{root}/updates", batch_id)

    q = (counts.writeStream.outputMode("update").foreachBatch(_batch)
               .option("checkpointLocation", f"{root}/_ckpt").trigger(**AVAILABLE_NOW).start())
    q.awaitTermination()
    upd = spark.read.parquet(f"{root}/updates")
    cur = latest_per_key(upd, ["time", "event_type"], [F.col("batch_id").desc()])
    return cur.select("time", "event_type", "count")


def streaming_dedupe(spark: SparkSession, sf_dir: str, delay: str = "62 days") -> DataFrame:
    """Valid events with repeated event ids removed within the
    watermark delay. A part of the messages is published twice. Each landed
    file may hold any time of the landed period, so the delay covers it; rows
    that still come later fail the query instead of going missing."""
    root = scratch_path(spark, "dedupe")
    msgs = f"{root}/messages"
    writers.publish_messages(fixtures.event_messages(spark, sf_dir).unionByName(
        fixtures.repeated_messages(spark, sf_dir)), msgs)
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 4})
    valid, _ = bronze(raw, as_of=lake.FIXED_AS_OF)
    ev = valid.withColumn("event_time", F.try_to_timestamp("timestamp"))
    out = dedupe_events(ev, delay, "event_time").select(
        "event_id", "user_id", "song_id", "timestamp", "event_type")
    q = (out.writeStream.format("parquet").option("checkpointLocation", f"{root}/_ckpt")
            .trigger(**AVAILABLE_NOW).start(f"{root}/out"))
    q.awaitTermination()
    refuse_late_rows(q)
    return spark.read.parquet(f"{root}/out")


def streaming_sessions(spark: SparkSession, sf_dir: str, delay: str = "62 days") -> DataFrame:
    """G10 as a stream: sessions given out as the watermark passes them. The
    landed files hold any time, so the delay covers the period; a last event of
    user -1, a year later, lets the watermark pass every real session."""
    from encore.operators.gold import gold_layout
    from encore.operators.sessions import stream_sessions

    root = scratch_path(spark, "sessions")
    g = lake.from_tables(spark, sf_dir).gold
    gold_layout(g).write.partitionBy("event_month").parquet(f"{root}/gold")
    end = g.agg(F.max("event_timestamp").alias("event_timestamp")).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("user_id", "event_timestamp", "event_month")
          else F.lit(-1).alias("user_id") if f.name == "user_id"
          else (F.col("event_timestamp") + F.expr("interval 365 days")).alias("event_timestamp")
          if f.name == "event_timestamp" else F.lit(999912).alias("event_month") for f in schemas.GOLD.fields))
    end.coalesce(1).write.mode("append").partitionBy("event_month").parquet(f"{root}/gold")
    src = stream_table(spark, f"{root}/gold", schemas.GOLD, max_files=2)
    q = (stream_sessions(src, delay=delay).writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{root}/_ckpt").trigger(**AVAILABLE_NOW).start(f"{root}/out"))
    q.awaitTermination()
    refuse_late_rows(q)
    return spark.read.parquet(f"{root}/out").filter("user_id <> -1")


def land_disordered(spark: SparkSession, sf_dir: str, path: str, files: int = 12) -> None:
    """The test messages and the repeated ones in files of rising time, every
    message up to three days later than its own, a repeat up to twelve."""
    both = (fixtures.event_messages(spark, sf_dir).withColumn("days", F.lit(3))
            .unionByName(fixtures.repeated_messages(spark, sf_dir).withColumn("days", F.lit(12))))
    at = (F.unix_timestamp(F.get_json_object(F.col("value").cast("string"), "$.timestamp"))
          + F.pmod(F.xxhash64("value", "days"), F.lit(86400) * F.col("days")))
    (both.select("value", at.alias("at")).repartitionByRange(files, "at").select(F.col("value").cast("string"))
     .write.text(path))


def streaming_late_rows(spark: SparkSession, sf_dir: str, delay: str = "1 day", max_files: int = 3) -> DataFrame:
    """X10 without losses: disordered and repeated messages, a delay shorter
    than the disorder. First arrivals and late rows go to two tables, the late
    ones that are no repeats are settled, and together they are every event
    once."""
    from encore.streaming.late import run_first_arrivals, settle_late

    paths = LakePaths(scratch_path(spark, "late"))
    msgs = f"{paths.root}/landing/messages"
    land_disordered(spark, sf_dir, msgs)
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": max_files})
    valid, _ = bronze(raw, as_of=lake.FIXED_AS_OF)
    run_first_arrivals(valid, paths, delay, AVAILABLE_NOW, buckets=64).awaitTermination()
    settle_late(spark, paths)
    return spark.read.schema(schemas.BRONZE_VALID).parquet(paths.bronze_unique).select(
        "event_id", "user_id", "song_id", "timestamp", "event_type")


def recommendations_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1-R3 from streamed inputs: gold (built from the test tables and
    written month-partitioned) is read as a stream in several micro-batches;
    stateful queries keep the play counts and active users current, and the
    recommendation plan runs on those two tables. Equal to the batch
    recommendations over the same gold."""
    from encore.operators.gold import gold_layout
    from encore.plans.recommend import recommend_from, recommendation_rows

    root = scratch_path(spark, "recinputs")
    gold_layout(lake.from_tables(spark, sf_dir).gold).write.partitionBy("event_month").parquet(
        f"{root}/gold")
    src = stream_table(spark, f"{root}/gold", schemas.GOLD, max_files=2)
    paths = LakePaths(root)
    for q in run_recommendation_inputs(src, paths, trigger=AVAILABLE_NOW):
        q.awaitTermination()
    plays, users = read_recommendation_inputs(spark, paths)
    return recommendation_rows(recommend_from(plays, users, n=3, as_of=lake.FIXED_AS_OF))
