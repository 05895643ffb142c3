"""Structured Streaming wiring (X1-X10). The transformations are the same
DataFrame functions the batch plans use."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import schemas
from encore.operators.bronze import SOURCE_NAME, bronze, flag_valid, parse_events, split_valid
from encore.operators.enrich import enrich
from encore.sinks import fs, writers
from encore.sinks.tables import prune_versions, resolve_current, table_exists
from encore.sources.readers import stream_table


@dataclass
class LakePaths:
    """Table and checkpoint locations of one deployment (all on shared
    storage)."""
    root: str

    def _p(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze_valid(self): return self._p("bronze/events_valid")
    @property
    def bronze_invalid(self): return self._p("bronze/events_invalid")
    @property
    def bronze_unique(self): return self._p("bronze/events_unique")
    @property
    def bronze_late(self): return self._p("bronze/events_late")
    @property
    def dim_users(self): return self._p("silver/dim_users")
    @property
    def dim_songs(self): return self._p("silver/dim_songs")
    @property
    def silver(self): return self._p("silver/enriched")
    @property
    def gold(self): return self._p("gold/music_events")
    @property
    def gold_rejects(self): return self._p("gold/rejects")
    @property
    def recommendations(self): return self._p("gold/user_recommendations")
    @property
    def recommendations_current(self): return self._p("gold/user_recommendations_current")
    @property
    def play_counts(self): return self._p("gold/play_counts")
    @property
    def active_users(self): return self._p("gold/active_users")

    def ckpt(self, name: str) -> str:
        return self._p(f"_checkpoints/{name}")


def run_bronze(raw: DataFrame, paths: LakePaths, trigger=None, as_of=None,
               single_read: bool = False):
    """parse/validate the raw stream, write valid and invalid events.

    Default: two independent queries, each with its own checkpoint (each
    reads the source). ``single_read=True``: one query whose micro-batch is
    read once, persisted, and published to both tables exactly once
    (``batch_id=<n>/event_type=<t>`` for valid events); this halves source
    reads at the cost of one combined checkpoint.
    """
    if single_read:
        return [_run_bronze_single(raw, paths, trigger, as_of)]
    valid, invalid = bronze(raw, as_of=as_of, source=SOURCE_NAME)
    q1 = writers.write_bronze_valid(valid, paths.bronze_valid, paths.ckpt("bronze_valid"), trigger)
    q2 = writers.write_bronze_invalid(invalid, paths.bronze_invalid,
                                      paths.ckpt("bronze_invalid"), trigger)
    return [q1, q2]


def _run_bronze_single(raw: DataFrame, paths: LakePaths, trigger=None, as_of=None):
    guard_checkpoint(raw.sparkSession, paths.ckpt("bronze"), paths.bronze_valid)

    def _batch(df: DataFrame, batch_id: int) -> None:
        # Parse once, keep the parsed rows for both outputs.
        parsed = flag_valid(parse_events(df, source=SOURCE_NAME, as_of=as_of)).persist()
        try:
            valid, invalid = split_valid(parsed)
            writers.publish_batch(valid, paths.bronze_valid, batch_id, partition_by=["event_type"])
            writers.publish_batch(invalid, paths.bronze_invalid, batch_id)
        finally:
            parsed.unpersist()

    w = raw.writeStream.foreachBatch(_batch).option("checkpointLocation", paths.ckpt("bronze"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _bronze_valid_schema():
    # The event_type partition column is appended last when read back.
    f = [x for x in schemas.BRONZE_VALID.fields if x.name != "event_type"]
    return schemas.T.StructType(f + [schemas.T.StructField("event_type", schemas.T.StringType())])


def guard_checkpoint(spark: SparkSession, ckpt: str, table_root: str) -> None:
    """Refuse to start a query whose checkpoint is new while its output
    table already holds published batches: batch ids restart at 0 with a new
    checkpoint, so the skip-if-published rule would silently drop data."""
    if fs.exists(spark, f"{ckpt.rstrip('/')}/metadata"):
        return
    if table_exists(spark, table_root) or fs.exists(spark, f"{table_root}/_spark_metadata"):
        raise RuntimeError(
            f"{table_root} already holds output but checkpoint {ckpt} is new; "
            "restore the checkpoint or write to a new table")
    published = [d for d in fs.list_dirs(spark, table_root) if d.startswith("batch_id=")]
    if published:
        raise RuntimeError(
            f"{table_root} has {len(published)} published batches but checkpoint {ckpt} is new; "
            "restore the checkpoint or write to a new table")


# Dimensions of at most this many rows are broadcast to the micro-batch
# join: about Spark's default 10 MB broadcast threshold at ~100 bytes per
# dimension row. Larger ones stay hash-partitioned on their key in cache.
DIM_BROADCAST_ROWS = 100_000


class DimensionCache:
    """The current version of a dimension, read once per published version
    and counted (from parquet footers). A dimension larger than
    ``broadcast_rows`` is kept hash-partitioned on its join key, so a
    micro-batch join shuffles only the events; a smaller one is cached as
    read and broadcast. A newer version replaces (and unpersists) the old
    one; lost cached blocks are recomputed from the version files."""

    def __init__(self, spark: SparkSession, root: str, key, partitions: int | None = None,
                 broadcast_rows: int = DIM_BROADCAST_ROWS):
        self.spark, self.root, self.key = spark, root, key
        self.partitions = partitions
        self.broadcast_rows = broadcast_rows
        self.path: str | None = None
        self.df: DataFrame | None = None
        self.rows: int | None = None

    @property
    def small(self) -> bool:
        """True when the current version is within the broadcast bound."""
        return self.rows is not None and self.rows <= self.broadcast_rows

    def get(self) -> DataFrame:
        cur = resolve_current(self.spark, self.root)
        if cur != self.path:
            fresh = self.spark.read.parquet(cur)
            rows = fresh.count()
            if rows > self.broadcast_rows:
                n = self.partitions or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
                fresh = fresh.repartition(n, self.key)
            fresh = fresh.persist()
            if self.df is not None:
                self.df.unpersist()
            self.path, self.df, self.rows = cur, fresh, rows
        return self.df


def enrich_stream(valid_stream: DataFrame, paths: LakePaths, trigger=None, as_of=None,
                  hot_key_rows: int = 1_000_000, broadcast_rows: int = DIM_BROADCAST_ROWS):
    """X5 + J3: stream-static enrichment in which every micro-batch resolves
    the newest published dimension versions, so dimension updates are seen
    by the next batch. Each enriched batch is published exactly once.

    Dimensions within ``broadcast_rows`` (checked per version by their row
    count) are broadcast: no shuffle, so no skew. Against a larger,
    partitioned dimension AQE cannot split a skewed join, so hot keys are
    split off explicitly (``operators.skew``)."""
    spark = valid_stream.sparkSession
    users = DimensionCache(spark, paths.dim_users, F.col("user_id"),
                           broadcast_rows=broadcast_rows)
    songs = DimensionCache(spark, paths.dim_songs, F.col("song_id"),
                           broadcast_rows=broadcast_rows)
    guard_checkpoint(spark, paths.ckpt("silver"), paths.silver)

    def _batch(df: DataFrame, batch_id: int) -> None:
        u, s = users.get(), songs.get()
        small = frozenset(n for n, c in (("users", users), ("songs", songs)) if c.small)
        if small == {"users", "songs"}:
            # Both dimensions broadcast: one pass over the batch, nothing to split.
            out = enrich(df, u, s, as_of=as_of, broadcast_dims=small)
            writers.publish_batch(out, paths.silver, batch_id)
            return
        # The batch is read once: the hot-key counts and the join share it.
        cached = df.persist()
        try:
            out = enrich(cached, u, s, as_of=as_of, split_hot_keys=True,
                         min_hot_rows=hot_key_rows, broadcast_dims=small)
            writers.publish_batch(out, paths.silver, batch_id)
        finally:
            cached.unpersist()

    w = valid_stream.writeStream.foreachBatch(_batch).option(
        "checkpointLocation", paths.ckpt("silver"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def _silver_schema():
    return schemas.T.StructType(schemas.SILVER.fields + [
        schemas.T.StructField("batch_id", schemas.T.LongType())])


def run_gold(silver_stream: DataFrame, paths: LakePaths, trigger=None,
             jdbc_options: dict | None = None):
    """Load gold per micro-batch (empty batches skipped, idempotent on
    replay). ``jdbc_options`` also appends each batch to an external store
    (at least once: see writers.write_gold)."""
    guard_checkpoint(silver_stream.sparkSession, paths.ckpt("gold"), paths.gold)

    def _batch(df: DataFrame, batch_id: int) -> None:
        writers.write_gold(df.drop("batch_id"), batch_id, paths.gold, paths.gold_rejects, jdbc_options)

    w = silver_stream.writeStream.foreachBatch(_batch).option(
        "checkpointLocation", paths.ckpt("gold"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


#: Files of a stage's micro-batch at most.
STAGE_FILES = 1000


def run_pipeline(spark: SparkSession, raw: DataFrame, paths: LakePaths,
                 trigger=None, timeout: float | None = None, as_of=None,
                 single_read: bool = False, gold_trigger=None,
                 enrich_options: dict | None = None,
                 recommendation_inputs: bool = False, inputs_trigger=None,
                 max_files: int | None = STAGE_FILES, dedupe_delay: str | None = None,
                 gold_jdbc: dict | None = None) -> None:
    """Bronze -> silver -> gold through tables.

    With ``trigger={"availableNow": True}`` the stages run one after the
    other to completion (tests, catch-up jobs). With a processing-time
    trigger all stages run concurrently and this call blocks until any of
    them stops or fails (a failure of any stage is raised, not ignored).
    ``gold_trigger`` overrides the trigger of the gold load (e.g. a 10 s
    processing-time trigger while bronze and silver run as fast as data
    arrives). ``enrich_options`` go to :func:`enrich_stream`
    (``broadcast_rows``, ``hot_key_rows``). ``recommendation_inputs`` adds
    the two stateful queries of :func:`run_recommendation_inputs` on gold,
    with ``inputs_trigger`` (default: the gold trigger). ``max_files`` bounds
    the files of a stage's micro-batch, so a backlog becomes several batches
    (these stages carry no watermark: nothing is dropped). ``dedupe_delay``
    removes event ids repeated within that event time before enrichment.
    Rows that came later than that go to ``bronze_late``; ``late.settle_late``
    adds those that are no repeats, and the next run takes them on.
    ``gold_jdbc``: options of a JDBC sink that gets the gold rows too.
    """
    available_now = bool(trigger and trigger.get("availableNow"))
    qs = run_bronze(raw, paths, trigger, as_of=as_of, single_read=single_read)
    if available_now:
        for q in qs:
            q.awaitTermination()
    valid = stream_table(spark, paths.bronze_valid, _bronze_valid_schema(), max_files=max_files)
    if dedupe_delay:
        from encore.streaming.late import run_first_arrivals, unique_schema

        qs.append(run_first_arrivals(valid, paths, dedupe_delay, trigger))
        if available_now:
            qs[-1].awaitTermination()
        valid = stream_table(spark, paths.bronze_unique, unique_schema(), max_files=max_files)
    qs.append(enrich_stream(valid, paths, trigger, as_of=as_of, **(enrich_options or {})))
    if available_now:
        qs[-1].awaitTermination()
    silver = stream_table(spark, paths.silver, _silver_schema(), max_files=max_files)
    qs.append(run_gold(silver, paths, gold_trigger or trigger, gold_jdbc))
    if available_now:
        qs[-1].awaitTermination()
    if recommendation_inputs:
        gold = stream_table(spark, paths.gold, gold_stream_schema(), max_files=max_files)
        inputs = run_recommendation_inputs(gold, paths, inputs_trigger or gold_trigger or trigger)
        qs.extend(inputs)
        if available_now:
            for q in inputs:
                q.awaitTermination()
    if available_now:
        return
    await_own(qs, timeout)


def await_own(qs: list, timeout: float | None = None, poll: float = 1.0) -> None:
    """Block until one of these queries ends (other streams of the session do
    not matter) or ``timeout`` seconds pass. When one has failed, the others
    are stopped and its error is raised."""
    end = None if timeout is None else time.monotonic() + timeout
    while all(q.isActive for q in qs) and (end is None or time.monotonic() < end):
        qs[0].awaitTermination(poll if end is None else max(0.0, min(poll, end - time.monotonic())))
    failed = next((q.exception() for q in qs if q.exception() is not None), None)
    if failed is not None:
        for q in qs:
            if q.isActive:
                q.stop()
        raise failed


def late_rows(query) -> int:
    """Rows that a query's watermark has dropped, over its kept progress
    reports (spark.sql.streaming.numRecentProgressUpdates, 100 by default)."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in map(dict, query.recentProgress)
               for op in p.get("stateOperators", []))


def refuse_late_rows(query) -> None:
    """Fail rather than go on with rows silently missing."""
    n = late_rows(query)
    if n:
        raise RuntimeError(f"{n} rows came later than the watermark delay; use a longer delay")


PLAY_COUNT_KEYS = ["country", "song_name", "artist_name"]


def gold_stream_schema():
    """Gold as published by :func:`run_gold` (``batch_id=<n>/event_month=<m>``)."""
    return schemas.T.StructType(schemas.GOLD.fields + [
        schemas.T.StructField("batch_id", schemas.T.LongType())])


def run_recommendation_inputs(gold_stream: DataFrame, paths: LakePaths, trigger=None):
    """Keep the two inputs of the recommendation job current per micro-batch,
    so the hourly job reads tables sized by (country, song) groups and users
    rather than the whole event history.

    * PLAY counts per (country, song_name, artist_name): a stateful
      streaming aggregation (partial aggregation per batch, one state row per
      group) in update mode. Each batch upserts the changed groups' absolute
      counts into a versioned table, so a replayed batch writes the same
      values again (idempotent).
    * Active users: streaming deduplication of (user_id, user_name, country)
      in append mode into a parquet file sink (exactly once through the
      sink's own log).

    Both keep their state in checkpoints under the lake; a new checkpoint
    over an existing output is refused (the counts would restart at 0).
    Each counts batch publishes a full new version (size: the number of
    groups), so run these queries on a slower trigger than gold (minutes):
    the state accumulates between triggers, nothing is lost.
    Returns the two streaming queries.
    """
    from encore.operators.dims import upsert_table
    from encore.plans.recommend import active_users, plays_by_country

    spark = gold_stream.sparkSession
    guard_checkpoint(spark, paths.ckpt("play_counts"), paths.play_counts)
    guard_checkpoint(spark, paths.ckpt("active_users"), paths.active_users)

    def _counts(df: DataFrame, batch_id: int) -> None:
        # Persisted: the emptiness probe and the upsert must not run the
        # stateful aggregation twice.
        changed = df.persist()
        try:
            if not changed.isEmpty():
                upsert_table(changed, paths.play_counts, PLAY_COUNT_KEYS)
                prune_versions(spark, paths.play_counts)
        finally:
            changed.unpersist()

    w1 = (plays_by_country(gold_stream).writeStream.outputMode("update").foreachBatch(_counts)
          .option("checkpointLocation", paths.ckpt("play_counts")))
    w2 = (active_users(gold_stream).writeStream.format("parquet").outputMode("append")
          .option("checkpointLocation", paths.ckpt("active_users")))
    if trigger:
        w1, w2 = w1.trigger(**trigger), w2.trigger(**trigger)
    return [w1.start(), w2.start(paths.active_users)]


def read_recommendation_inputs(spark: SparkSession, paths: LakePaths) -> tuple[DataFrame, DataFrame]:
    """(play counts, active users) as kept by :func:`run_recommendation_inputs`."""
    plays = spark.read.parquet(resolve_current(spark, paths.play_counts))
    users = spark.read.schema("user_id int, user_name string, country string").parquet(
        paths.active_users)
    return plays, users


def with_event_time(gold: DataFrame) -> DataFrame:
    """Event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    return gold.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def stream_listening_trend(gold_stream: DataFrame, interval: str = "1 hour",
                           delay: str | None = None) -> DataFrame:
    """Tumbling-window event counts per event type. Without ``delay`` every
    row counts, whatever order it comes in; the state is one row per window
    and type, which the calendar bounds (update mode). With ``delay`` a
    watermark drops window state once it has passed, and with it any row that
    comes later: for live streams in time order only (append mode gives
    final counts); :func:`late_rows` tells how many were lost."""
    g = with_event_time(gold_stream)
    if delay is not None:
        g = g.withWatermark("event_timestamp", delay)
    return (g.groupBy(F.window("event_timestamp", interval).alias("w"), "event_type")
             .agg(F.count(F.lit(1)).alias("count"))
             .select(F.col("w.start").alias("time"), "event_type", "count"))


def dedupe_events(events: DataFrame, delay: str = "1 hour",
                  time_col: str = "event_time") -> DataFrame:
    """Drop repeated event_ids arriving within ``delay`` of each other
    (state per id is kept only until the watermark passes). ``delay`` must
    cover the disorder of arrival: rows older than the watermark are dropped
    (:func:`late_rows`)."""
    return events.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["event_id"])
