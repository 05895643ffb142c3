"""Sinks (K1-K10). Streaming frames get a ``writeStream``; batch frames a
``write``. Paths and connector options come from the caller."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from encore.functions import to_message
from encore.operators.gold import gold_layout, split_gold, standardize_gold
from encore.sinks import fs


def _stream(df: DataFrame, path: str, ckpt: str, partition_by=None, trigger=None,
            fmt: str = "parquet"):
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", ckpt))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if trigger:
        w = w.trigger(**trigger)
    return w.start(path)


def write_bronze_valid(df: DataFrame, path: str, ckpt: str | None = None, trigger=None):
    """K1: valid events, append, partitioned by event_type."""
    if df.isStreaming:
        return _stream(df, path, ckpt, ["event_type"], trigger)
    df.write.mode("append").partitionBy("event_type").parquet(path)
    return None


def write_bronze_invalid(df: DataFrame, path: str, ckpt: str | None = None, trigger=None):
    """K2: quarantined events, append, unpartitioned."""
    if df.isStreaming:
        return _stream(df, path, ckpt, None, trigger)
    df.write.mode("append").parquet(path)
    return None


# File systems whose directory rename is atomic.
ATOMIC_RENAME = ("", "file", "hdfs", "viewfs", "abfs", "abfss")


def publish_batch(df: DataFrame, root: str, batch_id: int, partition_by=None,
                  sort_within=None) -> bool:
    """Exactly-once publication of one micro-batch under ``root``.

    The batch is written to a hidden stage directory (readers skip names
    starting with '_') and then renamed to ``batch_id=<n>``. If the final
    directory holds the write's ``_SUCCESS`` marker the batch was published
    before a restart and is skipped, never rewritten: a downstream file
    stream identifies input files by name and would ingest a rewrite twice.
    A final directory without the marker (a broken copy) is replaced.
    Returns True when written. Stores whose rename is a copy are refused:
    there a crash could leave half a batch for readers to see.
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    final = f"{root}/batch_id={batch_id}"
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    scheme = root.split(":", 1)[0] if "://" in root or root.startswith("file:") else ""
    if scheme not in ATOMIC_RENAME:
        raise RuntimeError(f"{scheme}:// has no atomic rename; keep the lake on "
                           f"{', '.join(s for s in ATOMIC_RENAME if s)}")
    if fs.exists(spark, f"{final}/_SUCCESS"):
        return False
    if fs.exists(spark, final):
        fs.delete(spark, final)
    stage = f"{root}/_stage_{batch_id}"
    w.parquet(stage)
    fs.mkdirs(spark, root)
    if not fs.rename(spark, stage, final):
        raise RuntimeError(f"could not publish {stage} -> {final}")
    return True


def write_gold(silver_batch: DataFrame, batch_id: int, path: str | None,
               rejects_path: str | None = None, jdbc_options: dict | None = None) -> int:
    """K4/K5: load one micro-batch of silver rows into gold.

    Empty batches are skipped; rows without event_id are dropped; rows with
    an unparseable time go to ``rejects_path`` (a batch without such rows
    writes nothing there); everything else is written by name in the gold
    column order, partitioned by month and sorted by (event_type,
    event_timestamp, user_id) within each file. Errors fail the streaming
    query (the batch is retried), they are never swallowed.
    """
    if silver_batch.isEmpty():  # reads only the first input split
        return 0
    _load_gold(standardize_gold(silver_batch), batch_id, path, rejects_path, jdbc_options)
    return 1


def _load_gold(std: DataFrame, batch_id: int, path, rejects_path, jdbc_options) -> None:
    # The loadable rows are written in one pass over the batch; the same
    # pass counts the rejects (observed metric), so the reject output costs
    # a second pass only when the batch has rejects.
    obs = Observation(f"gold_batch_{batch_id}_{uuid.uuid4().hex[:8]}")
    keyed = F.col("event_id").isNotNull()
    seen = std.observe(obs, F.count(F.when(keyed & F.col("event_timestamp").isNull(), 1))
                       .alias("rejects"))
    ok, rejected = split_gold(seen)
    observed = False
    if jdbc_options:
        # Optional analytical-store load through the JDBC sink (needs the
        # store's driver). Appends by column name; at-least-once unless the
        # target deduplicates on (event_id, event_timestamp).
        (ok.drop("event_month").write.format("jdbc").options(**jdbc_options)
           .mode("append").save())
        observed = True
    if path:
        observed = publish_batch(gold_layout(ok), path, batch_id,
                                 partition_by=["event_month"]) or observed
    # A replayed batch (already published, so nothing ran) cannot tell;
    # publish_batch itself skips the rejects if they were published too.
    if rejects_path and (not observed or obs.get["rejects"] > 0):
        publish_batch(rejected.drop("event_month"), rejects_path, batch_id)


def write_recommendations(df: DataFrame, path: str) -> None:
    """K7: append a recommendation generation (readers take the newest row
    per user)."""
    df.write.mode("append").parquet(path)


def land_songs(df: DataFrame, path: str, run_ts: datetime | str | None = None) -> str:
    """K8: one timestamped JSON snapshot directory per run."""
    if run_ts is None:
        run_ts = datetime.now()
    ts = run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y%m%d_%H%M%S")
    out = f"{path.rstrip('/')}/songs_raw_{ts}"
    df.write.mode("errorifexists").json(out)
    return out


def land_song_arrays(df: DataFrame, path: str, run_ts: str) -> str:
    """K8, upstream's form: a snapshot of JSON array files, one array per
    partition of ``df`` split into runs of 5,000 songs."""
    out = f"{path.rstrip('/')}/songs_raw_{run_ts}"
    song = F.struct(*df.columns)
    run = F.floor(F.monotonically_increasing_id() / 5000).alias("run")
    arrays = df.select(run, song.alias("s")).groupBy("run").agg(F.collect_list("s").alias("a"))
    (arrays.repartition("run").select(F.to_json("a").alias("value")).write.mode("errorifexists")
        .option("maxRecordsPerFile", 1).text(out))
    return out


def land_users(df: DataFrame, path: str, rows_per_file: int = 2500) -> None:
    """K9: users as CSV with a header, at most ``rows_per_file`` rows each."""
    (df.write.mode("overwrite").option("header", True)
       .option("maxRecordsPerFile", rows_per_file).csv(path))


def to_messages(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows -> JSON text messages in a ``value`` column."""
    return df.select(to_message(*(cols or df.columns)).alias("value"))


def publish_messages(df: DataFrame, path: str | None = None, fmt: str = "text",
                     options: dict | None = None) -> None:
    """Write messages to a topic (``fmt="kafka"``, needs the connector)
    or as text files."""
    msgs = df if df.columns == ["value"] else to_messages(df)
    if fmt == "kafka":
        msgs.select(F.col("value").cast("string")).write.format("kafka").options(
            **(options or {})).save()
    else:
        msgs.select(F.col("value").cast("string")).write.mode("append").text(path)
