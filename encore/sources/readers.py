"""Batch and streaming readers (S1-S7). Explicit schemas everywhere."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore import schemas
from encore.sinks import fs
from encore.sinks.tables import resolve_current


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Make sure a batch input has at least the cluster's parallelism in
    partitions. A no-op for inputs that already split into enough scan
    tasks (the normal case for large tables); small inputs in a single
    unsplittable file (one parquet row group) are spread round-robin so the
    CPU-heavy per-row work (JSON encode/parse) does not run in one task.
    Only the plan is inspected, no job runs."""
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def event_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None) -> DataFrame:
    """Stream of raw event messages with a binary ``value`` column.

    ``fmt="kafka"`` uses the Kafka source (needs its connector on the
    classpath; options such as kafka.bootstrap.servers / subscribe /
    startingOffsets=earliest / failOnDataLoss=false are passed through).
    ``fmt="text"`` reads one message per line from files under ``path``;
    it is the form used without a broker.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("failOnDataLoss", "false")
        try:
            return spark.readStream.format("kafka").options(**opts).load().select("value")
        except Exception as e:  # noqa: BLE001
            if "kafka" in str(e).lower() and "not find" in str(e).lower():
                raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the "
                                   "classpath (spark.jars.packages); use fmt='text' for files") from e
            raise
    reader = spark.readStream.options(**opts)
    return reader.text(path).select(F.col("value").cast("binary").alias("value"))


_HEAD = 1 << 16


def _whole_document(head: bytes) -> bool:
    """True when a JSON file that starts with ``head`` is one document (an
    array, or an object over several lines), False for one object per line."""
    text = head.decode("utf-8", "ignore").lstrip("\ufeff \t\r\n")
    if text.startswith("["):
        return True
    first, newline, _ = text.partition("\n")
    if not newline:
        return False
    try:
        json.loads(first)
    except ValueError:
        return True
    return False


def read_json(spark: SparkSession, path: str, schema, multiline: bool | None = None) -> DataFrame:
    """JSON files with a declared schema, arrays and lines mixed. The shape of
    each file is taken from its first bytes (one open per landed file, on
    the driver); ``multiline`` sets it for all files instead."""
    reader = spark.read.schema(schema)
    if multiline is not None:
        return reader.option("multiLine", multiline).json(path)
    shapes: dict[bool, list[str]] = {True: [], False: []}
    for name in fs.list_files(spark, path):
        if name.rsplit(".", 1)[-1] in ("gz", "bz2", "zst", "snappy", "lz4", "deflate"):
            raise ValueError(f"{name} is compressed: say multiline=True or False")
        shapes[_whole_document(fs.head(spark, name, _HEAD))].append(name)
    if not shapes[True] and not shapes[False]:
        return reader.json(path)
    parts = [spark.read.schema(schema).option("multiLine", whole).json(names)
             for whole, names in shapes.items() if names]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_songs(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Songs landing files: JSON arrays (one row per element) or JSON lines."""
    return read_json(spark, path, schemas.SONGS_LANDING, multiline)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Users landing CSV: header per file, every column kept as text."""
    return spark.read.schema(schemas.USERS_LANDING).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A published table (dimension or recommendations). Versioned tables
    resolve to their newest committed version."""
    return spark.read.parquet(resolve_current(spark, path))


def stream_table(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A parquet table as a streaming source (bronze -> silver -> gold).
    The table directory is created when missing: with concurrent stages on
    a new lake, the downstream stream starts before the upstream one has
    written anything."""
    fs.mkdirs(spark, path)
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def read_gold(spark: SparkSession, path: str, months: list[int] | None = None) -> DataFrame:
    """Gold table scan. A month list becomes a partition filter on
    event_month (pruned at planning time)."""
    df = spark.read.schema(schemas.GOLD).parquet(path)
    if months:
        df = df.filter(F.col("event_month").isin(list(months)))
    return df


def read_track_pages(spark: SparkSession, path: str, multiline: bool | None = None) -> DataFrame:
    """Landed chart pages, one row per track (nested array exploded): one
    (possibly pretty-printed) response per file, or one page per line."""
    pages = read_json(spark, path, schemas.CHART_PAGE, multiline)
    return pages.select(F.explode("tracks.track").alias("t")).select("t.*")
