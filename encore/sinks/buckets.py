"""Upserts that rewrite only what they touch (M1, M2 on large tables).

A table's rows lie in ``buckets`` partitions by a hash of their key. An upsert
reads and writes only the buckets that its rows fall into. New partitions are
first written whole beside the table, unseen by readers, and then take the
place of the old ones by a dynamic partition overwrite; a run that dies in
between is finished by the next one from the same files. One writer at a time;
a reader that needs all buckets of one moment uses ``sinks.tables`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.operators.dims import upsert
from encore.sinks import fs

BUCKETS = 64
BUCKET = "key_bucket"
_STAGE = "_next"


def finish_replace(spark: SparkSession, path: str, schema, partition: str) -> bool:
    """Put staged partitions in place, if a whole stage is there."""
    stage = f"{path.rstrip('/')}/{_STAGE}"
    if not fs.exists(spark, f"{stage}/_SUCCESS"):
        return False
    ready = spark.read.schema(schema).parquet(stage)
    (ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))
    fs.delete(spark, stage)
    return True


def replace_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Write ``rows`` in place of the partitions that they fall into. The
    rows may be computed from the same table."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy(partition).parquet(f"{path.rstrip('/')}/{_STAGE}")
    finish_replace(spark, path, rows.schema, partition)


def _bucketed(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def read_buckets(spark: SparkSession, path: str, schema) -> DataFrame:
    """The whole table (``schema``: of its rows, without the bucket)."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(whole).parquet(path).drop(BUCKET)


def upsert_buckets(source: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> list[int]:
    """Merge ``source`` (unique, non-null keys) into the table at ``path`` and
    return the buckets rewritten. The number of buckets is fixed by the first
    load; size it so that a bucket is a file of a task's size."""
    spark = source.sparkSession
    new = _bucketed(source, keys, buckets)
    if fs.exists(spark, path):
        finish_replace(spark, path, new.schema, BUCKET)
    have = [int(d.split("=")[1]) for d in fs.list_dirs(spark, path) if d.startswith(f"{BUCKET}=")]
    # At most ``buckets`` numbers.
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    if not touched:
        return []
    if have:
        old = spark.read.schema(new.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
        new = upsert(old, new, [*keys, BUCKET])
    # One bucket is one task's work: its rows are brought together.
    replace_partitions(new.repartition(BUCKET), path, BUCKET)
    return touched
