"""Versioned tables with atomic publication (no transactional table format
needed).

A table root holds ``v=<n>`` version directories. A version is written in
full by a normal Spark write, whose ``_SUCCESS`` marker (written at job
commit) is the commit record; readers resolve the newest version that has
it. A reader never sees a half-written version and a running reader is
never disturbed by a writer, because a version is never overwritten.
A plain parquet directory (no versions) is read as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from encore.sinks import fs

_PREFIX = "v="


def _versions(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name in fs.list_dirs(spark, root):
        if name.startswith(_PREFIX) and name[len(_PREFIX):].isdigit():
            out.append(int(name[len(_PREFIX):]))
    return sorted(out)


def current_version(spark: SparkSession, root: str) -> int | None:
    root = root.rstrip("/")
    for v in reversed(_versions(spark, root)):
        if fs.exists(spark, f"{root}/{_PREFIX}{v:06d}/_SUCCESS"):
            return v
    return None


def resolve_current(spark: SparkSession, root: str) -> str:
    """Path of the newest committed version, or ``root`` itself for an
    unversioned table. Version directories without a committed one are an
    error: reading the root would show uncommitted rows."""
    root = root.rstrip("/")
    v = current_version(spark, root)
    if v is None and _versions(spark, root):
        raise RuntimeError(f"{root} has no committed version yet")
    return root if v is None else f"{root}/{_PREFIX}{v:06d}"


def table_exists(spark: SparkSession, root: str) -> bool:
    return current_version(spark, root) is not None


def publish_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of the table and return its path.

    The next number skips every existing version directory, committed or
    left by a failed attempt. Tables have one writer (a job or one streaming
    query): ``errorifexists`` catches a second writer that starts after the
    first has made its directory, not two that start at the same moment."""
    spark = df.sparkSession
    root = root.rstrip("/")
    vs = _versions(spark, root)
    nxt = (vs[-1] + 1) if vs else 0
    path = f"{root}/{_PREFIX}{nxt:06d}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def prune_versions(spark: SparkSession, root: str, keep: int = 3,
                   min_age_seconds: float = 3600.0) -> list[str]:
    """Retention: delete versions beyond the newest ``keep`` committed ones
    whose commit is older than ``min_age_seconds`` (so a reader that
    resolved a recent older version is not disturbed). Directories of
    failed attempts below the oldest kept version go too. Returns the
    deleted paths."""
    import time

    root = root.rstrip("/")
    vs = _versions(spark, root)
    committed = [v for v in vs if fs.exists(spark, f"{root}/{_PREFIX}{v:06d}/_SUCCESS")]
    if len(committed) <= keep:
        return []
    oldest_kept = committed[-keep] if keep > 0 else committed[-1] + 1
    now_ms = time.time() * 1000.0
    deleted = []
    for v in vs:
        if v >= oldest_kept:
            break
        path = f"{root}/{_PREFIX}{v:06d}"
        mtime = fs.modified_ms(spark, f"{path}/_SUCCESS") or fs.modified_ms(spark, path) or 0
        if now_ms - mtime >= min_age_seconds * 1000.0:
            fs.delete(spark, path)
            deleted.append(path)
    return deleted


def published_batches(spark: SparkSession, root: str) -> list[int]:
    """Ids of the published micro-batches of a table, ascending."""
    return sorted(int(d[9:]) for d in fs.list_dirs(spark, root.rstrip("/"))
                  if d.startswith("batch_id=") and d[9:].isdigit())
