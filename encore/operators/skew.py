"""Hot-key splitting for joins whose shuffle cannot be split at run time.

AQE splits a skewed sort-merge join only when both sides are shuffle
stages. A dimension kept pre-partitioned in cache (streaming) is not, so a
key holding a large share of the facts would land in one task. Here such
keys are found with one partially aggregated count and joined through a
broadcast of their few dimension rows; the remaining facts take the normal
partitioned join.

Bounded by construction: a key is hot only if it holds at least
max(min_rows, total / max_hot_keys) rows, so there are at most
``max_hot_keys`` hot keys per join key. Only that bounded key list reaches
the driver; it becomes an ``isin`` filter (no extra join to flag rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def find_hot_keys(df: DataFrame, keys: dict[str, Column], max_hot_keys: int = 1000,
                  min_rows: int = 1_000_000) -> dict[str, list[str]]:
    """Hot values (as text) of several key expressions in one pass: the
    keys are stacked, counted with partial aggregation, and filtered
    against the bound. Returns {name: [key, ...]} with at most
    ``max_hot_keys`` entries per name.

    The row count comes first (on a persisted frame it also fills the
    cache the join reads next). Below ``min_rows`` rows no key can be hot,
    so the key count is skipped: small micro-batches pay no extra shuffle.
    """
    out: dict[str, list[str]] = {n: [] for n in keys}
    total = df.count()
    if total < min_rows:
        return out
    bound = max(float(min_rows), total / float(max_hot_keys))
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("kind"), c.cast("string").alias("key")) for n, c in keys.items()
    ])).alias("x")).select("x.kind", "x.key")
    counts = stacked.groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.filter(F.col("key").isNotNull() & (F.col("n") >= F.lit(bound))).select("kind", "key")
    for r in rows.collect():  # at most max_hot_keys per kind
        out[r.kind].append(r.key)
    return out


def split_left_join(facts: DataFrame, fact_key: Column, dim: DataFrame, dim_key: str,
                    max_hot_keys: int = 1000, min_rows: int = 1_000_000) -> DataFrame:
    """``facts LEFT JOIN dim ON fact_key = dim.dim_key`` with hot keys
    joined through a broadcast of their dimension rows. Output: facts
    columns + dim columns except the key; equal to the plain left join."""
    hot = find_hot_keys(facts, {"k": fact_key}, max_hot_keys, min_rows)["k"]
    d = dim.withColumnRenamed(dim_key, "_join_key")
    f = facts.withColumn("_join_key", fact_key)
    if not hot:
        return f.join(d, "_join_key", "left").drop("_join_key")
    is_hot = F.coalesce(F.col("_join_key").cast("string").isin(hot), F.lit(False))
    hot_dim = F.broadcast(d.filter(F.col("_join_key").cast("string").isin(hot)))
    cold = f.filter(~is_hot).join(d, "_join_key", "left")
    warm = f.filter(is_hot).join(hot_dim, "_join_key", "left")
    return cold.unionByName(warm).drop("_join_key")
