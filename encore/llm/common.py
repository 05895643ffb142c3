"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import scratch_path
from encore.sinks import fs

NULL_ID = (1 << 63) - 1        # a null doc_id counts as the largest id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the
    lineage, survives lost executors, and is computed a single time."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that this driver has stored and not cleared.
_WRITTEN: list[str] = []


def clear_stored(spark: SparkSession, but_last: int = 0) -> None:
    """Delete the stored tables, except the last ``but_last``. Call it when
    every result that reads them has been written."""
    done = _WRITTEN[:len(_WRITTEN) - but_last]
    del _WRITTEN[:len(done)]
    for path in done:
        fs.delete(spark, path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def apart(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, and all others within the struct ``doc``: columns
    that an operator adds cannot meet one of the same name."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in keep]
    return docs.select(*keep, F.struct(*(others or [F.lit(0).alias("none")])).alias("doc"))


def together(names: list[str], **own) -> list:
    """The columns ``names`` in order, from ``own`` or else out of ``doc``."""
    return [(own[c] if c in own else F.col("doc").getField(c)).alias(c) for c in names]


def crc_mod(column: str, n: int):
    """crc32 of the id written as text, modulo n (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


SKETCH_BITS = 1 << 23


def packed_sketch(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """``bits`` flags (a power of 2, at least 32,768), eight to a byte, the first in
    the lowest bit: set at the low bits of each hash in ``column``."""
    at = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
    rows = df.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect()
    flags = np.zeros((bits // 32768, 4096), np.uint8)
    for r in rows:                             # at most bits / 32768
        flags[r["b"] - 1] = np.frombuffer(bytes(r["m"]), np.uint8)
    return flags.ravel()


def sketch(df: DataFrame, column: str) -> np.ndarray:
    """SKETCH_BITS flags (1 MB, whatever the input): True at the low bits of
    each hash in ``column``. Rows of a large table whose hash has no flag
    cannot meet these rows in a join and need not be shuffled; with very many
    hashes all flags are set and the filter passes everything."""
    return np.unpackbits(packed_sketch(df, column, SKETCH_BITS), bitorder="little").astype(bool)


def _mark(e: DataFrame) -> tuple:
    """Fingerprint of a set of edges: a round that keeps it changed nothing."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "cc") -> DataFrame:
    """Connected components of undirected edges as (node, root), root being
    the smallest node of the component.

    Alternating large-star and small-star rounds: each round replaces the
    edges by edges to the smallest neighbour, so a component becomes a star
    in O(log n) rounds. Minima are pre-aggregated before each shuffle and a
    hub's edges are joined back on its key, where Spark can split a skewed
    join; no neighbour list is ever collected. Every round is written to the
    shared folder.
    """
    spark = edges.sparkSession
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
               .filter("u <> v").distinct(), f"{name}-edges")
    mark = _mark(e)
    while mark[0]:
        # Large star: every larger neighbour of u points to the smallest one.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: u and its smaller neighbours point to the smallest one.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        e = stored(small, f"{name}-round")
        before, mark = mark, _mark(e)
        if before == mark:
            break
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
