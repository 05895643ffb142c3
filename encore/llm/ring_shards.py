"""Sharding by a consistent-hash ring with bounded loads (operator 11, native).

Method. The ring has sixteen places or more for each virtual node, of which
every shard owns ``points``; a document's place is a hash of its id and it goes
to the shard of the next node clockwise. Documents come in the order of a second hash of the id. A
shard that has reached its capacity is full, and its further documents go on
clockwise to the next shard that is not. With ``slack`` 0 and loads in rows the
capacities are the quotient rows / shards and that plus one for the remainder,
so the counts are at most one apart (law ``rows``). A larger ``slack`` moves
fewer documents when a shard is added.

As a Spark job. The order is a range partitioning, written once: a row's
number is its partition's offset plus its place there, whatever key is hot.
Only the moments at which shards become full are needed, at most one each.
The documents are counted by arc of the ring and stretch of the order, a
stretch in which a shard fills is split and counted again, until the row is
known. The driver sees at most ``BINS`` x arcs counts or ``LEAF`` rows at a
time, whatever the input. Slots are numbered by partition and shard. Only
DataFrame functions run on the executors.

Defined results: null text has size 1 and crc32 0; a null doc_id is hashed
as the empty text and comes before other ids of equal hash. Rows of one doc_id
share a place on the ring; they are ordered by crc32, size and place in the
input, so equal rows are interchangeable. Other columns play no part. An empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import stored

SHARDS = 8
POINTS = 64                    # virtual nodes of a shard
BINS = 128                     # stretches of one count
LEAF = 4096                    # rows of a stretch that are looked at one by one
MOST = 1 << 22                 # arcs x fillings held in a broadcast at most
_BITS = 33                     # monotonically_increasing_id: partition above, row below


def ring(shards: int, points: int) -> tuple[int, list[tuple[int, int]]]:
    """Bits of a place (the first of a 32-bit hash, so that a finer ring keeps
    the order), and (place, shard) of all virtual nodes, clockwise."""
    bits = (16 * shards * points - 1).bit_length()
    return bits, sorted((int(hashlib.md5(f"{s}/{v}".encode()).hexdigest()[:8], 16) >> 32 - bits, s)
                        for s in range(shards) for v in range(points))


def owners(nodes: list[tuple[int, int]], full: set[int]) -> list[int]:
    """The shard of each arc: that of its node or, past full ones, the next."""
    out, last = [0] * len(nodes), -1
    for i in range(2 * len(nodes) - 1, -1, -1):
        if nodes[i % len(nodes)][1] not in full:
            last = nodes[i % len(nodes)][1]
        out[i % len(nodes)] = last
    return out


def _ordered(docs: DataFrame, bits: int, nodes: list[tuple[int, int]], carry: bool) -> DataFrame:
    """The documents in their order: doc_id, size, text_crc32, arc, at (the
    order, as partition and row in it) and, with ``carry``, all columns as doc."""
    spark = docs.sparkSession
    at = [p for p, _ in nodes]
    arcs = spark.createDataFrame([(p, bisect.bisect_left(at, p) % len(nodes)) for p in range(1 << bits)],
                                 "place int, arc int", verifySchema=False)
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - bits).cast("int").alias("place"),
        F.conv(F.substring(digest, 9, 8), 16, 10).cast("long").alias("turn"),
        F.monotonically_increasing_id().alias("row"),
        *([F.struct(*docs.columns).alias("doc")] if carry else []))
    order = ["turn", F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "row"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (rows.join(F.broadcast(arcs), "place")
            .repartitionByRange(n, *order).sortWithinPartitions(*order)
            .select("doc_id", "size", "text_crc32", "arc", *(["doc"] if carry else []),
                    F.monotonically_increasing_id().alias("at")))


class _Order:
    """The stored order with row numbers: which rows are where."""

    def __init__(self, table: DataFrame, weight):
        self.spark = table.sparkSession
        part = F.shiftright("at", _BITS)
        found = table.groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.sum(weight).alias("w")).orderBy("part").collect()
        self.parts, self.first, self.rows, self.total = [], [], 0, 0
        for r in found:                        # one row per partition
            self.parts.append(r["part"])
            self.first.append(self.rows)
            self.rows += r["n"]
            self.total += r["w"]
        offsets = self.spark.createDataFrame(list(zip(self.parts, self.first)), "part long, first long")
        self.table = table.withColumn("part", part).withColumn("weight", weight)
        self.numbered = (self.table.join(F.broadcast(offsets), "part")
                         .withColumn("number", F.col("first") + F.col("at").bitwiseAND((1 << _BITS) - 1))
                         .drop("first"))

    def at(self, number: int) -> int:
        """``at`` of a row number; the filter on it prunes the stored files."""
        if number >= self.rows:
            return 1 << 62
        i = bisect.bisect_right(self.first, number) - 1
        return self.parts[i] << _BITS | number - self.first[i]

    def split(self, begin: int, end: int) -> list[tuple[int, int, dict[int, int]]]:
        """The stretch in at most BINS parts (or rows): begin, end and the
        weight of each arc in it."""
        here = (F.col("at") >= self.at(begin)) & (F.col("at") < self.at(end))
        if end - begin <= LEAF:
            first = dict(zip(self.parts, self.first))
            rows = self.table.filter(here).select("part", "at", "arc", "weight").collect()
            alone = sorted((first[r["part"]] + r["at"] % (1 << _BITS), r["arc"], r["weight"]) for r in rows)
            return [(n, n + 1, {arc: w}) for n, arc, w in alone]
        width = math.ceil((end - begin) / BINS)
        bins = (self.numbered.filter(here)
                .groupBy(F.floor((F.col("number") - begin) / width).cast("long").alias("bin"), "arc")
                .agg(F.sum("weight").alias("w")).collect())
        out: dict[int, dict[int, int]] = {}
        for r in bins:
            out.setdefault(r["bin"], {})[r["arc"]] = r["w"]
        return [(begin + b * width, min(end, begin + (b + 1) * width), out[b]) for b in sorted(out)]


def _fillings(order: _Order, nodes, capacity: list[int]) -> tuple[list[int], list[list[int]]]:
    """Row numbers from which on one more shard is full, and the shard of
    every arc before, between and after them."""
    loads, full = [0] * len(capacity), {s for s, c in enumerate(capacity) if not c}
    starts, maps = [], [owners(nodes, full)]
    todo = deque([(0, order.rows, None)])
    while todo and len(full) < len(capacity) - 1:
        begin, end, weights = todo.popleft()
        if weights is None:
            todo.extendleft(reversed(order.split(begin, end)))
            continue
        more = [0] * len(capacity)
        for arc, w in weights.items():
            more[maps[-1][arc]] += w
        filled = [s for s, w in enumerate(more) if w and loads[s] + w >= capacity[s]]
        if filled and end - begin > 1:
            todo.appendleft((begin, end, None))
            continue
        loads = [a + b for a, b in zip(loads, more)]
        if filled:
            full.update(filled)
            starts.append(end)
            maps.append(owners(nodes, full))
    return starts, maps


def capacities(total: int, shards: int, load: str, slack: float) -> list[int]:
    if load == "rows" and not slack:
        return [total // shards + (s < total % shards) for s in range(shards)]
    return [max(1, math.ceil((1 + slack) * total / shards))] * shards


def place(docs: DataFrame, shards: int = SHARDS, points: int = POINTS, load: str = "rows",
          slack: float = 0.0, carry: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each
    shard) of every document; with ``carry`` its columns as struct ``doc``.

    ``load``: what a shard's capacity is counted in, ``rows`` or ``bytes``. A
    shard is full when its load has reached (1 + slack) x the mean."""
    if load not in ("rows", "bytes"):
        raise ValueError("load is rows or bytes")
    if shards < 1 or points < 1 or shards * shards * points > MOST or shards * points > 1 << 18:
        raise ValueError("too few or too many shards and points")
    spark = docs.sparkSession
    bits, nodes = ring(shards, points)
    table = stored(_ordered(docs, bits, nodes, carry), "op11-order")
    order = _Order(table, F.lit(1).cast("long") if load == "rows" else F.col("size"))
    capacity = capacities(order.total, shards, load, slack)
    starts, maps = _fillings(order, nodes, capacity)
    owner = spark.createDataFrame([(p, a, s) for p, m in enumerate(maps) for a, s in enumerate(m)],
                                  "phase int, arc int, shard int")
    phase = F.lit(0)
    for n in starts:
        phase = phase + (F.col("number") >= n).cast("int")
    put = (order.numbered.withColumn("phase", phase).join(F.broadcast(owner), ["phase", "arc"])
           .select("doc_id", "size", "text_crc32", "shard", "part", "at", *(["doc"] if carry else [])))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (put.groupBy("shard", "part").agg(F.count("*").alias("n"))
            .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("at"))
    return (put.withColumn("within", within).join(base, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("base") + F.col("within") - 1).alias("slot"), *(["doc"] if carry else [])))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """All columns of the documents as ``doc``, with slot, in folders shard=<n>."""
    (place(docs, carry=True, **options).select("shard", "slot", "doc")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def shard_query(docs: DataFrame) -> DataFrame:
    """The contract's rows: law ``rows`` over eight shards."""
    return place(docs).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                              F.lit(None).cast("int").alias("grown_shard"))
