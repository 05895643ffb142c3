"""Exact maximum inner product search (G14 over the whole catalogue).

Items are ordered by the norm of their vectors and cut into blocks. All users
score the first block, then those that need it the second, and so on: by the
Cauchy-Schwarz inequality no item of a later block can beat |user| x (largest
norm of that block), so a user whose n-th best score is above that is finished.
Vectors of popular items are long, so most users stop after a few blocks, and
none can miss an item.

A block is a bounded matrix: it is sent to the tasks, which multiply it with
batches of user vectors. What a user must not get (songs already played) is
joined per block, so its array is bounded by the block too. Each round is
written to the shared folder, and only unfinished users go on to the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.session import scratch_path

BLOCK = 4096                   # items of a block: block x rank doubles are broadcast
_SHIFT = 33                    # monotonically_increasing_id: partition above, row below
_ROUNDING = 1e-9               # of a score, so that a bound is never missed by rounding
_STATE = "user {key}, features array<float>, best array<struct<score: double, place: long>>, " \
         "scored long, done boolean"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_norm(items: DataFrame, item: str) -> DataFrame:
    """place (0, 1, ... from the longest vector on; ties by the item), the
    item, features and norm. Numbered by range partition and row, whose
    offsets are one row per partition."""
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    order = [F.col("norm").desc(), F.col(item).asc()]
    n = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _kept(items.select(item, "features", norm.alias("norm")).repartitionByRange(n, *order)
                 .sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "mips-items")
    part = F.shiftright("at", _SHIFT)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return _kept(rows.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        (F.col("first") + F.col("at") - F.shiftleft("part", _SHIFT)).alias("place"), item, "features", "norm"),
        "mips-places")


def _score(first: int, matrix: np.ndarray, next_norm: float, n: int):
    """One round: a function over Arrow batches of users (see _STATE, and
    ``not_these``: places of this block to leave out)."""
    def go(batches):
        size = len(matrix)
        for b in batches:
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            rows = b.num_rows
            if not rows:
                continue
            vectors = np.array(col["features"].to_pylist(), np.float64).reshape(rows, -1)
            score = vectors @ matrix.T
            for i, gone in enumerate(col["not_these"].to_pylist()):
                if gone:
                    score[i, np.array(gone) - first] = -np.inf
            # The n best of the block and those ahead; the place decides ties.
            top = np.argsort(-score, axis=1, kind="stable")[:, :n]
            best, done = [], []
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            for i, ahead in enumerate(col["best"].to_pylist()):
                own = [(-x["score"], x["place"]) for x in ahead]
                own += [(-score[i, j], first + int(j)) for j in top[i] if score[i, j] > -np.inf]
                own = sorted(own)[:n]
                best.append([{"score": -s, "place": p} for s, p in own])
                bound = norms[i] * next_norm
                done.append(len(own) == n and -own[-1][0] > bound + _ROUNDING * (1 + abs(bound)))
            yield pa.RecordBatch.from_arrays(
                [col["user"], col["features"],
                 pa.array(best, pa.list_(pa.struct([("score", pa.float64()), ("place", pa.int64())]))),
                 pa.array(np.asarray(col["scored"]) + size, pa.int64()), pa.array(done, pa.bool_())],
                names=["user", "features", "best", "scored", "done"])
    return go


def top_inner_products(users: DataFrame, user: str, items: DataFrame, item: str, n: int,
                       excluded: DataFrame, block: int = BLOCK) -> DataFrame:
    """user, rank, item, score and scored: the n items of largest inner product
    for each user, without the pairs (user, item) in ``excluded``. ``users`` and
    ``items`` hold ``features`` arrays of one length, keys are unique. Equal
    scores are ordered by the item's place (longer vector, then item). Users
    with fewer than n items left get those."""
    spark = users.sparkSession
    places = by_norm(items, item)
    # The longest vector of each block: one number per block.
    tops = [r["norm"] for r in places.filter(F.col("place") % block == 0).orderBy("place").select("norm").collect()]
    away = _kept(excluded.join(places.select(item, "place"), item).select(
        F.col(user).alias("user"), F.floor(F.col("place") / block).alias("block"), "place"), "mips-excluded")
    schema = _STATE.format(key=dict(users.dtypes)[user])
    state = users.select(
        F.col(user).alias("user"), "features",
        F.array().cast("array<struct<score: double, place: long>>").alias("best"),
        F.lit(0).cast("long").alias("scored"), F.lit(False).alias("done"))
    finished = []
    for k, _ in enumerate(tops):
        rows = (places.filter((F.col("place") >= k * block) & (F.col("place") < (k + 1) * block))
                .orderBy("place").select("features").collect())     # at most ``block``
        matrix = np.array([r["features"] for r in rows], np.float64)
        gone = away.filter(F.col("block") == k).groupBy("user").agg(F.collect_list("place").alias("not_these"))
        last = k + 1 == len(tops)
        step = state.join(gone, "user", "left").select("user", "features", "best", "scored", "not_these")
        state = _kept(step.mapInArrow(_score(k * block, matrix, 0.0 if last else tops[k + 1], n), schema),
                      "mips-round")
        if last:
            finished.append(state)
            break
        finished.append(state.filter("done"))
        state = state.filter("not done")
        if state.isEmpty():
            break
    out = finished[0] if finished else state
    for f in finished[1:]:
        out = out.unionByName(f)
    best = out.select("user", "scored", F.posexplode("best").alias("pos", "hit"))
    return best.select("user", "scored", (F.col("pos") + 1).alias("rank"), "hit.score", "hit.place").join(
        places.select("place", item), "place").select(
        F.col("user").alias(user), "rank", item, "score", "scored")
