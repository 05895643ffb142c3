"""Embedding near-duplicates by an exact metric range join (operator 10).

Vectors of equal label (and length) link when their cosine is at least
``COSINE``. On unit vectors that is a Euclidean distance of at most
r = sqrt(2 - 2 * COSINE), so the join is a range join in a metric space.

Method. Pivots of each large label partition its vectors by the nearest pivot.
Let x live in the cell of pivot p and y in that of q. By the triangle
inequality d(x, y) <= r implies d(y, p) - d(y, q) <= 2r; in Euclidean space
the distance of y to the plane between p and q gives the tighter
(d(y, p)^2 - d(y, q)^2) / (2 d(p, q)) <= r. Every y within that bound is
copied to the cell of p, so each cell finds all partners of its own vectors
without the others. The number of pivots (a power of 4) is chosen per label on
a sample: the one with the least estimated comparisons among those that copy a
vector to at most ``COPIES`` cells on average; it never affects the result.

Equal vectors are one node with a count. A cell over ``BLOCK`` vectors is
split: blocks of own vectors meet blocks of all vectors, in groups of their
own. A group returns for each vector its number of links and the root of its
component within the group, never pairs.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and rows without a label, link with nothing (n_links 0,
component_id = vec_id, kept); a null vec_id never names a component and is not
kept; repeated rows are vectors like any other; other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import components, stored

COSINE = 0.98
BLOCK = 2048
COPIES = 6.0
SAMPLE = 2000                  # nodes per label that choose the pivots
LABELS = 512                   # labels that get pivots, largest first
MOST_PIVOTS = 1024             # per label
SLACK = 1e-9


def _unit_rows(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat values, offsets, usable) of a list column as doubles."""
    arr = arr.cast(pa.large_list(pa.float64()))
    off = arr.offsets.to_numpy()
    flat = arr.values.to_numpy(zero_copy_only=False).astype(np.float64)[off[0]:off[-1]]
    off = off - off[0]
    usable = arr.is_valid().to_numpy(zero_copy_only=False) & (np.diff(off) > 0)
    bad = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    some = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(flat != 0, out=some[1:])
    usable &= (bad[off[1:]] == bad[off[:-1]]) & (some[off[1:]] > some[off[:-1]])
    return flat, off, usable


def _prepare(batches):
    """(vec_id, label, embedding) -> vec_id, label, vec (unit doubles, null
    where the row links with nothing)."""
    for b in batches:
        flat, off, ok = _unit_rows(b.column(2))
        ok &= b.column(1).is_valid().to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * b.num_rows
        for i in np.flatnonzero(ok):
            v = flat[off[i]:off[i + 1]]
            v = v / np.abs(v).max()
            out[i] = (v / np.sqrt((v * v).sum())).tobytes()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())],
                                         names=["vec_id", "label", "vec"])


def _matrix(col) -> np.ndarray:
    """Equal-length unit vectors of a binary column as rows."""
    raw = b"".join(v.as_py() for v in col)
    return np.frombuffer(raw, np.float64).reshape(len(col), -1)


def _copies(x: np.ndarray, pivots: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
    """(own cell of each row, row x cell: belongs there, own cell included)."""
    cos = x @ pivots.T
    home = cos.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * pivots @ pivots.T))
    gap = cos[np.arange(len(x)), home][:, None] - cos        # (d(p)^2 - d(q)^2) / 2
    near = gap <= (r + SLACK) * apart[home] + SLACK
    near[np.arange(len(x)), home] = True
    return home, near


def choose_pivots(sample: np.ndarray, n: int, r: float) -> np.ndarray:
    """Pivots for n vectors of which ``sample`` are some."""
    best, cost = sample[:1], float(n) * n
    count = 4
    while count <= min(len(sample) // 2, MOST_PIVOTS) and n > BLOCK // 4 * count:
        pivots = sample[:count]
        home, near = _copies(sample, pivots, r)
        if near.sum() / len(sample) <= COPIES:
            scale = n / len(sample)
            work = float((np.bincount(home, minlength=count) * near.sum(axis=0)).sum()) * scale * scale
            if work < cost:
                best, cost = pivots, work
        count *= 4
    return best


def _assign(pivots, r: float):
    """node rows -> a row per cell: label, dim, cell, own, node, n, vec."""

    def go(batches):
        known = pivots.value
        for b in batches:
            label, dim = b.column(1).to_numpy(), b.column(2).to_numpy()
            for key in sorted(set(zip(label.tolist(), dim.tolist()))):
                sel = np.flatnonzero((label == key[0]) & (dim == key[1]))
                part = b.take(pa.array(sel))
                if key in known:
                    home, near = _copies(_matrix(part.column(4)), known[key], r)
                    row, cell = np.nonzero(near)
                    own = cell == home[row]
                else:
                    row = np.arange(len(sel))
                    cell, own = np.zeros(len(sel), np.int64), np.ones(len(sel), bool)
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.array(cell.astype(np.int32)), pa.array(own),
                     part.column(0), part.column(3), part.column(4)],
                    names=["label", "dim", "cell", "own", "node", "n", "vec"])
    return go


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member number of the component of each of n nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        if (new == root).all():
            return root
        root = new


def _join_block(cosine: float):
    def go(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node = rows["node"].to_numpy()
        n = rows["n"].to_numpy()
        vec = _matrix(rows["vec"])
        xs = np.flatnonzero(rows["as_own"].to_numpy())
        ys = np.flatnonzero(rows["as_other"].to_numpy())
        links = np.zeros(len(node), np.int64)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        root = np.arange(len(node))
        right = vec[ys].T
        for i in range(0, len(xs), 256):
            part = xs[i:i + 256]
            hit = vec[part] @ right >= cosine
            hit &= node[part][:, None] != node[ys][None, :]
            links[part] = hit @ n[ys]
            a, b = np.nonzero(hit)
            pairs.append((part[a], ys[b]))
            if sum(len(p[0]) for p in pairs) > 2_000_000:
                root = _forest(np.r_[np.arange(len(node)), *(p[0] for p in pairs)],
                               np.r_[root, *(p[1] for p in pairs)], len(node))
                pairs = []
        root = _forest(np.r_[np.arange(len(node)), *(p[0] for p in pairs)],
                       np.r_[root, *(p[1] for p in pairs)], len(node))
        use = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
        return pa.table({"node": node[use], "links": links[use], "root": node[root[use]]})
    return go


def _linked(nodes: DataFrame, cosine: float) -> DataFrame:
    """node, links (rows), root of each node with a partner, per group."""
    spark = nodes.sparkSession
    r = float(np.sqrt(2 - 2 * cosine))
    large = (nodes.groupBy("label", "dim").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK // 2)
             .orderBy(F.desc("n"), "label", "dim").limit(LABELS).collect())
    pivots = {}
    if large:
        share = F.lit(0)
        for x in large:
            cut = min(1_000_000, SAMPLE * 1_000_000 // x["n"] + 1)
            share = F.when((F.col("label") == x["label"]) & (F.col("dim") == x["dim"]), F.lit(cut)).otherwise(share)
        some = (nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share)
                .select("label", "dim", "vec", F.xxhash64("node").alias("o")).orderBy("o").toArrow())
        for x in large:
            sel = pc.and_(pc.equal(some["label"], x["label"]),
                                  pc.equal(some["dim"], x["dim"]))
            own = some.filter(sel)
            if own.num_rows > 1:
                pivots[(x["label"], x["dim"])] = choose_pivots(_matrix(own["vec"]), x["n"], r)
    held = spark.sparkContext.broadcast(pivots)    # at most LABELS * MOST_PIVOTS vectors
    cells = nodes.select("node", "label", "dim", "n", "vec").mapInArrow(
        _assign(held, r), "label int, dim int, cell int, own boolean, node long, n long, vec binary")
    cells = stored(cells, "op10-cells")
    at = ["label", "dim", "cell"]
    sizes = cells.groupBy(*at).agg(F.sum(F.col("own").cast("int")).alias("h"), F.count("*").alias("t")) \
        .filter("h > 0").select(*at, F.ceil(F.col("h") / BLOCK).cast("int").alias("hb"),
                                F.ceil(F.col("t") / BLOCK).cast("int").alias("tb"))
    block = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30))
    rows = cells.join(sizes, at).withColumn("i", (block % F.col("hb")).cast("int")) \
        .withColumn("j", (block % F.col("tb")).cast("int"))
    # Own rows meet every block of the cell; every row meets every block of
    # own rows. In a cell of one block that is one row each.
    as_own = F.expr("IF(own, transform(sequence(0, tb - 1), k -> named_struct('i', i, 'j', k, "
                    "'as_own', true, 'as_other', k = j)), array())")
    as_other = F.expr("filter(transform(sequence(0, hb - 1), k -> named_struct('i', k, 'j', j, "
                      "'as_own', false, 'as_other', true)), s -> NOT (own AND s.i = i))")
    dealt = rows.withColumn("g", F.explode(F.concat(as_own, as_other))).select(
        *at, F.col("g.i").alias("bi"), F.col("g.j").alias("bj"), F.col("g.as_own"), F.col("g.as_other"),
        "node", "n", "vec")
    return stored(dealt.groupBy(*at, "bi", "bj").applyInArrow(
        _join_block(cosine), "node long, links long, root long"), "op10-links")


def join_query(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("label").cast("int").alias("label"), "embedding")
    rows = slim.mapInArrow(_prepare, "vec_id long, label int, vec binary")
    rows = stored(rows.withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec"))),
                  "op10-rows")
    nodes = stored(rows.filter("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vec").alias("vec"), F.count("*").alias("n"))
        .withColumn("dim", (F.octet_length("vec") / 8).cast("int")), "op10-nodes")
    found = _linked(nodes, cosine)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), name="op10-cc")
    rows = (rows.select("vec_id", "node").join(nodes.select("node", "n"), "node", "left")
            .join(links, "node", "left").join(roots, "node", "left")
            .withColumn("root", F.coalesce("root", "node")))
    lowest = rows.filter("root is not null").groupBy("root").agg(F.min("vec_id").alias("lowest"))
    out = rows.join(lowest, "root", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("lowest")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
