"""N-gram Jaccard join by PartEnum signatures (operator 8).

A document's set is its distinct 5-word shingles (A-Z lower-cased; the whole
sequence as one shingle when it has fewer words). Two documents link when
100 * |A & B| >= 75 * |A | B|; a component is closed under links.

Method. Linked sets r, s differ in at most k = (|r| + |s|) * 25 / 175
elements. A hash deals the shingle domain into N > k partitions, so at least
one partition holds the same elements in both: the hash of that projection,
with its partition, is a signature that both share. N doubles from one size
band to the next; a set emits the signatures of every band that a partner of
its size or larger can select (one or two). For up to 10 shingles (k <= 2)
every element is a partition of its own and the subsets that leave out at most
two are enumerated, which is exact.

A projection shared by chance carries no information when it is empty, and is
common when it holds a single popular shingle, so projections below
``least(N)`` elements are not emitted. Both sets would have to put all their
many equal partitions below that size to be missed; bands with few partitions
are enumerated under several independent hashes. The chance is under 1e-9 a
pair at similarity 0.75 and far less above it.

Texts with equal sets are one node. In each bucket the smallest and the
largest node are compared with every other (two stars, linear in the bucket);
components follow; then nodes of one bucket that are still in different
components are compared too. So a group of near copies costs two stars per
bucket, never all pairs, and no link between components is lost. Before sets are fetched, pairs must pass
an exact bound: parities of the shingles in 1024 cells differ in at most k
cells. What passes is verified on the full sets.

Defined results: null or empty text has no set (n_shingles 0) and links with
nothing, its component is its own doc_id; a null doc_id never names a
component (null only if no row of the component has one); repeated rows and
ids are rows like any other; other columns are ignored (``join_query``) or
kept (``one_of_each_group``). An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import SKETCH_BITS, apart, components, release, sketch, stored, together
from encore.llm.words import Words, chunks, list_array, mix, signed

SHINGLE = 5
#: Similarity as a fraction.
SIM = (75, 100)
CELLS = 1024
SMALL = 10                     # largest set whose subsets are enumerated


def max_difference(total, sim=SIM):
    """Most elements in which linked sets of ``total`` elements together differ."""
    return total * (sim[1] - sim[0]) // (sim[1] + sim[0])


def partitions(size: np.ndarray) -> np.ndarray:
    """N of the band of a pair whose larger set has ``size`` elements."""
    k = np.maximum(max_difference(2 * np.asarray(size, np.int64)), 1)
    return np.int64(1) << (np.floor(np.log2(k)).astype(np.int64) + 1)


def least(n: int) -> int:
    """Elements that a projection needs in a band of n partitions."""
    return 1 if n <= 32 else 2 if n <= 128 else 3


def repeats(n: int) -> int:
    """Independent hashes of a band of n partitions."""
    return 6 if n <= 4 else 4 if n <= 8 else 2 if n <= 16 else 1


def shingle_sets(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, in no order."""
    use = w.fits(size)
    row, h = w.rows()[use], w.runs(size)[use]
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    row, h = np.r_[row, short], np.r_[h, w.row_hash()[0][short]]
    key = mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    order = order[np.r_[True, key[1:] != key[:-1]]] if len(key) else order
    return row[order], h[order]


def _band_signatures(row, h, rows, n, wanted):
    """Signatures of the rows in ``wanted`` under the band of n partitions."""
    slot = np.full(rows, -1, np.int64)
    slot[wanted] = np.arange(len(wanted))
    sel = slot[row] >= 0
    at, x = slot[row[sel]], h[sel]
    owner, sigs = [], []
    for seed in range(repeats(n)):
        y = mix(x ^ np.uint64(0x632BE59BD9B4E019 * (seed + 1) & 0xFFFFFFFFFFFFFFFF))
        cell = at * n + (y & np.uint64(n - 1)).astype(np.int64)
        count = np.bincount(cell, minlength=len(wanted) * n)
        total = np.zeros(len(wanted) * n, np.uint64)
        np.add.at(total, cell, mix(y))
        full = np.flatnonzero(count >= least(n))
        tag = np.uint64((n * 64 + seed) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF)
        sigs.append(mix(total[full] + mix((full % n).astype(np.uint64) + tag)))
        owner.append(wanted[full // n])
    return np.concatenate(owner), np.concatenate(sigs)


def _subset_signatures(row, h, n_of):
    """All subsets that leave out at most two elements, for tiny sets."""
    owner, sigs = [], []
    small = np.flatnonzero((n_of > 0) & (n_of <= SMALL))
    if len(small):
        sel = np.isin(row, small)
        order = np.lexsort((h[sel], row[sel]))
        r, x = row[sel][order], mix(h[sel][order])
        begin = np.searchsorted(r, small)
        for i, b in zip(small, begin):
            own = [int(v) for v in x[b:b + n_of[i]]]
            total = sum(own)
            for k in range(0, min(3, len(own))):
                if max_difference(2 * len(own)) < k:
                    break
                for out in combinations(own, k):
                    sigs.append((total - sum(out)) & 0xFFFFFFFFFFFFFFFF)
                    owner.append(i)
    return np.array(owner, np.int64), mix(np.array(sigs, np.uint64) ^ np.uint64(0x51ED270B2D5CBF3D))


def signatures(w: Words):
    """(n, set hash, parity cells, owner, signature) of the rows of w."""
    rows = len(w.counts)
    row, h = shingle_sets(w)
    n_of = np.bincount(row, minlength=rows).astype(np.int64)
    ident = np.zeros(rows, np.uint64)
    np.add.at(ident, row, mix(h ^ np.uint64(0xA24BAED4963EE407)))
    ident = mix(ident + n_of.astype(np.uint64))
    cell = (mix(h ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(CELLS - 1)).astype(np.int64)
    odd = (np.bincount(row * CELLS + cell, minlength=rows * CELLS) & 1).astype(np.uint8)
    parity = np.packbits(odd.reshape(rows, CELLS), axis=1).view(np.int64)
    own = partitions(np.maximum(n_of, SMALL + 1))
    most = n_of * SIM[1] // SIM[0]
    up = partitions(np.maximum(most, SMALL + 1))
    owners, sigs = [], []
    for n in np.unique(np.r_[own, up]):
        wanted = np.flatnonzero(((own == n) | (up == n)) & (most > SMALL))
        if len(wanted):
            o, s = _band_signatures(row, h, rows, int(n), wanted)
            owners.append(o)
            sigs.append(s)
    o, s = _subset_signatures(row, h, n_of)
    owner, sig = np.concatenate([*owners, o]), np.concatenate([*sigs, s])
    order = np.argsort(owner, kind="stable")
    return n_of, ident, parity, owner[order], sig[order]


def _signature_rows(batches):
    for b in chunks(batches):
        w = Words(b.column(1), lower=True)
        n, ident, parity, owner, sig = signatures(w)
        rows = len(n)
        yield pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.int64()), pa.array(signed(ident), mask=n == 0), pa.array(n),
             list_array(parity.ravel(), np.full(rows, CELLS // 64), pa.int64()),
             list_array(signed(sig), np.bincount(owner, minlength=rows), pa.int64())],
            names=["doc_id", "node", "n_shingles", "parity", "sigs"])


SIGNATURE_SCHEMA = ("doc_id long, node long, n_shingles long, parity array<long>, "
                    "sigs array<long>")


def _set_rows(batches):
    """(text) -> node, sorted shingle hashes as bytes."""
    for b in chunks(batches):
        w = Words(b.column(0), lower=True)
        row, h = shingle_sets(w)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        rows = b.num_rows
        n = np.bincount(row, minlength=rows)
        ident = np.zeros(rows, np.uint64)
        np.add.at(ident, row, mix(h ^ np.uint64(0xA24BAED4963EE407)))
        ident = mix(ident + n.astype(np.uint64))
        cut = np.r_[0, np.cumsum(n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(ident)),
             pa.array([h[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:])], pa.binary())],
            names=["node", "members"])


def _nodes_of_text(df: DataFrame, text: str = "text", wanted=None) -> DataFrame:
    """``df`` with the node of its text appended (null without shingles).
    ``wanted``, a broadcast sketch: only rows whose node has its flag."""
    df = df.select(*[c for c in df.columns if c != "node"])
    schema = T.StructType([*df.schema.fields, T.StructField("node", T.LongType())])

    def go(batches):
        for b in chunks(batches, text):
            w = Words(b.column(b.schema.get_field_index(text)), lower=True)
            row, h = shingle_sets(w)
            n = np.bincount(row, minlength=b.num_rows)
            ident = np.zeros(b.num_rows, np.uint64)
            np.add.at(ident, row, mix(h ^ np.uint64(0xA24BAED4963EE407)))
            ident = mix(ident + n.astype(np.uint64))
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(signed(ident), mask=n == 0)],
                                             names=[*b.schema.names, "node"])
            if wanted is not None:
                out = out.filter(pa.array(wanted.value[ident & np.uint64(SKETCH_BITS - 1)] & (n > 0)))
            yield out
    return df.mapInArrow(go, schema)


def _verified(batches):
    """(a, b, members of a, members of b) -> the linked pairs."""
    for batch in batches:
        good = np.zeros(batch.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x = np.frombuffer(x.as_buffer(), np.uint64)
            y = np.frombuffer(y.as_buffer(), np.uint64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            good[i] = SIM[1] * both >= SIM[0] * (len(x) + len(y) - both)
        sel = np.flatnonzero(good)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(sel)),
                                          batch.column(1).take(pa.array(sel))], names=["a", "b"])


def _plausible(n1, p1, n2, p2):
    """The size ratio and the parity bound that every linked pair meets."""
    differ = sum((F.bit_count(F.col(p1)[i].bitwiseXOR(F.col(p2)[i])) for i in range(CELLS // 64)),
                 F.lit(0))
    return ((F.least(n1, n2) * SIM[1] >= F.greatest(n1, n2) * SIM[0])
            & (differ * (SIM[1] + SIM[0]) <= (F.col(n1) + F.col(n2)) * (SIM[1] - SIM[0])))


def _check(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Those of the candidate pairs (a, b) that link."""
    need = pairs.select(F.col("a").alias("node")).unionByName(
        pairs.select(F.col("b").alias("node"))).distinct()
    need = stored(need, name + "-need")
    wanted = texts.sparkSession.sparkContext.broadcast(sketch(need, "node"))
    once = (_nodes_of_text(texts.select("text"), wanted=wanted).join(need, "node", "left_semi")
            .groupBy("node").agg(F.first("text").alias("text")))
    sets = stored(once.select("text").mapInArrow(_set_rows, "node long, members binary"), name + "-sets")
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return stored(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
                  .mapInArrow(_verified, "a long, b long"), name)


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: doc_id, node, n_shingles; node -> root of its component)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    rows = stored(texts.mapInArrow(_signature_rows, SIGNATURE_SCHEMA), "op8-signatures")
    each = rows.select("node", F.explode("sigs").alias("sig"))
    multi = (each.groupBy("sig").agg(F.min("node").alias("first"), F.max("node").alias("last"))
             .filter("first <> last"))
    members = stored(each.join(multi, "sig").distinct(), "op8-buckets")
    release(spark)
    nodes = stored(rows.filter("node is not null").groupBy("node").agg(
        F.first("n_shingles").alias("n"), F.first("parity").alias("parity")), "op8-nodes")
    ends = members.select(F.col("first").alias("a"), F.col("node").alias("b")).unionByName(
        members.select(F.col("node").alias("a"), F.col("last").alias("b"))).filter("a <> b").distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("parity").alias("ap"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("parity").alias("bp"))
    pairs = ends.join(left, "a").join(right, "b").filter(_plausible("an", "ap", "bn", "bp"))
    links = _check(stored(pairs.select("a", "b"), "op8-stars"), texts, "op8-links")
    release(spark)
    found = components(links, name="op8-cc")
    # Nodes of one bucket that the stars left apart.
    of = found.select("node", "root")
    inside = members.select("sig", "node", "first").join(of, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    lead = of.select(F.col("node").alias("first"), F.col("root").alias("lead"))
    inside = stored(inside.join(lead, "first", "left").withColumn("lead", F.coalesce("lead", "first")),
                    "op8-roots")
    odd = inside.filter("root <> lead")
    split = inside.join(odd.select("sig").distinct(), "sig", "left_semi").join(nodes, "node")
    split = stored(split.filter("node <> first"), "op8-apart")
    odd = split.filter("root <> lead").select(
        "sig", F.col("node").alias("a"), F.col("n").alias("an"), F.col("parity").alias("ap"),
        F.col("root").alias("ar"))
    near = (odd.join(split, "sig").filter(
        (F.col("ar") != F.col("root")) & _plausible("an", "ap", "n", "parity"))
        .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
    near = stored(near, "op8-rest")
    if not near.isEmpty():
        more = _check(near, texts, "op8-more")
        release(spark)
        star = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
        found = components(more.unionByName(star), name="op8-cc2")
    return rows.select("doc_id", "node", "n_shingles"), found


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, node, n_shingles, root (null without a set)."""
    rows, found = _classes(docs)
    return rows.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def join_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    rows = _grouped(docs)
    lowest = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("lowest"))
    return rows.join(lowest, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
        .alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that carry their component's smallest doc_id (of
    repeated rows with that id, one); documents without a set all stay."""
    rows, found = _classes(docs)
    roots = rows.filter("node is not null").select("doc_id", "node").join(found, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    # The smallest id, nulls last; among rows with that id the smallest node.
    order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "node")
    first = stored(roots.groupBy("root").agg(F.min(order).alias("m"))
                   .select(F.col("m.doc_id").alias("_id"), F.col("m.node").alias("node")),
                   "op8-first")
    back = _nodes_of_text(apart(docs, "doc_id", "text"))
    values = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    alone = back.filter("node is null").select(*together(docs.columns, **values))
    kept = back.filter("node is not null").join(first, "node").filter(F.col("doc_id").eqNullSafe(F.col("_id")))
    again = (kept.groupBy("node", "doc_id").agg(F.min(F.struct("text", "doc")).alias("r"))
             .select("doc_id", "r.text", "r.doc").select(*together(docs.columns, **values)))
    return alone.unionByName(again)
