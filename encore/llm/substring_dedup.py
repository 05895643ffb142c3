"""Substring dedup by difference-cover anchors (operator 6).

A word of a document is removed when some window of ``size`` consecutive
words covers it whose word sequence also starts in a document with a smaller
doc_id. Windows are judged on the input, not on what is left.

Method. D is a difference cover modulo a period v: every difference modulo v
is the difference of two members of D. Anchors are the hashes of runs of
``size - v + 1`` words that start at positions congruent to a member of D.
Two equal windows at positions i and j share an aligned anchor: some shift
s < v brings both i + s and j + s onto the cover. So only |D| / v of the
positions are hashed and shuffled, and a window without an anchor that a
second text contains cannot be shared. Around the shared anchors the windows
are extended to full length (two 64-bit hashes) and the smallest doc_id of
each is found by an aggregation: no pair of documents is ever formed, so a
passage in a third of all documents costs one row per occurrence.

Texts with the same words are handled once: among them the smallest doc_id
stands for all; every other copy long enough for a window goes whole.

Defined results: null or empty text has no words; a null doc_id counts as the
largest one; rows that repeat a doc_id are judged one by one against smaller
ids, never against their own; other columns are ignored (``dedup_query``) or
carried along (``remove_repeats``). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import NULL_ID, SKETCH_BITS, apart, release, sketch, stored, together
from encore.llm.words import Words, chunks, list_array, signed

WINDOW = 50
#: A perfect difference set modulo 31 (6 of 31 positions).
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)


def cover_positions(n: int, period: int = PERIOD, cover=COVER) -> np.ndarray:
    """Ascending positions below n that are congruent to the cover."""
    full = np.arange((n + period - 1) // period + 1)[:, None] * period + np.array(cover)
    flat = full.ravel()
    return flat[flat < n]


def check_cover(period: int = PERIOD, cover=COVER) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _is_cover(pos: np.ndarray, period: int, cover) -> np.ndarray:
    hit = np.zeros(period, dtype=bool)
    hit[list(cover)] = True
    return hit[pos % period]


def text_anchors(size: int = WINDOW, period: int = PERIOD, cover=COVER):
    """Batches of (doc_id, text) -> doc_id, h1, h2 (hashes of all words),
    n_words, full_sha256 (of the words joined by a blank) and the anchors in
    order of position."""
    run = size - period + 1

    def go(batches):
        for b in chunks(batches):
            w = Words(b.column(1))
            h1, h2 = w.row_hash()
            pos = np.arange(len(w)) - np.repeat(w.row[:-1], w.counts)
            use = w.fits(run) & _is_cover(pos, period, cover)
            n = w.sums(use)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(signed(h1)), pa.array(signed(h2)),
                 pa.array(w.counts.astype(np.int64)),
                 pa.array(_joined_sha(w, np.ones(len(w), bool))),
                 list_array(signed(w.runs(run)[use]), n, pa.int64())],
                names=["doc_id", "h1", "h2", "n_words", "full_sha256", "anchors"])
    return go


def _joined_sha(w: Words, keep: np.ndarray) -> list[str]:
    raw = w.raw.tobytes()
    out = []
    for r in range(len(w.row) - 1):
        sel = np.flatnonzero(keep[w.row[r]:w.row[r + 1]]) + w.row[r]
        out.append(hashlib.sha256(
            b" ".join([raw[s:e] for s, e in zip(w.start[sel], w.end[sel])])).hexdigest())
    return out


ANCHOR_SCHEMA = ("doc_id long, h1 long, h2 long, n_words long, full_sha256 string, "
                 "anchors array<long>")


def with_hash(df: DataFrame, text: str = "text", wanted=None) -> DataFrame:
    """``df`` with the hashes h1, h2 of the words of its text appended
    (under these names; a column of the input that is called so is lost).
    ``wanted``, a broadcast sketch: only rows whose h1 has its flag."""
    keep = [c for c in df.columns if c not in ("h1", "h2")]
    df = df.select(*keep)
    schema = T.StructType(df.schema.fields + [T.StructField("h1", T.LongType()),
                                              T.StructField("h2", T.LongType())])

    def go(batches):
        for b in chunks(batches, text):
            h1, h2 = Words(b.column(b.schema.get_field_index(text))).row_hash()
            out = pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(signed(h1)), pa.array(signed(h2))],
                names=[*b.schema.names, "h1", "h2"])
            if wanted is not None:
                out = out.filter(pa.array(wanted.value[h1 & np.uint64(SKETCH_BITS - 1)]))
            yield out
    return df.mapInArrow(go, schema)


def window_rows(size: int = WINDOW, period: int = PERIOD, cover=COVER):
    """Batches of (first_id, text_no, text, shared), shared being the anchors
    (by number in their text) that a second text has -> every window around
    them, named by 96 hash bits."""
    run = size - period + 1

    def go(batches):
        for b in chunks(batches):
            w = Words(b.column(2))
            shared = b.column(3)
            n = len(w)
            near = np.zeros(n + 1, np.int64)
            flat = shared.flatten().to_numpy()
            per = pc.list_value_length(shared).to_numpy()
            k = len(cover)
            at = flat // k * period + np.array(sorted(cover))[flat % k]
            at = at + np.repeat(w.row[:-1], per)
            lo = np.maximum(at - (size - run), np.repeat(w.row[:-1], per))
            np.add.at(near, lo, 1)
            np.add.at(near, at + 1, -1)
            use = (np.cumsum(near[:-1]) > 0) & w.fits(size)
            i = np.flatnonzero(use)
            row = w.rows()[i]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(w.runs(size)[i])),
                 pa.array((w.runs(size, second=True)[i] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                 b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)),
                 pa.array((i - w.row[:-1][row]).astype(np.int32))],
                names=["w1", "w2", "first_id", "text_no", "at"])
    return go


def _covered(w: Words, starts: pa.Array, size: int) -> np.ndarray:
    """True for each word covered by a window that starts at one of the
    listed positions of its row."""
    flat = starts.flatten().to_numpy()
    per = pc.list_value_length(starts).fill_null(0).to_numpy(zero_copy_only=False)
    at = flat + np.repeat(w.row[:-1], per.astype(np.int64))
    d = np.zeros(len(w) + 1, np.int64)
    np.add.at(d, at, 1)
    np.add.at(d, at + size, -1)
    return np.cumsum(d[:-1]) > 0


def kept_rows(size: int = WINDOW, as_text: bool = False):
    """Batches of (h1, h2, text, starts) -> h1, h2, n_removed and either the
    kept words joined by a blank or their sha256."""

    def go(batches):
        for b in chunks(batches):
            w = Words(b.column(2))
            gone = _covered(w, b.column(3), size)
            keep = ~gone
            n = w.sums(gone)
            if as_text:
                raw = w.raw.tobytes()
                value = []
                for r in range(b.num_rows):
                    sel = np.flatnonzero(keep[w.row[r]:w.row[r + 1]]) + w.row[r]
                    value.append(b" ".join([raw[s:e] for s, e in zip(w.start[sel], w.end[sel])])
                                 .decode("utf-8", "replace"))
            else:
                value = _joined_sha(w, keep)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n.astype(np.int64)), pa.array(value, pa.string())],
                names=["h1", "h2", "n_removed", "kept"])
    return go


def _judged(docs: DataFrame, size: int, as_text: bool) -> tuple[DataFrame, DataFrame]:
    """(rows of every document, result of each text that loses words but is
    the first of its copies)."""
    spark = docs.sparkSession
    slim = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    rows = slim.mapInArrow(text_anchors(size), ANCHOR_SCHEMA)
    rows = stored(rows.withColumn("text_no", F.monotonically_increasing_id()), "op6-anchors")
    first = stored(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"),
                                                F.min("text_no").alias("text_no")), "op6-first")
    # Anchors that at least two different texts contain.
    each = rows.join(first.select("text_no"), "text_no", "left_semi") \
        .select("text_no", F.posexplode("anchors").alias("k", "anchor"))
    shared = (each.groupBy("anchor").agg(F.min("text_no").alias("lo"), F.max("text_no").alias("hi"))
              .filter("lo <> hi").select("anchor"))
    marked = stored(each.join(shared, "anchor").groupBy("text_no")
                    .agg(F.sort_array(F.collect_list("k")).alias("shared")), "op6-shared")
    release(spark)
    # Texts to extend: one of each group of copies, read again with its marks.
    marks = stored(marked.join(first, "text_no"), "op6-marks")
    wanted = spark.sparkContext.broadcast(sketch(marks, "h1"))
    texts = stored(with_hash(slim.select("text"), wanted=wanted).join(marks, ["h1", "h2"]).groupBy("h1", "h2").agg(
        *[F.first(c).alias(c) for c in ("first_id", "text_no", "text", "shared")]), "op6-texts")
    release(spark)
    # Made twice rather than stored: the rows are larger than their texts.
    windows = texts.select("first_id", "text_no", "text", "shared").mapInArrow(
        window_rows(size), "w1 long, w2 int, first_id long, text_no long, at int")
    lowest = stored(windows.groupBy("w1", "w2").agg(F.min("first_id").alias("lowest"),
                                                    F.max("first_id").alias("highest"))
                    .filter("lowest < highest").drop("highest"), "op6-lowest")
    release(spark)
    starts = (windows.join(lowest, ["w1", "w2"]).filter("lowest < first_id")
              .groupBy("text_no").agg(F.collect_list("at").alias("starts")))
    kept = (texts.drop("shared").join(starts, "text_no")
            .select("h1", "h2", "text", "starts")
            .mapInArrow(kept_rows(size, as_text),
                        "h1 long, h2 long, n_removed long, kept string"))
    return rows.drop("anchors", "text_no").join(first.drop("text_no"), ["h1", "h2"]), kept


def dedup_query(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    rows, kept = _judged(docs, size, as_text=False)
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= size)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.join(kept, ["h1", "h2"], "left").select(
        F.nullif("doc_id", F.lit(NULL_ID)).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long")
        .alias("n_removed"),
        F.when(copy, empty).otherwise(F.coalesce("kept", "full_sha256")).alias("kept_sha256"))


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents with repeated words taken out of their text.

    A text that loses words becomes its kept words joined by one blank (and
    n_chars, where that column exists, their length); any other text stays as
    it is. A document that loses every word goes.
    """
    rows, kept = _judged(docs, size, as_text=True)
    firsts = rows.select("h1", "h2", "first_id", "n_words").distinct()
    info = stored(firsts.join(kept, ["h1", "h2"], "left")
                  .select("h1", "h2", "n_words", F.col("first_id").alias("_first"),
                          F.col("n_removed").alias("_gone"), F.col("kept").alias("_kept")),
                  "op6-kept")
    back = with_hash(apart(docs, "doc_id", "text")).join(info.withColumnRenamed("n_words", "_words"), ["h1", "h2"])
    own = F.coalesce(F.col("doc_id"), F.lit(NULL_ID))
    whole = ((own > F.col("_first")) & (F.col("_words") >= size)) | \
        ((F.col("_words") > 0) & (F.coalesce("_gone", F.lit(0)) >= F.col("_words")))
    values = {"doc_id": F.col("doc_id"), "text": F.coalesce("_kept", "text")}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(F.col("_kept").isNotNull(), F.length("_kept")).otherwise(
            F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return back.filter(~whole).select(*together(docs.columns, **values))
