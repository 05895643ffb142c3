"""Toxicity by cumulative-link ordinal regression (operator 7).

Labels say only toxic or not. Toxic training texts are graded by how much
toxic language they hold: grade 1 with fewer than 3 distinct toxic words,
2 with 3 to 5, 3 with 6 or more, where a toxic word is a feature at least
``ODDS`` times as likely in toxic texts. Grade 0 is not toxic.

Method. Features are the distinct words of a text and the distinct 5-byte runs
inside its words (ASCII case folded, outer marks dropped), hashed into
``BUCKETS``. The ``FEATURES`` with the largest likelihood-ratio statistic
against the label are kept. The model has one weight per feature, shared by
all grades, and ordered thresholds t1 < t2 < t3:
P(grade <= k) = sigmoid(t_(k+1) - w.x). It is fitted by gradient ascent on the
penalised likelihood; the expected severity is the sum of P(grade >= k).

The fit reads at most about ``SAMPLE`` labelled whole texts, chosen by a hash
of the id; feature counts are summed by Spark, and only the kept features of
the sample come to the driver (at most SAMPLE * FEATURES flags). Every text is
scored.

Defined results: null or empty text has no features, so it gets the severity
of a text without evidence; rows whose toxic label is null are not learned
from; several labels of one doc_id are all used; without training rows every
severity is 0; a null doc_id is scored and held_out is false; other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import crc_mod
from encore.llm.words import Words, chunks, mix

SAMPLE = 12_000                # labelled texts for the fit, about
BUCKETS = 1 << 20
FEATURES = 4096
RUN = 5                        # bytes of a run inside a word
ODDS = 20.0
GRADE_HITS = (3, 6)            # toxic words from which grades 2 and 3 begin
PENALTY = 2e-4
STEPS = 400
CUT = 0.5                      # P(grade >= 1) from which a text counts as toxic

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.zeros(256, dtype=bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, bucket) of the features of each text (with repeats), rows."""
    w = Words(arr, lower=True)
    rows = len(w.counts)
    raw = _LOWER[w.raw]
    # Outer marks do not belong to a word.
    start, end = w.start.copy(), w.end.copy()
    for _ in range(4):
        start += (start < end) & _MARK[raw[np.minimum(start, max(len(raw) - 1, 0))]] if len(raw) else 0
        end -= (end > start) & _MARK[raw[np.maximum(end - 1, 0)]] if len(raw) else 0
    row = w.rows()
    solid = end > start
    start, end, row = start[solid], end[solid], row[solid]
    # Words: a hash of the first and last 8 bytes and the length.
    x = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = end - start
    h = n.astype(np.uint64)
    for i in range(8):
        h = h * np.uint64(0x9E3779B97F4A7C15) + np.where(i < n, x[start + np.minimum(i, n - 1)], np.uint64(0))
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + np.where(i < n, x[np.maximum(end - 1 - i, start)], np.uint64(0))
    words = (mix(h) >> np.uint64(44)).astype(np.int64)
    # Runs inside words.
    many = np.maximum(n - RUN + 1, 0)
    at = np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())
    code = np.zeros(len(at), np.uint64)
    for i in range(RUN):
        code = code << np.uint64(8) | x[at + i]
    runs = (mix(code + np.uint64(1)) >> np.uint64(44)).astype(np.int64)
    return np.r_[row, np.repeat(row, many)], np.r_[words, runs], rows


@dataclass
class Model:
    """slot of each bucket (-1: not kept), weights by slot, thresholds."""

    slot: np.ndarray
    weight: np.ndarray
    thresholds: np.ndarray


def _flags(row, bucket, slot, rows):
    """Distinct (row, slot) of the kept features."""
    s = slot[bucket]
    keep = s >= 0
    both = np.unique(row[keep] * np.int64(1 << 20) + s[keep])
    return both >> 20, both & ((1 << 20) - 1)


def _count_rows(batches):
    """(toxic, text) -> toxic, bucket, texts with it; bucket -1: all texts."""
    total = np.zeros((2, BUCKETS), np.int64)
    texts = np.zeros(2, np.int64)
    for b in chunks(batches):
        row, bucket, rows = features(b.column(1))
        toxic = b.column(0).to_numpy().astype(np.int64)
        both = np.unique(row * BUCKETS + bucket)
        of = toxic[both // BUCKETS] * BUCKETS + both % BUCKETS
        total += np.bincount(of, minlength=2 * BUCKETS).reshape(2, BUCKETS)
        texts += np.bincount(toxic, minlength=2)
    y, k = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[y, 0, 1].astype(np.int32)), pa.array(np.r_[k, -1, -1].astype(np.int32)),
         pa.array(np.r_[total[y, k], texts])], names=["toxic", "bucket", "n"])


def _select(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept buckets, which of them are toxic words) by counts a of na toxic
    and b of nb other texts."""

    def part(n, of, share):
        return np.where(n > 0, n * np.log(np.maximum(n, 1e-9) / np.maximum(of * share, 1e-9)), 0)

    share = (a + b) / (na + nb)
    g = part(a, na, share) + part(b, nb, share) + part(na - a, na, 1 - share) + part(nb - b, nb, 1 - share)
    g[a + b < 3] = 0
    kept = np.argsort(-g, kind="stable")[:FEATURES]
    kept = np.sort(kept[g[kept] > 3.0])
    odds = ((a[kept] + 0.5) / (na + 1)) / ((b[kept] + 0.5) / (nb + 1))
    return kept, (odds >= ODDS) & (a[kept] >= 3)


def fit_ordinal(row: np.ndarray, slot: np.ndarray, y: np.ndarray, size: int,
                grades: int = 4, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model for flags
    (row, slot) and grades y, by Adam on the penalised log-likelihood."""
    n = len(y)
    w = np.zeros(size)
    share = np.cumsum(np.bincount(y, minlength=grades)[:-1] + 0.5) / (n + 0.5 * grades)
    t = np.log(share / (1 - share))
    p = np.r_[w, t[0], np.log(np.maximum(np.diff(t), 1e-3))]
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w = p[:size]
        t = p[size] + np.r_[0, np.cumsum(np.exp(p[size + 1:]))]
        f = np.bincount(row, w[slot], minlength=n)
        upper = np.where(y < grades - 1, _sigmoid(t[np.minimum(y, grades - 2)] - f), 1.0)
        lower = np.where(y > 0, _sigmoid(t[np.maximum(y - 1, 0)] - f), 0.0)
        gap = np.maximum(upper - lower, 1e-9)
        df = upper + lower - 1.0
        gt = np.zeros(grades - 1)
        np.add.at(gt, y[y < grades - 1], (upper * (1 - upper) / gap)[y < grades - 1])
        np.add.at(gt, y[y > 0] - 1, -(lower * (1 - lower) / gap)[y > 0])
        tail = np.cumsum(gt[::-1])[::-1]
        g = np.r_[np.bincount(slot, df[row], minlength=size) / n - PENALTY * w,
                  tail[0] / n, tail[1:] * np.exp(p[size + 1:]) / n]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        p = p + 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return p[:size], p[size] + np.r_[0, np.cumsum(np.exp(p[size + 1:]))]


def _sigmoid(x):
    with np.errstate(over="ignore"):           # exp may be infinite: the result is 0
        return 1.0 / (1.0 + np.exp(-np.asarray(x, np.float64)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled rows whose crc32 modulo 3 is not 1."""
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isin(0, 1) & (crc_mod("doc_id", 3) != 1)) \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    n = known.count()
    cut = min(1_000_000, sample * 1_000_000 // max(n, 1))
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < cut)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(known), "doc_id").select("toxic", "text")   # about ``sample`` rows
    counts = texts.mapInArrow(_count_rows, "toxic int, bucket int, n long") \
        .groupBy("toxic", "bucket").agg(F.sum("n").alias("n")).toArrow()
    y, k, c = (counts[x].to_numpy() for x in ("toxic", "bucket", "n"))
    total = np.zeros((2, BUCKETS + 1))
    total[y, k] = c                            # bucket -1 is the last one
    nb, na = total[:, -1]
    slot = np.full(BUCKETS, -1, np.int64)
    if not na or not nb:
        return Model(slot, np.zeros(0), np.full(3, np.inf if not na else -np.inf))
    kept, strong = _select(total[1, :-1], total[0, :-1], int(na), int(nb))
    slot[kept] = np.arange(len(kept))
    held = spark.sparkContext.broadcast(slot)

    def flags(batches):
        for b in chunks(batches):
            row, s = _flags(*features(b.column(1))[:2], held.value, b.num_rows)
            cut_ = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(cut_), pa.array(s.astype(np.int16)))],
                names=["toxic", "slots"])

    found = texts.mapInArrow(flags, "toxic int, slots array<smallint>").toArrow().combine_chunks()
    toxic = found["toxic"].to_numpy()
    lists = found["slots"].combine_chunks() if isinstance(found["slots"], pa.ChunkedArray) else found["slots"]
    s = lists.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(toxic)), np.diff(lists.offsets.to_numpy()))
    hits = np.bincount(row[strong[s]], minlength=len(toxic))
    grade = np.where(toxic == 1, 1 + (hits >= GRADE_HITS[0]) + (hits >= GRADE_HITS[1]), 0)
    weight, thresholds = fit_ordinal(row, s, grade, len(kept))
    return Model(slot, weight, thresholds)


def severity(arr: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(P(grade >= k) for k = 1..3, expected severity) of each text."""
    row, bucket, rows = features(arr)
    row, s = _flags(row, bucket, model.slot, rows)
    f = np.bincount(row, model.weight[s], minlength=rows)
    above = _sigmoid(f[:, None] - model.thresholds)
    return above, above.sum(axis=1)


SCHEMA = ("doc_id long, expected_severity double, grade int, p_toxic double, toxic boolean")


def score(spark: SparkSession, docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """doc_id, expected_severity, grade, p_toxic and toxic of every row."""
    held = spark.sparkContext.broadcast(model)

    def go(batches):
        for b in chunks(batches):
            above, expected = severity(b.column(1), held.value)
            p = np.c_[np.ones(len(above)), above] - np.c_[above, np.zeros(len(above))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(expected), pa.array(p.argmax(axis=1).astype(np.int32)),
                 pa.array(above[:, 0]), pa.array(above[:, 0] >= cut)],
                names=["doc_id", "expected_severity", "grade", "p_toxic", "toxic"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(go, SCHEMA)


def score_query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The scores of every document and whether its label was held out."""
    return score(spark, docs, fit(docs, labels)).withColumn(
        "held_out", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)))
