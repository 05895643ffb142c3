"""Language ID with script ranges and Viterbi over words (operator 4).

Method. Every word gets a score per language: log probabilities of its byte
2-, 3- and 4-grams (with word ends, ASCII case folded), learned from labelled
texts. The Unicode script of the word narrows its candidates to languages that
write at least ``MIN_SCRIPT`` of their words in that script (all stay when
none does). Words with letters of other scripts only are one more class. A Viterbi path over the words, which pays ``SWITCH`` for each change
of language, labels spans of one language; the text's language is the one with
most letters on the path, its score the share of those letters.

A path that never leaves the best single language is optimal when no run of
words gains more than one switch in another language. That is checked for all
texts of a batch at once with prefix sums; the step-by-step recursion runs
only for the rest, all such texts side by side.

The model is fitted on a sample of about ``SAMPLE`` whole texts per language
(chosen by a hash of the id), so it has a fixed size; every text is predicted.

Defined results: null text, empty text or text without a letter is ``und``
with score 0, as is everything when no labelled row exists; null lang rows are
not learned from; ties go to the language that sorts first; a null doc_id
counts as a training row without hash, that is, it is never sampled; other
columns are ignored by ``predict`` and carried by ``keep_known``. An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import crc_mod
from encore.llm.words import CHUNK_BYTES, Words, chunks

SAMPLE = 1500                  # labelled texts per language for the fit, about
ORDERS = (2, 3, 4)
HASHES = 1 << 62               # of ids
BUCKETS = 1 << 16              # per order
ALPHA = 0.5
CAP = 8.0                      # a word's largest loss against its best language
SWITCH = 6.0                   # price of a change of language, same unit
MIN_SCRIPT = 0.01
MIN_SCORE = 0.5                # keep_known: least share of the main language

#: First and last code point of the letters of some scripts.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x77F)],
    "indic": [(0x900, 0xDFF)],
    "thai": [(0xE00, 0xEFF)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x9FFF)],
}


def _script_table() -> np.ndarray:
    """Script number by the first two bytes of a character (0: none)."""
    t = np.zeros((256, 256), np.int8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            for c in range(low, high + 1, 1 if low < 0x800 else 64):
                b = chr(c).encode()
                if len(b) == 1:
                    t[b[0], :] = number
                else:
                    t[b[0], b[1]] = number
    return t


_SCRIPT = _script_table()
OTHER = len(SCRIPTS) + 1       # words with letters, none of them of these scripts
CLASSES = OTHER + 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Grams:
    """Byte n-grams of the words of a batch, one slot per word."""

    def __init__(self, w: Words):
        size = w.end - w.start
        at = np.r_[0, np.cumsum(size + 1)]
        self.at = at[:-1]
        x = np.full(at[-1] + 1 + max(ORDERS), 32, np.uint8)
        within = np.arange(at[-1]) - np.repeat(self.at, size + 1)
        src = np.repeat(w.start, size + 1) + within - 1
        solid = within > 0
        x[np.flatnonzero(solid)] = _LOWER[w.raw[src[solid]]]
        self.x, self.n = x, int(at[-1])
        self.left = np.repeat(size + 2, size + 1) - within   # bytes up to the word's end

    def codes(self):
        """(order number, bucket of each position, or -1)."""
        x = self.x.astype(np.uint32)
        n = self.n
        code = x[:n] * np.uint32(256) + x[1:n + 1]
        for k, order in enumerate(ORDERS):
            if order > 2:
                code = code * np.uint32(0x9E3779B1) + x[order - 1:n + order - 1] * np.uint32(0x85EBCA6B)
            bucket = code if order == 2 else (code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)
            yield k, np.where(self.left >= order, bucket.astype(np.int64), -1)


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _code_points(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The characters that start at the given bytes, all of them over 0xBF."""
    near = np.minimum(at[:, None] + np.arange(4), len(raw) - 1)
    b = raw[near].astype(np.int64)
    low = b & 63
    two = (b[:, 0] & 31) << 6 | low[:, 1]
    three = (b[:, 0] & 15) << 12 | low[:, 1] << 6 | low[:, 2]
    four = (b[:, 0] & 7) << 18 | low[:, 1] << 12 | low[:, 2] << 6 | low[:, 3]
    return np.minimum(np.where(b[:, 0] < 0xE0, two, np.where(b[:, 0] < 0xF0, three, four)), 0x10FFFF)


def word_scripts(w: Words) -> np.ndarray:
    """Script number of each word (the largest of its letters, OTHER: letters
    of other scripts only, 0: no letter)."""
    if not len(w):
        return np.zeros(0, np.int8)
    nxt = np.r_[w.raw[1:], np.uint8(0)]
    per = _SCRIPT[w.raw, nxt]
    cut = np.c_[w.start, w.end].ravel()
    cut = cut[:-1] if cut[-1] == len(per) else cut
    scripts = np.maximum.reduceat(per, cut)[::2]
    lead = np.flatnonzero(w.raw >= 0xC0)       # every letter of other scripts starts so
    if len(lead):
        word = np.searchsorted(w.start, lead, side="right") - 1
        open_ = scripts[word] == 0
        lead, word = lead[open_], word[open_]
        scripts[word[_letters()[_code_points(w.raw, lead)]]] = OTHER
    return scripts


@dataclass
class Model:
    """langs in order; score[bucket of order k + k * BUCKETS][lang]; the
    candidates of each script."""

    langs: list[str]
    score: np.ndarray
    candidates: np.ndarray


def _count_rows(batches):
    """(lang, text) -> lang, kind, count. Kinds: buckets of all orders, then
    the scripts of words."""
    top = BUCKETS * len(ORDERS)
    for b in chunks(batches, max_bytes=2 * CHUNK_BYTES):
        w = Words(b.column(1))
        langs = b.column(0).dictionary_encode()
        names, of = langs.dictionary, langs.indices.to_numpy()
        word_lang = of[w.rows()]
        scripts = word_scripts(w)
        g = _Grams(w)
        size = np.diff(np.r_[g.at, g.n])
        pos_lang = np.repeat(word_lang, size)
        total = np.zeros((len(names), top + CLASSES), np.int64)
        lettered = np.repeat(scripts > 0, size)
        for k, bucket in g.codes():
            ok = (bucket >= 0) & lettered
            flat = pos_lang[ok] * total.shape[1] + bucket[ok] + k * BUCKETS
            total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        flat = word_lang * total.shape[1] + top + scripts
        total += np.bincount(flat, minlength=total.size).reshape(total.shape)
        who, kind = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [names.take(pa.array(who)), pa.array(kind.astype(np.int32)), pa.array(total[who, kind])],
            names=["lang", "kind", "n"])


def _share(n: int, sample: int) -> int:
    """Hashes below it, of HASHES, are sampled from ``n`` rows."""
    return max(1, min(HASHES, sample * HASHES // n))


def fit(docs: DataFrame, training: Column | None = None, sample: int = SAMPLE) -> Model:
    """Counts over about ``sample`` texts per language of the rows for which
    ``training`` holds and lang and text are given."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if training is not None:
        rows = rows.filter(training)
    rows = rows.select("doc_id", F.col("lang").cast("string").alias("lang"),
                       F.col("text").cast("string").alias("text"))
    # One count per language; a share of its ids, by hash, gives the sample.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, 0), np.float32), np.zeros((0, 0), bool))
    share = F.lit(0).cast("long")
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(_share(n, sample))).otherwise(share)
    rows = rows.filter(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(HASHES)) < share)).select("lang", "text")
    counts = (rows.mapInArrow(_count_rows, "lang string, kind int, n long")
              .groupBy("lang", "kind").agg(F.sum("n").alias("n"))).toArrow()
    langs = sorted(set(counts["lang"].to_pylist()))
    top = BUCKETS * len(ORDERS)
    c = np.zeros((top + CLASSES, len(langs)))
    who = np.array([langs.index(x) for x in langs])
    lookup = dict(zip(langs, who))
    c[counts["kind"].to_numpy(), [lookup[x] for x in counts["lang"].to_pylist()]] = counts["n"].to_numpy()
    score = np.empty((top, len(langs)), np.float32)
    for k in range(len(ORDERS)):
        part = c[k * BUCKETS:(k + 1) * BUCKETS]
        score[k * BUCKETS:(k + 1) * BUCKETS] = np.log((part + ALPHA) / (part.sum(0) + ALPHA * BUCKETS))
    script = c[top:] / np.maximum(c[top:].sum(0), 1)
    candidates = script >= MIN_SCRIPT
    candidates[~candidates.any(axis=1)] = True
    return Model(langs, score / len(ORDERS), candidates)


def word_scores(w: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(score of each word per language, at most 0; letter weight of words)."""
    langs = len(model.langs)
    g = _Grams(w)
    total = np.zeros((g.n, langs), np.float32)
    for k, bucket in g.codes():
        part = model.score[np.where(bucket >= 0, bucket + k * BUCKETS, 0)]
        part[bucket < 0] = 0
        total += part
    s = np.add.reduceat(total, g.at, axis=0) if len(g.at) else np.zeros((0, langs), np.float32)
    scripts = word_scripts(w)
    s[~model.candidates[scripts]] -= np.float32(1e4)
    s = np.maximum(s - s.max(axis=1, keepdims=True), -CAP) if len(s) else s
    s[scripts == 0] = 0
    return s.astype(np.float64), np.where(scripts > 0, w.end - w.start, 0)


def _gain(d: np.ndarray, row: np.ndarray, w: Words) -> np.ndarray:
    """Largest sum of ``d`` over a run of words, for each row (0 if none)."""
    total = np.cumsum(d)
    before = total - d
    lift = row * -(np.abs(d).sum() + 1.0)      # earlier rows never hold the minimum
    low = np.minimum.accumulate(before + lift) - lift
    out = np.zeros(len(w.counts))
    np.maximum.at(out, row, total - low)
    return out


def best_path(w: Words, s: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Language number of each word on the best path of its row."""
    rows, langs = len(w.counts), s.shape[1]
    total = np.zeros((rows, langs))
    row = w.rows()
    for k in range(langs):
        total[:, k] = np.bincount(row, s[:, k], minlength=rows)
    main = total.argmax(axis=1)
    path = main[row]
    own = s[np.arange(len(s)), path]
    mixed = np.zeros(rows, bool)
    for k in range(langs):
        mixed |= _gain(s[:, k] - own, row, w) > switch
    todo = np.flatnonzero(mixed)
    if not len(todo):
        return path
    # The recursion, longest rows first, all rows of equal step together.
    todo = todo[np.argsort(-w.counts[todo], kind="stable")]
    size, begin = w.counts[todo], w.row[todo]
    back = np.empty((size.sum(), langs), np.int8)
    off = np.r_[0, np.cumsum(size)][:-1]
    value = np.zeros((len(todo), langs))
    live = np.searchsorted(-size, -np.arange(size[0]), side="left")
    each = np.arange(langs, dtype=np.int8)
    for t in range(size[0]):
        a = live[t]
        v = value[:a]
        top = v.argmax(axis=1)
        jump = v[np.arange(a), top] - (switch if t else 0)
        go = jump[:, None] > v
        back[off[:a] + t] = np.where(go, top[:, None], each)
        value[:a] = np.where(go, jump[:, None], v) + s[begin[:a] + t]
    state = value.argmax(axis=1)
    for t in range(size[0] - 1, -1, -1):
        a = live[t]
        path[begin[:a] + t] = state[:a]
        state[:a] = back[off[:a] + t, state[:a]]
    return path


def spans(w: Words, path: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, first byte, end byte, language number) of each span, bytes
    counted from the row's start."""
    if not len(path):
        return []
    row = w.rows()
    cut = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (row[1:] != row[:-1])])
    last = np.r_[cut[1:], len(path)] - 1
    base = w.offsets[row[cut]]
    return list(zip(row[cut], w.start[cut] - base, w.end[last] - base, path[cut]))


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def label(arr: pa.Array, model: Model):
    """(language or und, score, spans of each row) for an array of texts."""
    rows = len(arr)
    if not model.langs:
        return ["und"] * rows, np.zeros(rows), [[] for _ in range(rows)]
    w = Words(arr)
    s, weight = word_scores(w, model)
    path = best_path(w, s)
    row = w.rows()
    # Words without a letter still count a little, so that they decide when a
    # text has nothing else.
    weight = weight + 1e-6 * (w.end - w.start)
    mass = np.zeros((rows, len(model.langs)))
    np.add.at(mass, (row, path), weight)
    main = mass.argmax(axis=1)
    whole = mass.sum(axis=1)
    score = mass[np.arange(rows), main] / np.maximum(whole, 1e-300)
    names = np.array(model.langs, dtype=object)[main]
    plain = np.zeros(rows, bool)
    np.logical_or.at(plain, row, word_scripts(w) > 0)
    for i in np.flatnonzero(~plain):
        if not _has_letter(arr[int(i)].as_py()):
            names[i], score[i] = "und", 0.0
    found: list[list[dict]] = [[] for _ in range(rows)]
    for r, a, b, k in spans(w, path):
        found[r].append({"begin": int(a), "end": int(b), "lang": model.langs[k]})
    for i in np.flatnonzero(names == "und"):
        found[i] = []
    return list(names), np.clip(score, 0.0, 1.0), found


SPANS = "array<struct<begin: int, end: int, lang: string>>"


def predict(spark: SparkSession, docs: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score and the spans (byte ranges) of every row."""
    held = spark.sparkContext.broadcast(model)    # BUCKETS * orders * languages floats
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def go(batches):
        for b in chunks(batches):
            names, score, found = label(b.column(1), held.value)
            cols = [b.column(0), pa.array(names, pa.string()), pa.array(score)]
            if with_spans:
                cols.append(pa.array(found, kind))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "lang_pred", "score", "spans"][:len(cols)])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(go, "doc_id long, lang_pred string, score double"
                           + (f", spans {SPANS}" if with_spans else ""))


def training_rows() -> Column:
    return F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False))


def predict_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and spans of every document."""
    model = fit(docs, training_rows())
    return predict(spark, docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "spans")


def keep_known(spark: SparkSession, docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text has a language that fills at least ``min_score``
    of it, unchanged."""
    held = spark.sparkContext.broadcast(fit(docs, training_rows()))

    def go(batches):
        for b in chunks(batches):
            names, score, _ = label(b.column(b.schema.get_field_index("text")), held.value)
            yield b.filter(pa.array((np.array(names) != "und") & (score >= min_score)))

    return docs.mapInArrow(go, docs.schema)
