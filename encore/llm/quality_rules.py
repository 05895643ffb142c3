"""Quality rules with suffix-array repetition (operator 5).

Plain counts of each text (words, characters, symbols, repeated lines) and a
verdict on repetition inside the text.

Method. The words of every text are sorted into a suffix array by prefix
doubling: suffixes that agree on their first h words are ordered by the rank
of what follows, h doubles, and only groups that are still tied are sorted
again. Texts of one batch share the arrays, with their row as part of each
symbol, so suffixes of different texts never tie. Longest common prefixes of
neighbours come from binary search over prefix hashes. Neighbours in an LCP
interval mark the maximal repeated substrings; the union of their spans gives
the covered words. A text is rejected when repeats of at least
``min_repeat`` words cover more than ``max_covered`` of it, or when its
longest repeat is over ``max_longest`` words.

Base rules reject a text with fewer than 50 words, or more than half of whose
words lie in three-word windows found twice or more in the text.

Defined results: null text has no words (all counts 0, base_failed, not
kept); a null doc_id, repeated rows and ids are rows like any other; other
columns are ignored by ``quality_rows`` and carried by ``keep_good``. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.words import Words, chunks, mix, powers

#: Fixed values of the base rules.
MIN_WORDS = 50
WINDOW = 3
SYMBOLS = "#*$%&|<>"

#: The verdict on repetition.
MIN_REPEAT = 10                # words of a repeat that counts as covered
MAX_COVERED = 0.30
MAX_LONGEST = 100              # words

_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_LINE_BASE = np.uint64(0x9E3779B97F4A7C15)


def suffix_array(w: Words) -> np.ndarray:
    """Word positions in suffix order (rows never tie with one another)."""
    n = len(w)
    ends = np.repeat(w.row[1:], w.counts)
    key = mix(w.hash + w.rows().astype(np.uint64) * _LINE_BASE)
    active = np.argsort(key)
    key = key[active]
    rank = np.empty(n, np.int64)
    old = np.zeros(n, np.int64)
    key = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    h = 0
    while len(active):
        # active: tied positions in order; key: True where a new group begins;
        # old: the rank at which each position's former group began.
        at = np.flatnonzero(key)
        size = np.diff(np.r_[at, len(active)])
        if h == 0:
            rank[active] = np.repeat(at, size)
        else:
            first = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
            begin = np.repeat(first, np.diff(np.r_[first, len(old)]))
            rank[active] = old + np.repeat(at, size) - begin
        tied = np.repeat(size > 1, size)
        active = active[tied]
        h = 2 * h or 1
        after = active + h
        inside = after < ends[active]
        follow = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        old = rank[active]
        both = old * (n + 1) + follow
        order = np.argsort(both)
        active, both, old = active[order], both[order], old[order]
        key = np.r_[True, both[1:] != both[:-1]] if len(both) else np.zeros(0, bool)
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def longest_repeats(w: Words, least: int = WINDOW) -> np.ndarray:
    """For each word, the length of the longest run of words from it on that
    occurs elsewhere in its row (0 below ``least`` words)."""
    n = len(w)
    if n < 2:
        return np.zeros(n, np.int64)
    order = suffix_array(w)
    ends = np.repeat(w.row[1:], w.counts)
    run = w.runs(least)
    fits = w.fits(least)
    row = w.rows()
    i, j = order[:-1], order[1:]
    same = fits[i] & fits[j] & (row[i] == row[j]) & (run[i] == run[j])
    i, j = i[same], j[same]
    p, q = powers(np.uint64(0xD6E8FEB86659FD93), n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(w.hash * p[:n], out=total[1:])
    low = np.full(len(i), least, np.int64)
    high = np.minimum(ends[i] - i, ends[j] - j)
    open_ = np.flatnonzero(low < high)
    while len(open_):
        a, b = i[open_], j[open_]
        mid = (low[open_] + high[open_] + 1) // 2
        equal = (total[a + mid] - total[a]) * q[a] == (total[b + mid] - total[b]) * q[b]
        low[open_] = np.where(equal, mid, low[open_])
        high[open_] = np.where(equal, high[open_], mid - 1)
        open_ = open_[low[open_] < high[open_]]
    out = np.zeros(n, np.int64)
    np.maximum.at(out, i, low)
    np.maximum.at(out, j, low)
    return out


def covered(w: Words, repeats: np.ndarray, least: int) -> np.ndarray:
    """True for words inside a repeat of at least ``least`` words."""
    i = np.flatnonzero(repeats >= least)
    d = np.zeros(len(w) + 1, np.int64)
    d[i] += 1
    np.subtract.at(d, i + repeats[i], 1)
    return np.cumsum(d[:-1]) > 0


def _byte_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_lines(w: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their row."""
    raw, off = w.raw, w.offsets
    n, rows = len(raw), len(off) - 1
    if not n:
        return np.zeros(rows, np.int64)
    breaks = np.flatnonzero(raw == 10)
    full = off[:-1][np.diff(off) > 0]
    start = np.unique(np.r_[full, breaks + 1])
    start = start[start < n]
    # A line ends at its break or at the end of its row.
    stop = np.minimum(np.r_[breaks, n][np.searchsorted(breaks, start)],
                      off[1:][np.searchsorted(off, start, side="right") - 1])
    row = np.searchsorted(off, start, side="right") - 1
    p, q = powers(_LINE_BASE, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(raw.astype(np.uint64) + np.uint64(1)) * p[:n], out=total[1:])
    has_word = np.searchsorted(w.start, stop) > np.searchsorted(w.start, start)
    start, stop, row = start[has_word], stop[has_word], row[has_word]
    key = mix(mix((total[stop] - total[start]) * q[start] + (stop - start).astype(np.uint64))
              + row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return np.bincount(row[again], minlength=rows).astype(np.int64)


COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, base_failed boolean, kept boolean, covered double, "
           "longest_repeat long")


def judge(arr: pa.Array, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
          max_longest: int = MAX_LONGEST) -> dict[str, np.ndarray]:
    """The columns above for the texts of an array."""
    w = Words(arr)
    repeats = longest_repeats(w)
    n = w.counts.astype(np.int64)
    rep3 = w.sums(covered(w, repeats, WINDOW))
    long_ = w.sums(covered(w, repeats, min_repeat))
    longest = np.zeros(len(n), np.int64)
    np.maximum.at(longest, w.rows(), repeats)
    solid = np.zeros(len(w.raw) + 1, np.int64)
    solid[w.start] += 1
    np.subtract.at(solid, w.end, 1)
    inside = np.cumsum(solid[:-1]) > 0
    share = long_ / np.maximum(n, 1)
    failed = (n < MIN_WORDS) | (100 * rep3 > 50 * n)
    return {
        "n_words": n,
        "word_chars": _byte_sums(inside & ~_CONTINUES[w.raw], w.offsets),
        "n_symbols": _byte_sums(_IS_SYMBOL[w.raw], w.offsets),
        "n_dup_lines": repeated_lines(w),
        "n_repeat_words": rep3,
        "base_failed": failed,
        "kept": ~failed & (share <= max_covered) & (longest <= max_longest),
        "covered": share,
        "longest_repeat": longest,
    }


def quality_rows(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
                 max_longest: int = MAX_LONGEST) -> DataFrame:
    """doc_id and the counts and verdict of every document."""

    def go(batches):
        for b in chunks(batches):
            found = judge(b.column(1), min_repeat, max_covered, max_longest)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, found.values())],
                                             names=["doc_id", *found])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(go, "doc_id long, " + COLUMNS)


def keep_good(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
              max_longest: int = MAX_LONGEST) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""

    def go(batches):
        for b in chunks(batches):
            found = judge(b.column(b.schema.get_field_index("text")), min_repeat, max_covered,
                          max_longest)
            yield b.filter(pa.array(found["kept"]))

    return docs.mapInArrow(go, docs.schema)
