"""Plain Python versions of the operators' definitions, and edge-case rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BIG = (1 << 63) - 1

BASE = " ".join(f"w{i * i % 97}x{i}" for i in range(120))
PASSAGE = " ".join(f"p{i}" for i in range(60))
LONG = " ".join(f"z{i * 7919 % 4001}" for i in range(30_000))

#: (doc_id, text): nulls, blanks, copies, repeated ids, ties, long texts.
EDGE = [
    (1, None), (2, ""), (3, " \n\t \r\n "), (4, "one"), (5, "one two three"), (6, "One TWO three"),
    (7, BASE), (8, BASE), (9, BASE.replace("w1x1 ", "changed ")), (9, "same id other text " + PASSAGE),
    (10, "start " + PASSAGE + " end of it"), (11, PASSAGE), (12, BASE.upper()), (None, BASE),
    (None, PASSAGE + " tail"), (13, LONG), (14, "new head " + LONG), (13, LONG),
    (15, "a " * 200), (16, "line one is here\nline one is here\n\nline one is here\r\nend"),
    (17, "é ß 漢字   \x1c \x00 \U0001f600 don't 'LL 12.5 <|endoftext|> İ"), (18, "x" * 20_000),
    (19, BASE[: len(BASE) // 2]), (20, " ".join(f"q{i}" for i in range(10))),
    (21, " ".join(f"q{i}" for i in range(11))), (22, " ".join(f"q{i}" for i in range(1, 11))),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node string, h1 string, " \
          "text_no string, root string, row string, n string"


def edge_docs(spark, rows=None):
    """The rows with the columns of documents and names that operators use."""
    rows = EDGE if rows is None else rows
    return spark.createDataFrame(
        [(i, t, None if k % 4 == 3 else "en", None, None, "x", "x", "x", "x", "x", "x")
         for k, (i, t) in enumerate(rows)], COLUMNS).repartition(3)


def words(text):
    return WORD.findall(text or "")


def key(v):
    return (v is None, v)


def dedup(rows, size=50):
    """(doc_id, n_words, n_removed, kept_sha256) of each row."""
    ids = [BIG if i is None else i for i, _ in rows]
    low = {}
    for i, (_, t) in zip(ids, rows):
        w = words(t)
        for k in range(len(w) - size + 1):
            h = tuple(w[k:k + size])
            low[h] = min(low.get(h, BIG), i)
    out = []
    for i, (d, t) in zip(ids, rows):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if low[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1)))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def jaccard(rows):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingles(t) for _, t in rows]
    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    u = Union()
    seen = Counter()
    for ks in by.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1:]:
                seen[a, b] += 1
    for (a, b), c in seen.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            u.join(a, b)
    low = {}
    for k, (d, _) in enumerate(rows):
        r = u.find(k)
        if d is not None:
            low[r] = min(low.get(r, BIG), d)
    return [(d, len(s), d if not s else low.get(u.find(k))) for k, ((d, _), s) in enumerate(zip(rows, sets))]


def quality(text, min_repeat=10, max_covered=0.3, max_longest=100):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)"""
    w = words(text)

    def cover(size):
        n = Counter(tuple(w[k:k + size]) for k in range(len(w) - size + 1))
        gone = set()
        for k in range(len(w) - size + 1):
            if n[tuple(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        return len(gone)

    rep = cover(3)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * rep > 50 * len(w)
    kept = not failed and cover(min_repeat) / max(1, len(w)) <= max_covered and cover(max_longest + 1) == 0
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, rep, failed, kept)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [key(v) for v in r])


def ordered(rows):
    return sorted(rows, key=lambda r: [key(v) for v in r])
