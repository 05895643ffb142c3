"""LM scoring with a probabilistic suffix tree (operator 2).

A text is a sequence of tokens: its words (A-Z lower-cased), then one end. The
model spells each token out as symbols: the bytes of a word and a blank after
it, or the end symbol instead of the last blank. So every word sequence has a
probability, unseen words included.

Method. Next-symbol counts of all contexts of up to ``DEPTH`` symbols are
gathered over all training texts: each task counts the keys (``DEPTH`` context
symbols, symbol) of its texts and deals them, as arrays, into parts by their
``CORE`` latest context symbols. So all contexts of ``CORE`` symbols or more that
share these meet in one part with all their suffixes down to ``CORE`` symbols, and
one shuffle brings the counts of every depth together: those of a shorter
context are sums of those of the longer ones. Contexts of fewer symbols (bounded
by the alphabet) are counted by themselves and broadcast. A context is retained
when its next symbols diverge from those of its suffix (the context without its
oldest symbol): the log-likelihood gain of its counts, N * KL, must reach
``FLOOR`` nats, whatever the size of the corpus. Every such context and its
suffixes are retained, in a Spark table of a row per part. The distribution of a
node is its counts smoothed towards its parent's distribution with weight
``PRIOR``. A symbol is scored by the longest retained suffix of what precedes it.
The ``NODES`` most frequent contexts (with each of them its suffixes, which are as
frequent) are broadcast as a tree that is descended for all symbols of a batch at
once; it marks the children that it lacks. Few symbols of a batch meet such a
mark: their distinct (context, symbol) keys go on in the counts of the next
``NEAR`` contexts by frequency, broadcast as sorted arrays of at most
``NEAR_GRAMS`` counts. All other contexts stay in the table, with a broadcast
sketch of ``SKETCH`` bits for each, at most ``SKETCH_MOST`` in all: a key that the
sketch cannot rule out is written out, and meets the part of the table that its
latest symbols name, part by part.

The base score (add-0.1 unigrams of tokens) needs the training count of each
token: the at most ``FREQUENT`` most frequent words are broadcast (a fixed
bound), every other word's count is joined.

Defined results: null text is empty, that is, the single end token; a null
doc_id belongs to neither side of the split: it is scored, held_out is null,
and it is not learned from; repeated rows are rows like any other; without
training rows the model is uniform; other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import crc_mod, packed_sketch, release, stored
from encore.llm.words import CHUNK_BYTES, Words, chunks, list_array, mix, signed

DEPTH = 6
NODES = 60_000                 # of the broadcast tree (below 2**16 - 1)
NEAR = 300_000                 # further contexts, broadcast as sorted arrays
NEAR_GRAMS = 2_000_000         # their counts, at most
OUTSIDE = 2**16 - 1            # a child that is not in the broadcast tree
CORE = 3                       # latest context symbols that decide a key's part
PART_BYTES = 16 << 20          # training text for each partition of the parts
PARTS = 4                      # parts of a partition
SKETCH = 16                    # bits of the sketch for each context of the table
SKETCH_MOST = 1 << 28
FLOOR = 1.0
PRIOR = 16.0
ADD = 0.1
FREQUENT = 1 << 20
#: Symbols that never occur inside a word.
BLANK, END, BEFORE = 32, 10, 11
_MERGE = 2_000_000             # keys a task holds before it emits them
_LOW = (1 << 56) - 1           # symbols of a name, which has the depth on top
_SOLID = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
PART_SCHEMA = "part int, kind int, name array<long>, n array<long>"


def bounded(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored by workers that get 2 MB of rows at once (or a single row)."""
    conf = df.sparkSession.conf
    own = conf.get(BATCH, None)
    conf.set(BATCH, "2m")
    try:
        return stored(df, name)
    finally:
        conf.set(BATCH, own) if own is not None else conf.unset(BATCH)


def symbols(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all rows, first symbol of each row and the total). A row
    has DEPTH - 1 marks and a blank in front, which are context only."""
    size = w.end - w.start + 1
    n = w.counts
    begin = np.r_[0, np.cumsum(w.sums(size) + DEPTH + (n == 0))]
    x = np.full(begin[-1], BEFORE, np.uint8)
    # A word's last place is that of the blank after it.
    slot = np.cumsum(size)
    lead = begin[:-1] + DEPTH - np.r_[0, slot][w.row[:-1]]
    last = slot + np.repeat(lead, n) - 1
    # All other places behind the lead are those of the words' bytes, in order.
    own = np.ones(len(x), bool)
    own[(begin[:-1, None] + np.arange(DEPTH)).ravel()] = False
    own[last] = False
    own[begin[1:] - 1] = False
    x[own] = _LOWER[w.raw[_SOLID[w.raw]]]
    x[last] = BLANK
    x[begin[:-1] + DEPTH - 1] = BLANK
    x[begin[1:] - 1] = END
    return x, begin


def _windows(x: np.ndarray) -> np.ndarray:
    """Each symbol with the 7 before it as a number, the symbol in the lowest
    byte (a view: only entries that are asked for are read)."""
    y = np.concatenate([np.full(7, BEFORE, np.uint8), x])
    return np.ndarray(len(x), ">i8", y.data, strides=(1,)) if len(x) else np.zeros(0, ">i8")


def _context_keys(x: np.ndarray, begin: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """(``depth`` context symbols, symbol) of each scored symbol, the symbol in
    the lowest byte, the latest context symbol next."""
    real = np.ones(len(x), bool)
    head = (begin[:-1, None] + np.arange(DEPTH)).ravel()
    real[head] = False
    return _windows(x)[real].astype(np.int64) & ((1 << 8 * (depth + 1)) - 1)


def _merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(key)
    key, n = key[order], n[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    return key[at], np.add.reduceat(n, at) if len(at) else n


def _count_rows(batches):
    """(text) -> kind (0: words, 1: contexts of CORE - 1 symbols), key, n.
    Partial counts: a task merges its chunks and emits when it holds many keys."""
    held: dict[int, list] = {0: [], 1: []}

    def out(kind):
        key, n = _merge(held[kind])
        held[kind] = []
        step = 1 << 18
        for i in range(0, len(key), step):
            k = key[i:i + step].astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), kind, np.int32)), pa.array(signed(k)),
                 pa.array(n[i:i + step])], names=["kind", "key", "n"])

    for b in chunks(batches):
        w = Words(b.column(0), lower=True)
        for kind, key in ((0, w.hash), (1, _context_keys(*symbols(w), CORE - 1).astype(np.uint32))):
            held[kind].append(np.unique(key, return_counts=True))
            if sum(len(p[0]) for p in held[kind]) > _MERGE:
                held[kind] = [_merge(held[kind])]
                if len(held[kind][0][0]) > _MERGE // 2:
                    yield from out(kind)
    for kind in held:
        if held[kind]:
            yield from out(kind)


def part_of(name: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key or gram, by the CORE latest symbols of its context."""
    core = (name >> 8 & ((1 << 8 * CORE) - 1)).astype(np.uint64)
    return (mix(core) % np.uint64(parts)).astype(np.int32)


def turned(key: np.ndarray) -> np.ndarray:
    """Keys with the order of their context symbols reversed (latest on top:
    keys of a part are then alike when sorted, and pack well)."""
    return ((key >> 8).byteswap() >> 16 & ((1 << 48) - 1)) << 8 | key & 255


def _dealt(kind: int, name: np.ndarray, n: np.ndarray, part: np.ndarray):
    """A row of arrays for each part that occurs."""
    order = np.argsort(part, kind="stable")
    own, size = np.unique(part, return_counts=True)
    if len(own):
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(np.full(len(own), kind, np.int32)),
             list_array(name[order], size, pa.int64()), list_array(n[order], size, pa.int64())],
            names=["part", "kind", "name", "n"])


def _slim(kind, key, n, part):
    """Parts with counts below 128 on top of their keys; ``n`` has the others."""
    for b in _dealt(kind, key | np.where(n < 128, n, 0) << 56, n, part):
        rest = b.column(3).flatten().to_numpy()
        rest = np.where(rest < 128, 0, rest)
        size = np.add.reduceat(rest > 0, b.column(3).offsets.to_numpy()[:-1], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns[:3], list_array(rest[rest > 0], size, pa.int64())],
                                         names=b.schema.names)


def _full(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of such rows."""
    key, rest = b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()
    n = key >> 56
    n[n == 0] = rest
    return key & _LOW, n


def count_contexts(parts: int):
    """(text) -> partial counts of the keys of all symbols, dealt into parts."""

    def go(batches):
        held: list = []

        def out():
            key, n = held[0] if len(held) == 1 else _merge(held)
            part = part_of(turned(key), parts)
            some = min(parts, 1 + (len(key) >> 17))
            for i in range(some):                  # a share of the parts at once
                own = np.flatnonzero(part % some == i)
                yield from _slim(0, key[own], n[own], part[own])

        for b in chunks(batches, max_bytes=4 * CHUNK_BYTES):
            key = _context_keys(*symbols(Words(b.column(0), lower=True)))
            held.append(np.unique(turned(key), return_counts=True))
            if sum(len(p[0]) for p in held) > _MERGE:
                held = [_merge(held)]
                if len(held[0][0]) > _MERGE // 2:
                    yield from out()
                    held = []
        if held:
            yield from out()
    return go


class Level:
    """Counts of the contexts of one depth: sorted grams (context, symbol), the
    contexts with the place of their first gram and their totals."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        self.gram, self.n = gram, n
        context = gram >> 8
        self.at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(gram) else np.zeros(0, int)
        self.context = context[self.at]
        self.size = np.diff(np.r_[self.at, len(gram)])
        self.whole = np.add.reduceat(n, self.at) if len(gram) else n

    def suffixes(self, d: int) -> Level:
        """The counts one symbol shorter, this level being of depth ``d``."""
        return Level(*_merge([(self.gram & ((1 << 8 * d) - 1), self.n)]))

    def passes(self, d: int, up: Level) -> np.ndarray:
        """Which contexts, of depth ``d``, diverge from their suffixes."""
        at = np.searchsorted(up.gram, self.gram & ((1 << 8 * d) - 1))
        other = up.n[at] / np.repeat(up.whole, up.size)[at]
        gain = self.n * np.log(self.n / np.repeat(self.whole, self.size) / other)
        return np.add.reduceat(gain, self.at) >= FLOOR if len(gain) else np.zeros(0, bool)


def retained(levels: dict[int, Level], ends: np.ndarray) -> dict[int, np.ndarray]:
    """Which contexts of each depth are kept: those that pass and suffixes of
    kept ones. ``levels`` are of adjacent depths; the least is only compared
    with. ``ends``: suffixes, of the greatest depth, of kept longer contexts."""
    kept = {}
    for d in sorted(levels, reverse=True)[:-1]:
        kept[d] = levels[d].passes(d, levels[d - 1])
        kept[d][np.searchsorted(levels[d].context, ends)] = True
        ends = np.unique(levels[d].context[kept[d]] & ((1 << 8 * (d - 1)) - 1))
    return kept


def _names(levels: dict[int, Level], kept: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(sorted names, counts) of the grams of kept contexts."""
    own = {d: np.repeat(kept[d], levels[d].size) for d in sorted(kept)}
    return (np.concatenate([levels[d].gram[own[d]] | d << 56 for d in own]),
            np.concatenate([levels[d].n[own[d]] for d in own]))


def model_rows(top, parts: int):
    """Partial counts of whole parts -> the retained grams of each part.
    ``top``: the grams of CORE - 1 context symbols with their counts."""

    def go(batches):
        held, bound = [], _MERGE // 2
        for b in batches:
            key, n = _full(b)
            held.append((turned(key), n))
            if sum(len(p[0]) for p in held) > bound:
                held = [_merge(held)]
                bound = max(_MERGE // 2, 2 * len(held[0][0]))
        if held:
            levels = {DEPTH: Level(*_merge(held))}
            del held
            for d in range(DEPTH, CORE, -1):
                levels[d - 1] = levels[d].suffixes(d)
            levels[CORE - 1] = Level(*top.value)
            name, n = _names(levels, retained(levels, np.zeros(0, np.int64)))
            yield from _dealt(0, name, n, part_of(name, parts))
    return go


def contexts_of(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, totals, numbers of grams) of the contexts of sorted names of grams."""
    context = (gram >> 56 << 56) | (gram & _LOW) >> 8
    at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(gram) else np.zeros(0, int)
    return context[at], np.add.reduceat(n, at) if len(at) else n, np.diff(np.r_[at, len(gram)])


def suffix_of(context: np.ndarray) -> np.ndarray:
    """Names of the contexts (of at least one symbol) without their oldest symbol."""
    up = (context >> 56) - 1
    return context & ((1 << 8 * up) - 1) | up << 56


def _context_rows(batches):
    """Parts of the table -> context, whole, grams."""
    for b in batches:
        for name, n in zip(b.column(2), b.column(3)):
            yield pa.RecordBatch.from_arrays(
                list(map(pa.array, contexts_of(name.values.to_numpy(), n.values.to_numpy()))),
                names=["context", "whole", "grams"])


def _chosen_rows(first, inside):
    """Parts of the table -> the grams of the contexts ``first`` (kind 0) and
    other contexts whose suffix is in the tree (kind 1)."""

    def go(batches):
        for b in batches:
            for name, n in zip(b.column(2), b.column(3)):
                name, n = name.values.to_numpy(), n.values.to_numpy()
                context, _, size = contexts_of(name, n)
                hit = lookup(first.value, context)[1]
                own = np.repeat(hit, size)
                border = context[~hit]
                border = border[lookup(inside.value, suffix_of(border))[1]]
                for kind, x, y in ((0, name[own], n[own]), (1, border, border)):
                    yield from _dealt(kind, x, y, np.zeros(len(x), np.int32))
    return go


def lookup(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of ``wanted`` in the sorted ``names``, whether it is there)."""
    if not len(names):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


class Near:
    """Counts of contexts beyond the tree, made from their names (depth above 56
    bits of symbols) and totals and the names and counts of their grams. Held
    are sorted names of contexts in the order of turned keys, and sorted grams
    (place of the context, symbol). ``far``: packed flags of the contexts that
    only the table has, None if none."""

    def __init__(self, context: np.ndarray, whole: np.ndarray, gram: np.ndarray, n: np.ndarray,
                 far: np.ndarray | None = None):
        context = self.turned(context)
        order = np.argsort(context)
        self.context, self.whole = context[order], whole[order]
        place = np.searchsorted(self.context, self.turned((gram >> 56 << 56) | (gram & _LOW) >> 8))
        gram = (place << 8 | gram & 255).astype(np.int32 if len(context) < 1 << 23 else np.int64)
        order = np.argsort(gram)
        self.gram, n = gram[order], n[order]
        self.n = n.astype(np.int32) if not len(n) or n.max() < 1 << 31 else n
        self.far = far

    @staticmethod
    def turned(context: np.ndarray) -> np.ndarray:
        return context >> 56 << 56 | turned(context << 8 & _LOW)

    def elsewhere(self, context: np.ndarray) -> np.ndarray:
        """False where the table surely lacks the context."""
        if self.far is None:
            return np.zeros(len(context), bool)
        at = mix(context.view(np.uint64)) & np.uint64(8 * len(self.far) - 1)
        return (self.far[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


class Tree:
    """The fitted tree: child[node][column] (0: none, OUTSIDE: a context
    beyond the tree) and log10 probabilities of each node. Symbols that were
    seen have a column each, all others share the last one (its probability
    is that of each of them). ``near``: the next contexts."""

    def __init__(self, column: np.ndarray, child: np.ndarray, logp: np.ndarray):
        self.column, self.child, self.logp = column, child, logp
        none = np.zeros(0, np.int64)
        self.near = Near(none, none, none, none)

    def walk(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each key's symbol at the node that its context
        reaches; the depth of that node if the context goes on outside, or -1."""
        width, child = self.child.shape[1], self.child.ravel()
        node, reached = np.zeros(len(key), np.int64), np.full(len(key), -1)
        live = np.arange(len(key))
        for d in range(1, DEPTH + 1):
            to = child[node[live] * width + self.column[key[live] >> (8 * d) & 255]]
            outside = to == OUTSIDE
            reached[live[outside]] = d - 1
            on = (to > 0) & ~outside
            live = live[on]
            node[live] = to[on]
        return self.logp.ravel()[node * width + self.column[key & 255]].astype(np.float64), reached

    def look(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each row of symbols, without the symbols whose
        context may go on in the table; rows and keys of those symbols. Such a
        key has the depth that it reached in the tree on top."""
        # Turned keys are sorted as the tree is, and its nodes met in order.
        key, of = np.unique(turned(_context_keys(x, begin)), return_inverse=True)
        key = turned(key)
        value, reached = self.walk(key)
        on = np.flatnonzero(reached >= 0)
        key[on] |= reached[on] << 56
        p, outside = self.descend(key[on], 10.0 ** value[on], self.near)
        value[on] = np.where(outside, 0.0, np.log10(p))
        # Each row has DEPTH symbols in front, which are not scored.
        start = begin[:-1] - DEPTH * np.arange(len(begin) - 1)
        total = np.add.reduceat(value[of], start) if len(start) else np.zeros(0)
        lacks = np.zeros(len(key), bool)
        lacks[on[outside]] = True
        at = np.flatnonzero(lacks[of])
        return total, np.searchsorted(start, at, side="right") - 1, key[of[at]]

    def score(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """log10 probability of each row of symbols, without the table."""
        return self.look(x, begin)[0]

    def reached(self, key: np.ndarray) -> np.ndarray:
        """Probability of each key's symbol at the node that it reached."""
        width, flat = self.child.shape[1], self.child.ravel()
        node = np.zeros(len(key), np.int64)
        for d in range(1, DEPTH + 1):
            on = np.flatnonzero(key >> 56 >= d)
            node[on] = flat[node[on] * width + self.column[key[on] >> (8 * d) & 255]]
        return 10.0 ** self.logp[node, self.column[key & 255]].astype(np.float64)

    def descend(self, key: np.ndarray, p: np.ndarray, near: Near) -> tuple[np.ndarray, np.ndarray]:
        """Each key's way on through the near contexts, from the node that it
        reached and the probability ``p`` there: its symbol's probability, and
        whether the next context may be in the table."""
        p, depth = p.copy(), key >> 56
        stopped, outside = np.zeros(len(key), bool), np.zeros(len(key), bool)
        order = turned(key & _LOW)
        for d in range(1, DEPTH + 1):
            on = np.flatnonzero((depth == d - 1) & ~stopped)
            rest = 8 * (DEPTH + 1 - d)
            at, hit = lookup(near.context, order[on] >> rest << rest | d << 56)
            off = on[~hit]
            stopped[off] = True
            outside[off] = near.elsewhere((key[off] >> 8 & ((1 << 8 * d) - 1)) | (d << 56))
            on, at = on[hit], at[hit]
            place, seen = lookup(near.gram, (at << 8 | key[on] & 255).astype(near.gram.dtype))
            n = np.where(seen, near.n[place], 0) if len(on) else np.zeros(0)
            p[on] = (n + PRIOR * p[on]) / (near.whole[at] + PRIOR)
            depth[on] = d
        return p, outside


def build_tree(depth: np.ndarray, context: np.ndarray, symbol: np.ndarray, n: np.ndarray,
               outside: tuple[np.ndarray, np.ndarray] | None = None) -> Tree:
    """The tree of the given counts; contexts must be closed under suffixes.
    Symbols without a count share the smoothing weight. ``outside``: depths
    and contexts of the children that get a mark only."""
    if not len(depth):
        return Tree(np.zeros(256, np.int64), np.zeros((1, 1), np.uint16),
                    np.full((1, 1), -np.log10(256.0), np.float32))
    name = context | (depth.astype(np.int64) << 56)
    nodes, of = np.unique(name, return_inverse=True)
    d, ctx = nodes >> 56, nodes & ((1 << 56) - 1)
    order = np.arange(len(nodes))              # by depth: the root is number 0
    seen = np.unique(symbol)
    column = np.full(256, len(seen), np.int64)
    column[seen] = np.arange(len(seen))
    width = len(seen) + 1
    count = np.zeros((len(nodes), width))
    count[of, column[symbol]] = n

    def suffix(d: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        up = np.maximum(d.astype(np.int64) - 1, 0)
        return np.searchsorted(nodes, np.where(d > 0, (ctx & ((np.int64(1) << (8 * up)) - 1)) | (up << 56), 0))

    parent = suffix(d, ctx)
    child = np.zeros((len(nodes), width), np.uint16)
    deep = order[d > 0]
    oldest = (ctx[deep] >> (8 * (d[deep] - 1))) & 255
    far_d, far = outside if outside is not None else (np.zeros(0, np.int64),) * 2
    far_oldest = (far >> (8 * (far_d.astype(np.int64) - 1))) & 255
    every = np.concatenate([oldest, far_oldest])
    known = column[every] < len(seen)          # marks before a text never follow a symbol
    marks = np.unique(every[~known])
    if len(marks):                             # they need a column to descend by
        extra = len(marks)
        column[marks] = width + np.arange(extra)
        child = np.zeros((len(nodes), width + extra), np.uint16)
        count = np.pad(count, ((0, 0), (0, extra)))
    child[parent[deep], column[oldest]] = deep
    child[suffix(far_d, far), column[far_oldest]] = OUTSIDE
    p = np.empty_like(count)
    p[0] = (count[0] + ADD) / (count[0].sum() + 256 * ADD)
    for level in range(1, int(d.max()) + 1):
        at = order[d == level]
        p[at] = (count[at] + PRIOR * p[parent[at]]) / (count[at].sum(1, keepdims=True) + PRIOR)
    return Tree(column, child, np.log10(p).astype(np.float32))


def _far_hashes(first):
    """Contexts -> the hashes by which ``Near.elsewhere`` asks for them, without
    those of ``first``."""

    def go(batches):
        for b in batches:
            name = b.column(0).to_numpy()
            name = name[~lookup(first.value, name)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(signed(mix(name.view(np.uint64))))], names=["h"])
    return go


def _step(whole: Column) -> Column:
    """Eighths of octaves."""
    return F.floor(F.log2(whole) * 8).cast("int")


def _edge(ladder: list, room: int) -> tuple[int, int]:
    """(the greatest step that at least ``room`` counts reach, or the least
    step; how many counts there are in all)."""
    edge, reached = 0, 0
    for s, n in sorted(ladder, reverse=True):
        if reached < room:
            edge = s
        reached += n
    return edge, reached


def fit_tree(top: DataFrame, model, nodes: int | None = None, near: int | None = None) -> tuple[Tree, tuple | None]:
    """Divergence tests: the tree of the ``nodes`` most frequent retained
    contexts with the next ``near`` ones beside it, and the table of all
    contexts of CORE symbols or more with the arrays for a ``Near`` of all shorter
    ones, or None if no context is left out. ``top``: counts (key, n) of the contexts of
    CORE - 1 symbols; ``model``: from their broadcast to the table."""
    spark = top.sparkSession
    nodes, near = NODES if nodes is None else nodes, NEAR if near is None else near
    top = top.toArrow()                        # bounded by the alphabet
    key, n = _merge([(top["key"].to_numpy(), top["n"].to_numpy())])
    if not len(key):
        return build_tree(*[np.zeros(0, np.int64)] * 4), None
    table = bounded(model(spark.sparkContext.broadcast((key, n))), "op2-model")
    release(spark)
    contexts = table.mapInArrow(_context_rows, "context long, whole long, grams long")

    # The shorter contexts: kept if they pass or end a kept one of CORE symbols.
    levels = {CORE - 1: Level(key, n)}
    for d in range(CORE - 1, 0, -1):
        levels[d - 1] = levels[d].suffixes(d)
    ends = contexts.filter(F.shiftright("context", 56) == CORE).select(
        F.col("context").bitwiseAND((1 << 8 * (CORE - 1)) - 1).alias("end")).distinct().toArrow()
    kept = {**retained(levels, np.unique(ends["end"].to_numpy())), 0: np.ones(1, bool)}
    up_gram, up_n = _names(levels, kept)
    up_context, up_whole, up_grams = contexts_of(up_gram, up_n)

    # A suffix is at least as frequent, and comes first when it ties: every
    # front part of this order is closed under suffixes.
    ladder = contexts.groupBy(_step(F.col("whole")).alias("s")).count().collect()
    edge, count = _edge(ladder, nodes + near)
    some = contexts.filter(_step(F.col("whole")) >= edge).toArrow()
    context, whole, grams = (np.concatenate([own, some[c].to_numpy()]) for own, c in (
        (up_context, "context"), (up_whole, "whole"), (up_grams, "grams")))
    count += len(up_context)
    del some
    order = np.lexsort((context, -whole))[:nodes + near]
    fits = int(np.searchsorted(np.cumsum(grams[order[nodes:]]), NEAR_GRAMS, side="right"))
    names, whole = context[order[:nodes + fits]], whole[order[nodes:nodes + fits]]
    first, inside = np.sort(names), np.sort(names[:nodes])
    shared = spark.sparkContext.broadcast(first)

    chosen = table.mapInArrow(_chosen_rows(shared, spark.sparkContext.broadcast(inside)), PART_SCHEMA).toArrow()
    arrays: dict[int, list] = {0: [], 1: []}   # views, copied once
    for b in chosen.to_batches():
        for kind, name, n in zip(b.column(1).to_pylist(), b.column(2), b.column(3)):
            arrays[kind].append((name.values.to_numpy(), n.values.to_numpy()))
    own = lookup(first, (up_gram >> 56 << 56) | (up_gram & _LOW) >> 8)[1]
    gram = np.concatenate([up_gram[own], *(x for x, _ in arrays[0])])
    n = np.concatenate([up_n[own], *(x for _, x in arrays[0])])
    # Children of the tree's nodes beyond it: at most one per node and symbol.
    others = up_context[~lookup(first, up_context)[1]]
    border = np.concatenate([names[nodes:], others])
    border = border[border >> 56 > 0]
    marks = np.concatenate([border[lookup(inside, suffix_of(border))[1]], *(x for x, _ in arrays[1])])
    chosen = arrays = b = name = None
    own = lookup(inside, (gram >> 56 << 56) | (gram & _LOW) >> 8)[1]
    tree = build_tree(gram[own] >> 56, (gram[own] & _LOW) >> 8, gram[own] & 255, n[own],
                      (marks >> 56, marks & _LOW))
    far = further = None
    if count > len(names):
        bits = min(SKETCH_MOST, 1 << max(20, (SKETCH * (count - len(names)) - 1).bit_length()))
        far = packed_sketch(contexts.select("context").mapInArrow(_far_hashes(shared), "h long"), "h", bits)
        at = mix(others.view(np.uint64)) & np.uint64(bits - 1)
        np.bitwise_or.at(far, (at >> np.uint64(3)).astype(np.int64),
                         np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        further = table, (up_context, up_whole, up_gram, up_n)
    tree.near = Near(names[nodes:], whole, gram[~own], n[~own], far)
    return tree, further


def far_keys(parts: int):
    """(number, lacks) -> the keys with the numbers of their rows, dealt into parts."""

    def go(batches):
        held, size = [], 0
        for b in batches:
            count = b.column(1).value_lengths().fill_null(0).to_numpy()
            held.append((b.column(1).flatten().to_numpy(), np.repeat(b.column(0).to_numpy(), count)))
            size += len(held[-1][0])
            if size > _MERGE // 2:
                key, number = map(np.concatenate, zip(*held))
                yield from _dealt(1, key, number, part_of(key, parts))
                held, size = [], 0
        if size:
            key, number = map(np.concatenate, zip(*held))
            yield from _dealt(1, key, number, part_of(key, parts))
    return go


def _sums(held: list) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, sums) of (numbers, values)."""
    number, of = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
    return number, np.bincount(of, np.concatenate([v for _, v in held]))


def far_scores(tree, shorter):
    """Rows sorted by part, the table's before the keys -> sums over the keys of
    a row of log10 probabilities, smoothed level by level: arrays of numbers and
    values for each task that numbered the rows (block)."""

    def go(batches):
        t: Tree = tree.value
        short = shorter.value
        up = Near(*short)
        held, size = [], 0
        own, near = -1, up

        def out():
            number, value = _sums(held)
            block, n = np.unique(number >> 40, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), list_array(number, n, pa.int64()), list_array(value, n, pa.float64())],
                names=["block", "number", "value"])

        for b in batches:
            for part, kind, name, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                name, n = name.values.to_numpy(), n.values.to_numpy()
                if kind == 0:
                    context, whole, _ = contexts_of(name, n)
                    near = Near(*map(np.concatenate, zip(short, (context, whole, name, n))))
                    own = part
                    continue
                key, of = np.unique(name, return_inverse=True)
                # A key that the sketch let through in vain keeps its probability.
                p = t.descend(key, t.reached(key), near if part == own else up)[0]
                held.append((n, np.log10(p)[of]))
                size += len(n)
                if size > _MERGE // 2:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()
    return go


def row_sums(batches):
    """Whole blocks -> (number, more_score)."""
    held, bound = [], _MERGE
    for b in batches:
        held.append((b.column(1).flatten().to_numpy(), b.column(2).flatten().to_numpy()))
        if sum(len(x) for x, _ in held) > bound:
            held = [_sums(held)]
            bound = max(_MERGE, 2 * len(held[0][0]))
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, _sums(held))), names=["number", "more_score"])


def score_rows(tree, frequent):
    """(doc_id, text) -> per row: a number of its own, hashes of the whole
    text, tokens, known and base sum of the frequent words, score, the other
    words, and the keys of the symbols that the score lacks."""

    def go(batches):
        t: Tree = tree.value
        words, counts = frequent.value
        number = TaskContext.get().partitionId() << 40
        for b in chunks(batches):
            w = Words(b.column(1), lower=True)
            h1, h2 = w.row_hash()
            own, of = np.unique(w.hash, return_inverse=True)
            at = np.minimum(np.searchsorted(words, own), max(len(words) - 1, 0))
            hit = words[at] == own if len(words) else np.zeros(len(own), bool)
            value = np.where(hit, np.log10(np.where(hit, counts[at] if len(words) else 0, 0) + ADD), 0.0)
            found = hit[of]
            total = np.zeros(b.num_rows)
            np.add.at(total, w.rows(), value[of])
            known = w.sums(found)
            score, lacks, key = t.look(*symbols(w))
            at, number = number, number + b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.arange(at, number)), pa.array(signed(h1)), pa.array(signed(h2)), pa.array(w.counts + 1),
                 pa.array(known), pa.array(total), pa.array(score),
                 list_array(signed(w.hash[~found]), w.counts - known, pa.int64()),
                 list_array(key, np.bincount(lacks, minlength=b.num_rows), pa.int64())],
                names=["doc_id", "number", "h1", "h2", "n_tokens", "known", "base", "score", "rare", "lacks"])
    return go


SCORE_SCHEMA = ("doc_id long, number long, h1 long, h2 long, n_tokens long, known long, base double, "
                "score double, rare array<long>, lacks array<long>")


def score_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every document, learned from those whose crc32 modulo 10 is not 0."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    training = texts.filter(crc_mod("doc_id", 10) != 0)
    ends, size = training.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    cuts = max(16, -(-size // PART_BYTES))
    parts = PARTS * cuts
    counts = bounded(training.select("text").mapInArrow(_count_rows, "kind int, key long, n long")
                     .groupBy("kind", "key").agg(F.sum("n").alias("n")), "op2-counts")
    release(spark)

    def model(top) -> DataFrame:
        return (training.select("text").mapInArrow(count_contexts(parts), PART_SCHEMA).repartition(cuts, "part")
                .mapInArrow(model_rows(top, parts), PART_SCHEMA))

    vocabulary = counts.filter("kind = 0").select(F.col("key").alias("word"), F.col("n").alias("c"))
    tree, further = fit_tree(counts.filter("kind = 1").select("key", "n"), model)
    tree = spark.sparkContext.broadcast(tree)
    tokens, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    # The least count that at most FREQUENT words reach (by eighths of octaves).
    step = _step(F.col("c"))
    ladder = sorted(vocabulary.groupBy(step.alias("s")).count().collect(), reverse=True)
    room, edge = FREQUENT, None
    for s, n in ladder:
        room -= n
        if room < 0:
            break
        edge = s
    often = vocabulary.filter(step >= edge) if edge is not None else vocabulary.limit(0)
    top = often.toArrow()
    key = top["word"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    frequent = spark.sparkContext.broadcast((key[order], top["c"].to_numpy()[order]))
    seldom = vocabulary.filter(step < edge) if edge is not None else vocabulary
    rows = bounded(texts.mapInArrow(score_rows(tree, frequent), SCORE_SCHEMA), "op2-rows")
    # Words outside the broadcast, once per distinct text.
    rare = (rows.filter(F.size("rare") > 0).groupBy("h1", "h2").agg(F.first("rare").alias("rare"))
            .select("h1", "h2", F.explode("rare").alias("word")))
    more = (rare.groupBy("word", "h1", "h2").agg(F.count("*").alias("times"))
            .join(seldom, "word", "left")
            .groupBy("h1", "h2").agg(
                F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
                F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))).alias("more_base")))
    total = F.col("score")
    if further is not None:
        table, shorter = further
        keys = rows.select("number", "lacks").mapInArrow(far_keys(parts), PART_SCHEMA)
        deeper = (table.unionByName(keys).repartition(cuts, "part").sortWithinPartitions("part", "kind")
                  .mapInArrow(far_scores(tree, spark.sparkContext.broadcast(shorter)),
                             "block long, number array<long>, value array<double>")
                  .repartition(cuts, "block").mapInArrow(row_sums, "number long, more_score double"))
        rows = rows.join(deeper, "number", "left")
        total = total + F.coalesce("more_score", F.lit(0.0))
    end_known = 1 if ends else 0
    scale = float(np.log10(tokens + ADD * (distinct + 1)))
    end_value = float(np.log10(ends + ADD))
    return rows.drop("rare", "lacks").join(more, ["h1", "h2"], "left").select(
        "doc_id", (crc_mod("doc_id", 10) == 0).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + end_known).cast("long").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + end_value - F.col("n_tokens") * scale)
        .alias("base_score"), total.alias("score"))
