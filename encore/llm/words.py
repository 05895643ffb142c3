"""Words of whole Arrow batches as numpy arrays.

A word is a maximal run of bytes other than blank and 0x09-0x0D. UTF-8 never
uses those bytes inside a character, so the text is scanned as bytes, a few
megabytes at a time, and no Python object is made per word. Null text counts
as empty.

Hashes are polynomials modulo 2**64 over a fixed random byte table, finished
with a 64-bit mixer. Prefix sums give the hash of any run of words in O(1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts handled at once, unless one alone is longer (with one byte more the
#: tables of powers would be twice as long).
CHUNK_BYTES = (1 << 19) - 1
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_WBASE = np.uint64(0xD6E8FEB86659FD93)
_WBASE2 = np.uint64(0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def _table(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    if lower:
        t[65:91] = t[97:123]
    return t


_TABLES = {False: _table(False), True: _table(True)}
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (grown on demand, kept)."""
    have = _POWERS.get(int(base))
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inv = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])
                     .cumprod(dtype=np.uint64) for b in (base, inv))
        _POWERS[int(base)] = have
    return have


def chunks(batches, column: str = "text", max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the record batches with at most ``max_bytes`` of text each
    (or a single row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        arr = batch.column(batch.schema.get_field_index(column))
        sizes = pc.binary_length(arr).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(ends):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string or binary array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] \
        else np.zeros(0, np.uint8)
    return raw, off - off[0]


class Words:
    """Words of the rows of one string array.

    start, end: byte positions of each word; row: first word of each row
    (one more entry than rows); hash: 64-bit word hashes.
    """

    def __init__(self, arr: pa.Array, lower: bool = False):
        self.raw, self.offsets = raw, off = text_bytes(arr)
        n = len(raw)
        solid = np.ones(n + 2, dtype=bool)
        solid[0] = solid[-1] = False
        np.logical_not(_BLANK[raw], out=solid[1:-1])
        body = solid[1:-1]
        first = body & ~solid[:-2]
        last = body & ~solid[2:]
        edges = off[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        first[edges] |= body[edges]
        last[edges - 1] |= body[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.start, off)
        p, q = powers(_BASE, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLES[lower][raw] * p[:n], out=total[1:])
        h = (total[self.end] - total[self.start]) * q[self.start]
        self.hash = mix(h + (self.end - self.start).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        """Words of each row."""
        return np.diff(self.row)

    def sums(self, x: np.ndarray) -> np.ndarray:
        """Sum of ``x`` (an entry per word) over each row."""
        total = np.zeros(len(self) + 1, np.int64)
        np.cumsum(x, out=total[1:])
        return total[self.row[1:]] - total[self.row[:-1]]

    def rows(self) -> np.ndarray:
        """Row number of each word."""
        return np.repeat(np.arange(len(self.row) - 1), self.counts)

    def runs(self, size: int, second: bool = False) -> np.ndarray:
        """Hash of the ``size`` words from each word on. Entries whose run
        would leave the row or the array are meaningless (see fits)."""
        return run_hash(self.hash, size, second)

    def fits(self, size: int) -> np.ndarray:
        """True where a run of ``size`` words stays within its row."""
        return np.arange(len(self)) + size <= np.repeat(self.row[1:], self.counts)

    def row_hash(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each row's whole word sequence."""
        out = []
        for second in (False, True):
            total, q = _prefix(self.hash, second)
            h = (total[self.row[1:]] - total[self.row[:-1]]) * q[self.row[:-1]]
            out.append(mix(h + self.counts.astype(np.uint64)))
        return out[0], out[1]


def _prefix(h: np.ndarray, second: bool) -> tuple[np.ndarray, np.ndarray]:
    p, q = powers(_WBASE2 if second else _WBASE, len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum((mix(h ^ _BASE) if second else h) * p[:len(h)], out=total[1:])
    return total, q


def run_hash(h: np.ndarray, size: int, second: bool = False) -> np.ndarray:
    total, q = _prefix(h, second)
    n = len(h)
    out = np.zeros(n, np.uint64)
    m = max(0, n - size + 1)
    out[:m] = mix((total[size:size + m] - total[:m]) * q[:m])
    return out


def list_array(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat, kind))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
