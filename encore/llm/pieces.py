"""Token ids of whole Arrow batches, one tokenizer call per distinct piece.

A text is cut where no token can cross: at single blanks between two
non-blank characters (byte-level vocabularies, the blank begins the next
piece) or at ASCII white space (vocabularies that drop it). Arrow numbers the
distinct pieces of a batch; only pieces that the worker has not met lately are
encoded, the rest come from a cache of bounded size. Ids are 16-bit.

Texts of ASCII and Latin letters need no pieces: ``Texts`` hands them whole to
the rank form of the vocabulary, whose own scanner cuts and merges them. Both
forms give the same ids: each token's listed pair is what the merges before it
leave of the token (a test holds it), and a boundary that remains is never
crossed, so no other pair of the same token ever meets.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once.
CHUNK_BYTES = 8 << 20
CACHE = 500_000                # pieces of each of a worker's two generations
_CUT = re.compile(r"(?<=[^\s\x85\x1c-\x1f]) (?=[^\s\x85\x1c-\x1f])")


def blank_pieces(arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pieces, piece number of each place, first place of each row
    and the total). Joined, the pieces of a row are its text."""
    arr = arr.cast(pa.string()).fill_null("")
    lists = pc.split_pattern(arr, " ")
    off = lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    code = lists.flatten().dictionary_encode()
    names, at = code.dictionary.to_pylist(), code.indices.to_numpy().astype(np.int64)
    bad = np.array([not x or x[0].isspace() or x[-1].isspace() for x in names], dtype=bool)
    first = np.zeros(len(at), bool)
    first[off[:-1]] = True
    both = at * 2 + ~first
    used, at2 = np.unique(both, return_inverse=True)
    pieces = [(" " if u & 1 else "") + names[u >> 1] for u in used.tolist()]
    rough = np.flatnonzero(np.add.reduceat(bad[at], off[:-1]) > 0) if len(arr) else []
    if not len(rough):
        return pieces, at2, off
    # Rows with runs of white space are cut again with care.
    number = {p: i for i, p in enumerate(pieces)}
    per = np.diff(off)
    parts, begin = [], 0
    for r in rough:
        parts.append(at2[off[begin]:off[r]])
        text = arr[int(r)].as_py()
        cuts = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
        own = [text[a:b] for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
        parts.append(np.array([number.setdefault(p, len(number)) for p in own], np.int64))
        per[r] = len(own)
        begin = r + 1
    parts.append(at2[off[begin]:])
    return list(number), np.concatenate(parts), np.r_[0, np.cumsum(per)]


def word_pieces(arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The same for pieces without the ASCII white space between them."""
    arr = arr.cast(pa.string()).fill_null("")
    lists = pc.ascii_split_whitespace(arr)
    off = lists.offsets.to_numpy().astype(np.int64)
    code = lists.flatten().dictionary_encode()
    return code.dictionary.to_pylist(), code.indices.to_numpy().astype(np.int64), off - off[0]


class Encoder:
    """Piece -> ids as bytes, through ``encode_many`` (a list of new pieces ->
    their ids) and two generations of remembered pieces."""

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], cut=blank_pieces,
                 cache: int = CACHE):
        self.encode_many, self.cut, self.cache = encode_many, cut, cache
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def values(self, pieces: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        out = [young.get(p) for p in pieces]
        for i in [i for i, v in enumerate(out) if v is None]:
            v = old.get(pieces[i])
            if v is not None:
                young[pieces[i]] = out[i] = v
        new = [i for i, v in enumerate(out) if v is None]
        for i, v in zip(new, self.encode_many([pieces[i] for i in new])):
            out[i] = young[pieces[i]] = v
        if len(young) > self.cache:
            self.young, self.old = {}, young
        return out

    def batch(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the total)."""
        pieces, at, row = self.cut(arr)
        values = self.values(pieces)
        flat = np.frombuffer(b"".join(values), "<u2")
        size = np.fromiter(map(len, values), np.int64, len(values)) // 2
        return take_runs(flat, np.cumsum(size) - size, size, at, row)


class Texts:
    """Ids of whole texts: those that ``plain`` (a pattern of Arrow) matches,
    ``but`` does not, and that cannot name a special token through ``whole`` (a text -> its ids
    as an array), all others through the encoder of pieces that ``pieces``
    builds at the first such text."""

    def __init__(self, plain: str, but: str, whole: Callable[[str], np.ndarray], pieces: Callable[[], Encoder],
                 before: Callable[[pa.Array], pa.Array] = lambda arr: arr):
        self.plain, self.but, self.whole, self.pieces, self.before = plain, but, whole, pieces, before
        self.other: Encoder | None = None

    def batch(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the total)."""
        arr = arr.cast(pa.string()).fill_null("")
        fast = pc.and_not(pc.match_substring_regex(arr, self.plain),
                          pc.or_(pc.match_substring_regex(arr, self.but), pc.match_substring(arr, "<|")))
        parts = [self.whole(t) for t in self.before(arr.filter(fast)).to_pylist()]
        odd = arr.filter(pc.invert(fast))
        if len(odd):
            self.other = self.other or self.pieces()
            ids, row = self.other.batch(odd)
            either = iter(parts), iter(np.split(ids, row[1:-1]))
            parts = [next(either[not f]) for f in fast.to_pylist()]
        row = np.r_[0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))]
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), row


def take_runs(flat, begin, size, at, row):
    """The runs numbered ``at`` of ``flat`` one after another, and the offset
    of each row (``row``: first run of each row and the total)."""
    n = size[at]
    ends = np.cumsum(n)
    where = np.repeat(begin[at] - (ends - n), n)
    where += np.arange(len(where))
    return flat[where], np.r_[0, ends][row]
