"""Sequence packing by swap-based local search (operator 9).

Every text becomes ids of the byte-level vocabulary and one end id. A document
of more than ``SIZE`` tokens is cut into full pieces, the first one taking the
rest; nothing else is cut. Pieces are placed into sequences of at most SIZE
tokens, as few as the search can find.

Method. Pieces are dealt by a hash of their number into groups of about
``GROUP`` pieces, packed independently (a group costs at most one sequence
that is not full, a share that does not grow with the data). Within a group,
best fit by falling length fills bins; then local search works on the bins
below SIZE: it moves a piece into another bin, exchanges one piece for one, or
two for one, whenever that raises the sum of squared fills, for the emptiest
bin that waits for its turn. Bins that run empty are dropped, until every bin was
tried without gain since the last exchange. Only lengths take part.

Defined results: null text is empty and packs as its end id; a piece of full
length is a sequence of its own; rows that repeat a doc_id are packed as
documents of their own with equal doc_id; a null doc_id is kept; other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import stored
from encore.llm.pieces import Encoder, Texts
from encore.llm.words import chunks

SIZE = 1024
END_ID = 2
GROUP = 20_000
CACHED_PIECES = 60_000        # of each of a worker's two generations
CHUNK_BYTES = 1 << 20          # text tokenized at once
#: ASCII and Latin letters, which any version of Unicode knows as letters.
PLAIN = r"\A[\x00-\x7FÀ-ÖØ-öø-ɏ]*\z"
#: White space so long that the scanner of the rank form might give up.
LONG_BLANK = r"[\x09-\x0D\x1C-\x20]{900}"
#: What a pattern says of runs of white space, and the same for single ones
#: (without looking ahead, a third less time).
RUNS, SINGLE = r"\s+(?!\S)|\s+", r"\s"
_BUILT: dict[tuple, Texts] = {}


def text_encoder(json_path: str, ranks_path: str, pattern: str) -> Texts:
    """The worker's encoder. Texts of ASCII and Latin letters go through the
    rank form of the same vocabulary (same ids, a sixth of the time); pieces
    of all others, and of those that touch the special token, through the
    tokenizer, which is loaded when the first one comes."""
    key = (json_path, ranks_path)
    if key not in _BUILT:
        import tiktoken

        from encore.llm.byte_bpe import read_ranks

        def scanner(pattern):
            return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path),
                                     special_tokens={}).encode_ordinary

        single, runs = scanner(pattern.replace(RUNS, SINGLE)), cache(lambda: scanner(pattern))
        has_run = re.compile(r"\s\s").search

        def whole(text):
            return np.array((runs() if has_run(text) else single)(text), np.uint32)

        def pieces():
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(json_path)

            def many(pieces):
                # In parts, since the results of a call are much larger than the ids.
                return [np.array(e.ids, "<u2").tobytes() for i in range(0, len(pieces), 4096)
                        for e in slow.encode_batch_fast(pieces[i:i + 4096], add_special_tokens=False)]

            return Encoder(many, cache=CACHED_PIECES)

        _BUILT.clear()
        _BUILT[key] = Texts(PLAIN, LONG_BLANK, whole, pieces)
    return _BUILT[key]


def with_ends(ids: np.ndarray, row: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after each row, and the new offsets."""
    rows = len(row) - 1
    out = np.empty(len(ids) + rows, np.uint32)
    new = row + np.arange(rows + 1)
    ends = np.zeros(len(out), bool)
    ends[new[1:] - 1] = True
    out[ends] = end_id
    out[~ends] = ids
    return out, new


def piece_rows(json_path: str, ranks_path: str, pattern: str, size: int = SIZE, keep_ids: bool = False):
    """(doc_id, text) -> one row per piece."""

    def go(batches):
        encoder = text_encoder(json_path, ranks_path, pattern)
        for b in chunks(batches, max_bytes=CHUNK_BYTES):
            ids, row = with_ends(*encoder.batch(b.column(1)), END_ID)
            raw = ids.astype("<u4").tobytes()
            n = np.diff(row)
            count = -(-n // size)
            who = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
            rest = n - (count - 1) * size
            start = np.where(piece == 0, 0, rest[who] + (piece - 1) * size)
            length = np.where(piece == 0, rest[who], size)
            at = row[who] + start
            crc = [zlib.crc32(raw[4 * s:4 * (s + k)]) for s, k in zip(at.tolist(), length.tolist())]
            cols = [b.column(0).take(pa.array(who)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                cols.append(pa.array([raw[4 * s:4 * (s + k)] for s, k in zip(at.tolist(), length.tolist())],
                                     pa.binary()))
                names.append("ids")
            for i in range(0, len(who), 10_000):
                yield pa.RecordBatch.from_arrays([c.slice(i, 10_000) for c in cols], names=names)
    return go


def best_fit(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """Bins (lists of lengths), longest first into the fullest bin with room."""
    by_room: list[list[int]] = [[] for _ in range(size + 1)]   # open bins by free room
    rooms: list[int] = []                                       # sorted rooms in use
    bins: list[list[int]] = []
    for x in sorted(lengths, reverse=True):
        k = bisect_left(rooms, x)
        if k < len(rooms):
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(k)
        else:
            room, b = size, len(bins)
            bins.append([])
        bins[b].append(x)
        left = room - x
        if left:
            if not by_room[left]:
                insort(rooms, left)
            by_room[left].append(b)
    return bins


def _best_exchange(own: list[int], fill_own: int, length: np.ndarray, room: np.ndarray, size: int):
    """The exchange with the largest gain that takes tokens out of a bin with
    the lengths ``own``, by trying all (``local_search`` finds it by an index
    and is tested against this): (gain, what leaves it, item that comes back or -1,
    item of the receiving bin). ``length``, ``room``: items of all other
    underfull bins and the free room of their bin."""
    best = (0, (), -1, -1)
    fill = size - room
    leaving = {(y,) for y in own} | {(y, z) for i, y in enumerate(own) for z in own[i + 1:]}
    for out in leaving:
        total = sum(out)
        if len(out) == 1:                      # move
            fits = np.flatnonzero(room >= total)
            if len(fits):
                k = fits[np.argmax(fill[fits])]
                gain = 2 * total * (int(fill[k]) - fill_own + total)
                if gain > best[0]:
                    best = (gain, out, -1, int(k))
        shift = total - length                 # exchange against one item
        fits = np.flatnonzero((shift > 0) & (shift <= room))
        if len(fits):
            s = shift[fits]
            gains = 2 * s * (fill[fits] - fill_own + s)
            k = int(np.argmax(gains))
            if gains[k] > best[0]:
                best = (int(gains[k]), out, int(fits[k]), int(fits[k]))
    return best


class _Rooms:
    """Items of the underfull bins by length and free room of their bin; the
    bin itself is an item of length 0."""

    def __init__(self, size: int):
        self.size = size
        self.bins: dict[tuple[int, int], dict[int, None]] = {}
        self.kinds = np.zeros(size + 1, np.int64)               # rooms in use of each length
        # Smallest room in use that is at least so large (size: none).
        self.next = np.full((size + 1, size + 1), size, np.int64)

    def add(self, b: int, own: list[int], fill: int) -> None:
        room = self.size - fill
        for x in {0, *own} if 0 < room < self.size else ():
            held = self.bins.setdefault((x, room), {})
            if not held:
                line = self.next[x, :room + 1]
                np.minimum(line, room, out=line)
                self.kinds[x] += 1
            held[b] = None

    def remove(self, b: int, own: list[int], fill: int) -> None:
        room = self.size - fill
        for x in {0, *own} if 0 < room < self.size else ():
            held = self.bins[x, room]
            del held[b]
            if not held:
                line = self.next[x, :room + 1]
                line[line == room] = self.next[x, room + 1]
                self.kinds[x] -= 1

    def best(self, own: list[int], fill: int) -> tuple[tuple[int, ...], int, int] | None:
        """The exchange with the largest gain for a bin that is not in here:
        (what leaves it, length that comes back or 0, receiving bin)."""
        kinds = sorted(set(own))
        leaving = {}
        for i, y in enumerate(kinds):
            for z in kinds[i if own.count(y) > 1 else i + 1:]:
                leaving.setdefault(y + z, (y, z))
        leaving.update((y, (y,)) for y in kinds)
        total = np.array(list(leaving))[:, None]
        back = np.flatnonzero(self.kinds)
        shift = total - back
        ok = shift > 0
        room = self.next[back, np.where(ok, np.minimum(shift, self.size), self.size)]
        single = np.array([len(out) == 1 for out in leaving.values()])[:, None]
        ok &= (room < self.size) & (single | (back > 0))
        gain = np.where(ok, shift * (self.size - room - fill + shift), 0)
        if not gain.size or gain.max() <= 0:
            return None
        i, j = np.unravel_index(gain.argmax(), gain.shape)
        return leaving[int(total[i, 0])], int(back[j]), next(iter(self.bins[int(back[j]), int(room[i, j])]))


def local_search(bins: list[list[int]], size: int = SIZE) -> list[list[int]]:
    """Moves, one-for-one and two-for-one exchanges out of the emptiest bins
    until they run empty or nothing raises the sum of squared fills."""
    bins = [list(b) for b in bins]
    fill = [sum(b) for b in bins]
    rooms = _Rooms(size)
    for b, own in enumerate(bins):
        rooms.add(b, own, fill[b])
    changed = True
    while changed:                             # a last round tries all bins in vain
        changed = False
        waiting = [(f, b) for b, f in enumerate(fill) if 0 < f < size]
        heapify(waiting)
        while waiting:
            f, b = heappop(waiting)
            if f != fill[b]:
                continue
            own = bins[b]
            rooms.remove(b, own, f)
            found = rooms.best(own, f)
            if found is None:
                rooms.add(b, own, f)
                continue
            out, back, to = found
            rooms.remove(to, bins[to], fill[to])
            for y in out:
                own.remove(y)
                bins[to].append(y)
            if back:
                bins[to].remove(back)
                own.append(back)
            for k in (b, to):
                fill[k] = sum(bins[k])
                rooms.add(k, bins[k], fill[k])
                if 0 < fill[k] < size:
                    heappush(waiting, (fill[k], k))
            changed = True
    return [b for b in bins if b]


def pack_lengths(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """(bin number, offset in it) of each length."""
    bins = local_search(best_fit([int(x) for x in lengths if x < size], size), size)
    place: dict[int, list[tuple[int, int]]] = {}
    for k, b in enumerate(bins):
        at = 0
        for x in b:
            place.setdefault(x, []).append((k, at))
            at += x
    number = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    whole = len(bins)
    for i, x in enumerate(lengths):
        if x >= size:
            number[i], offset[i] = whole, 0
            whole += 1
        else:
            number[i], offset[i] = place[int(x)].pop()
    return number, offset


def pack(pieces: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with sequence_id and offset."""
    schema = pieces.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    # Stored, since the numbers change when rows are computed again; equal or
    # null ids would fill one group if the ids were dealt.
    pieces = stored(pieces.withColumn("number", F.monotonically_increasing_id()), "op9-pieces")
    n = pieces.count()
    groups = max(1, -(-n // group))

    def go(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns("part").sort_by(
            [("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"),
             ("number", "ascending")]).drop_columns("number")
        number, offset = pack_lengths(rows["length"].to_numpy(), size)
        rows = rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + number))
        return rows.append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(go, f"{schema}, sequence_id long, offset long")


def pack_query(docs: DataFrame, json_path: str, ranks_path: str, pattern: str,
               size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    pieces = slim.mapInArrow(
        piece_rows(json_path, ranks_path, pattern, size),
        "doc_id long, piece int, start long, length long, ids_crc32 long")
    return pack(pieces, size)
