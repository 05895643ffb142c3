"""Byte-level BPE by Aho-Corasick and backtracking (operator 3).

Method. Bytes become Latin-1 characters, so that one pyahocorasick automaton
over the vocabulary finds every token occurrence of a piece in one scan. The
encoder walks left to right, always with the longest token that fits, and
keeps a token only if it may stand next to its predecessor: two tokens are
compatible when undoing their merges, last first, never uncovers a merge
across their border that BPE would have made earlier. Answers are memoised by
pair. When no token fits, the position is marked dead, the last token is
taken back and its next shorter prefix is tried. A position dies at most once,
so the work is linear, and a sequence of pairwise compatible tokens is the
one that BPE's merges produce.

Pieces are the matches of the splitting pattern; ids are decoded by joining
the tokens' bytes.

Defined results: null text is empty, without ids; ids, repeated rows and
other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.pieces import CHUNK_BYTES, Encoder, take_runs
from encore.llm.words import chunks

Vocabulary = namedtuple("Vocabulary", "tokens left right pattern digest")
_MEMO = 1 << 20                # remembered pairs


def read_ranks(path: str) -> dict[bytes, int]:
    """token -> id of a rank file (base64 token and id on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}


def _merge_all(token: bytes, ranks: dict[bytes, int], limit: int) -> list[bytes]:
    """Plain BPE of ``token`` with merges below ``limit`` only."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 1:
        best, at = min((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
        if best >= limit:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def load(path: str, pattern: str) -> Vocabulary:
    """Tokens by id and the two halves whose merge made each (bytes: itself)."""
    ranks = read_ranks(path)
    size = max(ranks.values()) + 1
    tokens: list[bytes] = [b""] * size
    left = np.arange(size, dtype=np.int32)
    right = np.arange(size, dtype=np.int32)
    for token, i in ranks.items():
        tokens[i] = token
        if len(token) > 1:
            halves = _merge_all(token, ranks, i)
            if len(halves) == 2:
                left[i], right[i] = ranks[halves[0]], ranks[halves[1]]
            else:
                left[i] = right[i] = -1        # no merge makes it
    digest = hashlib.sha256(pattern.encode())
    for token in tokens:
        digest.update(len(token).to_bytes(4, "little") + token)
    return Vocabulary(tokens, left, right, pattern, digest.hexdigest())


class ByteBpe:
    """Encoder of single pieces and of batches of texts."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick
        import regex

        tokens, left, right, pattern, _ = vocabulary
        self.split = regex.compile(pattern).findall
        self.left, self.right = left.tolist(), right.tolist()
        self.size = [len(t) for t in tokens]
        self.pair = {(a, b): i for i, (a, b) in enumerate(zip(self.left, self.right))
                     if a >= 0 and not a == b == i}
        self.whole = {t.decode("latin-1"): i for i, t in enumerate(tokens) if t}
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(tokens):
            if t and self.left[i] >= 0:
                self.automaton.add_word(t.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.known: dict[int, bool] = {}
        self.encoder = Encoder(self.encode_many)
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.array(self.size, np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def compatible(self, a: int, b: int) -> bool:
        """True when BPE leaves the border between tokens a and b alone."""
        key = a << 20 | b
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= _MEMO:
                self.known.clear()
            known = self.known[key] = self._border(a, b)
        return known

    def _border(self, a: int, b: int) -> bool:
        pair, left, right = self.pair, self.left, self.right
        # Merges are undone from the latest on. ``limit``: merges across the
        # border with an id from here on would have come too late.
        limit = 1 << 30
        while True:
            if pair.get((a, b), limit) < limit:
                return False
            a_single, b_single = right[a] == a, left[b] == b
            if a_single and b_single:
                return True
            if not a_single and (b_single or a > b):
                limit, a = a, right[a]
            else:
                limit, b = b + 1, left[b]

    def piece(self, text: str) -> list[int]:
        """Ids of one piece, given as Latin-1 characters."""
        whole = self.whole.get(text)
        if whole is not None:
            return [whole]
        n = len(text)
        size = self.size
        starts: list[list[int]] = [[] for _ in range(n)]
        for end, token in self.automaton.iter(text):
            starts[end + 1 - size[token]].append(token)     # shortest first
        choice = [len(s) for s in starts]
        dead = [False] * (n + 1)
        out: list[int] = []
        at = 0
        while at < n:
            here, k = starts[at], choice[at]
            while k:
                k -= 1
                token = here[k]
                end = at + size[token]
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    choice[at] = k
                    out.append(token)
                    at = end
                    break
            else:
                dead[at] = True
                choice[at] = len(here)
                at -= size[out.pop()]
        return out

    def encode_many(self, pieces: list[str]) -> list[bytes]:
        out = []
        for p in pieces:
            ids: list[int] = []
            for m in self.split(p):
                ids += self.piece(m.encode().decode("latin-1"))
            out.append(np.array(ids, "<u2").tobytes())
        return out

    def encode_batch(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, first id of each row and the total)."""
        return self.encoder.batch(arr)

    def decode_batch(self, ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows, first byte of each row and the total)."""
        return take_runs(self.flat, self.begin, self.length, ids.astype(np.int64), row)


#: The worker's encoder under the digest of its vocabulary and pattern.
_BUILT: dict[str, ByteBpe] = {}


def worker_bpe(vocabulary, digest: str) -> ByteBpe:
    """The worker's encoder for a broadcast vocabulary. A worker outlives the
    query, so the encoder it holds is known by content (``digest`` comes with
    the task), never by the broadcast's identity."""
    bpe = _BUILT.get(digest)
    if bpe is None:
        _BUILT.clear()
        bpe = _BUILT[digest] = ByteBpe(vocabulary.value)
    return bpe


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids of the text (array) and the bytes that they decode to."""
    loaded = load(path, pattern)
    vocabulary, digest = docs.sparkSession.sparkContext.broadcast(loaded), loaded.digest

    def go(batches):
        bpe = worker_bpe(vocabulary, digest)
        for b in chunks(batches, max_bytes=CHUNK_BYTES):
            ids, row = bpe.encode_batch(b.column(1))
            raw, at = bpe.decode_batch(ids, row)
            raw = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0),
                 pa.ListArray.from_arrays(pa.array(row.astype(np.int32)), pa.array(ids.astype(np.int32))),
                 pa.array([raw[s:e] for s, e in zip(at[:-1], at[1:])], pa.binary())],
                names=["doc_id", "ids", "decoded"])

    return _slim(docs).mapInArrow(go, "doc_id long, ids array<int>, decoded binary")


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def digest_query(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    loaded = load(path, pattern)
    vocabulary, digest = docs.sparkSession.sparkContext.broadcast(loaded), loaded.digest

    def go(batches):
        bpe = worker_bpe(vocabulary, digest)
        for b in chunks(batches, max_bytes=CHUNK_BYTES):
            ids, row = bpe.encode_batch(b.column(1))
            raw, at = bpe.decode_batch(ids, row)
            wide = ids.astype("<u4").tobytes()
            raw = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(row)),
                 pa.array([hashlib.sha256(wide[4 * s:4 * e]).hexdigest() for s, e in zip(row[:-1], row[1:])],
                          pa.string()),
                 pa.array([hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(at[:-1], at[1:])],
                          pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _slim(docs).mapInArrow(
        go, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
