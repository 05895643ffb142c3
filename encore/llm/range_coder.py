"""Token-id files with an adaptive context-mixing range coder (operator 1).

File format (a shard; one or more per partition, ids in ascending doc_id
order):

    magic "TIDS1\\0", then little-endian unsigned 32-bit: rows, blocks, ids,
    bytes of the row table, bytes of the prior, crc32 of both tables;
    the row table (zlib): doc_id differences and id counts, 64-bit each;
    the prior (zlib): order-0 frequency of each id, 32-bit;
    per block: id count, byte count, crc32 of its ids (32-bit each);
    the blocks' bytes.

Method. A block of ``BLOCK`` ids is coded alone: its model starts empty and
its checksum covers its ids, so a damaged block harms no other one. Each id
is predicted three times: by the last id that followed the two ids before it
(order 2), by the last id that followed the previous one (order 1), and by the
shard's id frequencies (order 0). The coder mixes these into one distribution:
weights of the two predicted ids against the order-0 distribution, counted
adaptively for each state of confidence (past hits of the order-2 and order-1
contexts, and whether both predict the same id). The interval of the mixture
that holds the id goes into a carry-free 64-bit range coder that emits 32 bits
at a time.

All blocks of a shard advance together, one id a step, as numpy lanes, both
ways; that is what makes the coder fast enough without native code. A shard
holds at most ``SHARD`` ids, which bounds memory.

Defined results: null text is empty and has the end id alone; rows are
ordered by doc_id, null first, rows of equal id by their text; other columns
are ignored. An empty table gives an empty result and no file.
"""

from __future__ import annotations

import os
import struct
import urllib.parse
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import stored
from encore.llm.packing import END_ID, with_ends
from encore.llm.pieces import Encoder, Texts, word_pieces
from encore.llm.words import chunks, text_bytes
from encore.session import scratch_path

MAGIC = b"TIDS1\0"
BLOCK = 1024
SHARD = 1 << 23
CHUNK_BYTES = 2 << 20          # text tokenized at once
_SLOTS = 512                   # of each context table of a block
_MIX_BITS = 16                 # of the shares of the three predictions
_LEAST = 1 << 12               # least share of order 0
_PRIOR_BITS = 20               # of the order-0 frequencies
_STATES = 32
_EPOCH = 64                    # ids between two updates of the shares
_U = np.uint64
_LOW32 = _U((1 << 32) - 1)


class _Model:
    """Context tables and mixing weights of all lanes. A table entry holds the
    predicted id in its low 16 bits and the context's recent hits (0 to 3)
    above them."""

    def __init__(self, lanes: int):
        self.lanes = lanes
        self.at = np.arange(lanes) * _SLOTS
        self.table1 = np.zeros(lanes * _SLOTS, np.uint32)
        self.table2 = np.zeros(lanes * _SLOTS, np.uint32)
        self.row = np.arange(lanes) * _STATES
        # Counts of order-2 hits, order-1 hits and neither, for each state.
        state = np.arange(_STATES)
        self.n = np.empty((3, lanes * _STATES))
        self.n[0] = np.tile(1 + 4 * (state & 3) ** 2, lanes)
        self.n[1] = np.tile(1 + 2 * (state >> 2 & 3) ** 2, lanes)
        self.n[2] = 8
        self.seen = np.empty((_EPOCH, lanes), np.int64)
        self.step = 0
        self.shares()
        self.last = np.zeros(lanes, np.int64)
        self.before = np.zeros(lanes, np.int64)

    def shares(self) -> None:
        """Upper ends of the order-2 and order-1 intervals of each state."""
        room = ((1 << _MIX_BITS) - _LEAST - 2) / self.n.sum(axis=0)
        f2 = (self.n[0] * room).astype(np.int64) + 1
        f1 = (self.n[1] * room).astype(np.int64) + 1
        self.end2 = f2.astype(np.uint64)
        self.end1 = (f2 + f1).astype(np.uint64)

    def predict(self, a: int) -> None:
        """Predictions and interval ends of the first ``a`` lanes."""
        h = self.last[:a] * 40503
        self.c1 = (h >> 4 & (_SLOTS - 1)) + self.at[:a]
        self.c2 = (h + self.before[:a] * 2654435761 >> 9 & (_SLOTS - 1)) + self.at[:a]
        e1, e2 = self.table1[self.c1], self.table2[self.c2]
        self.p1, self.p2 = e1 & 0xFFFF, e2 & 0xFFFF
        self.h1, self.h2 = e1 >> 16, e2 >> 16
        self.s = (self.h2 + 4 * self.h1 + 16 * (self.p1 == self.p2)) + self.row[:a]
        self.top2, self.top1 = self.end2[self.s], self.end1[self.s]

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Take in the coded ids (32-bit) and which predictions were right."""
        a = len(ids)
        self.table2[self.c2] = ids | (np.minimum(self.h2 + 1, 3) * hit2) << 16
        self.table1[self.c1] = ids | (np.minimum(self.h1 + 1, 3) * hit1) << 16
        self.before[:a] = self.last[:a]
        self.last[:a] = ids
        kind = np.where(hit2, 0, np.where(hit1, 1, 2))
        line = self.seen[self.step % _EPOCH]
        line[:a] = kind * (self.lanes * _STATES) + self.s
        line[a:] = -1
        self.step += 1
        if self.step % _EPOCH == 0:
            flat = self.seen.ravel()
            add = np.bincount(flat[flat >= 0], minlength=self.n.size).reshape(self.n.shape)
            self.n *= 0.98
            self.n += add
            self.shares()


def prior(ids: np.ndarray, size: int) -> np.ndarray:
    """Order-0 frequencies of a shard, at least 1 for each id that occurs,
    with sum 1 << _PRIOR_BITS."""
    n = np.bincount(ids, minlength=size).astype(np.int64)
    total = 1 << _PRIOR_BITS
    f = np.where(n > 0, np.maximum(1, n * (total - size) // max(1, n.sum())), 0)
    f[np.argmax(f)] += total - f.sum()
    return f


def _lanes(ids: int) -> np.ndarray:
    """Id count of each block: all full but the last."""
    n = -(-ids // BLOCK)
    size = np.full(n, BLOCK)
    if n:
        size[-1] = ids - (n - 1) * BLOCK
    return size


def _narrow(low, reach, emit) -> None:
    """Emit 32 bits of every lane whose interval has become short. An interval
    that spans two values of the upper 32 bits is cut at the border first, so
    no carry ever happens."""
    lane = np.flatnonzero(reach <= _LOW32)
    if len(lane):
        l, r = low[lane], reach[lane]
        r = np.where((l ^ (l + r)) > _LOW32, (~l + _U(1)) & _LOW32, r)
        emit(lane, l >> _U(32))
        low[lane] = l << _U(32)
        reach[lane] = r << _U(32)


def encode_blocks(ids: np.ndarray, freq: np.ndarray) -> list[bytes]:
    """The bytes of each block of ``ids``."""
    size = _lanes(len(ids))
    lanes = len(size)
    if not lanes:
        return []
    freq_u = freq.astype(np.uint64)
    start_u = np.cumsum(freq_u) - freq_u
    grid = np.zeros(lanes * BLOCK, np.uint32)
    grid[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)
    low, reach = np.zeros(lanes, np.uint64), np.full(lanes, ~_U(0))
    out = np.empty((lanes, BLOCK + 64), np.uint32)
    used = np.zeros(lanes, np.int64)
    model = _Model(lanes)
    one = _U(1 << _MIX_BITS)

    def emit(lane, word):
        out[lane, used[lane]] = word
        used[lane] += 1

    for t in range(int(size[0])):
        a = lanes if t < size[-1] else lanes - 1
        x = grid[t, :a]
        model.predict(a)
        hit2, hit1 = x == model.p2, x == model.p1
        l, r = low[:a], reach[:a]
        r >>= _U(_MIX_BITS)
        first = np.where(hit2, _U(0), np.where(hit1, model.top2, model.top1))
        l += r * first
        r *= np.where(hit2, model.top2, np.where(hit1, model.top1, one)) - first
        miss = np.flatnonzero(~(hit2 | hit1))
        y = x[miss]
        part = r[miss] >> _U(_PRIOR_BITS)
        l[miss] += part * start_u[y]
        r[miss] = part * freq_u[y]
        _narrow(l, r, emit)
        model.learn(x, hit2, hit1)
    for _ in range(2):
        emit(np.arange(lanes), low >> _U(32))
        low <<= _U(32)
    return [out[i, :used[i]].astype("<u4").tobytes() for i in range(lanes)]


def decode_blocks(blocks: list[bytes], total: int, freq: np.ndarray) -> np.ndarray:
    """The ids of all blocks of a shard."""
    size = _lanes(total)
    lanes = len(size)
    if not lanes:
        return np.zeros(0, np.uint32)
    freq_u = freq.astype(np.uint64)
    start_u = np.cumsum(freq_u) - freq_u
    at_share = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)   # 1 << _PRIOR_BITS entries
    length = np.array([len(b) // 4 for b in blocks])
    pad = 4
    data = np.zeros(int(length.sum()) + pad * lanes, np.uint64)
    at = np.r_[0, np.cumsum(length + pad)][:-1]
    for b, k in zip(blocks, at):
        data[k:k + len(b) // 4] = np.frombuffer(b, "<u4")
    low, reach = np.zeros(lanes, np.uint64), np.full(lanes, ~_U(0))
    code = data[at] << _U(32) | data[at + 1]
    at = at + 2
    model = _Model(lanes)
    grid = np.zeros((BLOCK, lanes), np.uint32)
    one = _U(1 << _MIX_BITS)
    most = _U((1 << _PRIOR_BITS) - 1)

    def shift(lane, _word):
        code[lane] = code[lane] << _U(32) | data[at[lane]]
        at[lane] += 1

    for t in range(int(size[0])):
        a = lanes if t < size[-1] else lanes - 1
        model.predict(a)
        l, r = low[:a], reach[:a]
        r >>= _U(_MIX_BITS)
        v = code[:a] - l
        in2 = v < r * model.top2
        in1 = ~in2 & (v < r * model.top1)
        first = np.where(in2, _U(0), np.where(in1, model.top2, model.top1))
        x = np.where(in2, model.p2, model.p1)
        miss = np.flatnonzero(~(in2 | in1))
        l += r * first
        r *= np.where(in2, model.top2, np.where(in1, model.top1, one)) - first
        part = r[miss] >> _U(_PRIOR_BITS)
        y = at_share[np.minimum((code[miss] - l[miss]) // part, most).astype(np.int64)]
        x[miss] = y
        l[miss] += part * start_u[y]
        r[miss] = part * freq_u[y]
        _narrow(l, r, shift)
        model.learn(x, in2, x == model.p1)
        grid[t, :a] = x
    return grid.T.reshape(-1)[:total]


def write_shard(doc_id: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A whole file for the rows; ``ids`` holds all their ids."""
    size = int(ids.max()) + 1 if len(ids) else 1
    freq = prior(ids, size)
    rows = zlib.compress(np.r_[np.diff(doc_id, prepend=0), counts].astype("<i8").tobytes(), 1)
    first = zlib.compress(freq.astype("<u4").tobytes(), 1)
    blocks = encode_blocks(ids, freq)
    parts = [ids[k:k + BLOCK].astype("<u4").tobytes() for k in range(0, len(ids), BLOCK)]
    heads = b"".join(struct.pack("<3I", len(p) // 4, len(b), zlib.crc32(p))
                     for p, b in zip(parts, blocks))
    head = struct.pack("<6I", len(doc_id), len(blocks), len(ids), len(rows), len(first),
                       zlib.crc32(first, zlib.crc32(rows)))
    return b"".join([MAGIC, head, rows, first, heads, *blocks])


def read_shard(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, id counts, ids) of a file; a wrong checksum raises."""
    if raw[:6] != MAGIC:
        raise ValueError("not a token-id file")
    n, k, total, a, b, crc = struct.unpack_from("<6I", raw, 6)
    at = 30
    rows, first = raw[at:at + a], raw[at + a:at + a + b]
    if zlib.crc32(first, zlib.crc32(rows)) != crc:
        raise ValueError("damaged tables")
    table = np.frombuffer(zlib.decompress(rows), "<i8")
    freq = np.frombuffer(zlib.decompress(first), "<u4").astype(np.int64)
    at += a + b
    heads = np.frombuffer(raw, "<u4", 3 * k, at).reshape(k, 3)
    cut = at + 12 * k + np.r_[0, np.cumsum(heads[:, 1], dtype=np.int64)]
    ids = decode_blocks([raw[s:e] for s, e in zip(cut[:-1], cut[1:])], total, freq)
    wide = ids.astype("<u4")
    for i in range(k):
        if zlib.crc32(wide[i * BLOCK:(i + 1) * BLOCK].tobytes()) != heads[i, 2]:
            raise ValueError(f"block {i} is damaged")
    return np.cumsum(table[:n]), table[n:], ids


_BUILT: dict[str, Texts] = {}


def lower_word_pieces(arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words with A-Z lower-cased, as the vocabulary does: fewer are distinct.
    Texts that may name a special token, which has case, stay as they are."""
    arr = arr.cast(pa.string()).fill_null("")
    return word_pieces(pc.if_else(pc.match_substring(arr, "<|"), arr, pc.ascii_lower(arr)))


#: White space, ASCII and the Latin letters whose small form is one letter.
PLAIN = r"\A[\x09-\x0D\x20-\x7EÀ-ÖØ-öø-įĲ-ňŊ-ɏ]*\z"
_NONE = r"\A\x00"               # matches no plain text
_STOP = b"\x01"                # closes a part; plain texts lack it
_GAP, _MARK, _DIGIT, _LETTER = range(4)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _GAP
_KIND[48:58] = _DIGIT
_KIND[97:123] = _LETTER
_KIND[128:] = _LETTER          # all bytes of the other letters


def closed_parts(arr: pa.Array) -> pa.Array:
    """Plain texts in lower case with a mark after each part that the
    vocabulary's pattern finds: one of 's 't 'm 'd 're 've 'll, where no mark
    is before it, or else a run of letters, a digit, or a run of marks."""
    raw, off = text_bytes(pc.utf8_lower(arr))
    n = len(raw)
    if not n:
        return arr
    kind = np.zeros(n + 2, np.uint8)           # a gap around everything
    kind[1:-1] = _KIND[raw]
    kind, after, before = kind[1:-1], kind[2:].copy(), kind[:-2].copy()
    edge = off[1:-1]
    after[edge[edge > 0] - 1] = before[edge[edge < n]] = _GAP
    close = (kind == _DIGIT) | (kind > _GAP) & (kind != after)
    quote = np.flatnonzero((raw == 39) & (before != _MARK) & (after == _LETTER))
    one = raw[quote + 1]
    two = raw[np.minimum(quote + 2, n - 1)]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long_ = (after[quote + 1] == _LETTER) & (((two == 101) & ((one == 114) | (one == 118)))
                                             | ((two == 108) & (one == 108)))
    close[quote[short | long_]] = False
    close[quote[short] + 1] = True
    close[quote[long_] + 2] = True
    moved = np.r_[0, np.cumsum(close)]
    out = np.full(n + moved[-1], _STOP[0], np.uint8)
    out[np.arange(n) + moved[:-1]] = raw
    return pa.StringArray.from_buffers(len(arr), pa.py_buffer((off + moved[off]).astype(np.int32)), pa.py_buffer(out))


def rank_form(vocab: dict[str, int], merges: list) -> tuple[dict[bytes, int], np.ndarray]:
    """(token bytes -> rank, id of each rank) of a byte-level vocabulary with
    word ends: a part's last byte first joins the mark after it."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in keep}
    char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in keep)}

    def raw(token):
        end = token.endswith("</w>")
        return bytes(char[c] for c in (token[:-4] if end else token)) + (_STOP if end else b"")

    names = [*char, *(c + "</w>" for c in char), *(a + b for a, b in merges)]
    ranks = {bytes([b]): b for b in range(256)}
    ids = np.zeros(256 + len(names), np.uint32)
    for c, b in char.items():
        ids[b] = vocab.get(c, 0)
    for rank, name in enumerate(names[len(char):], 256):
        ranks[raw(name)], ids[rank] = rank, vocab[name]
    return ranks, ids[:256 + len(names) - len(char)]


def word_encoder(json_path: str) -> Texts:
    """The worker's encoder for the lower-casing vocabulary with word ends.

    Plain texts are lower-cased and split by the vocabulary's pattern here, and
    the rank form of the vocabulary merges the parts of a whole text in one
    call. All other texts go to the tokenizer word by word; it is loaded when
    the first one comes.
    """
    if json_path not in _BUILT:
        import json

        import tiktoken

        with open(json_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ranks, ids = rank_form(model["vocab"], model["merges"])
        del model
        merge = tiktoken.Encoding("words", pat_str=r"[^\x09-\x0D\x20\x01]+\x01", mergeable_ranks=ranks,
                                  special_tokens={}).encode_ordinary

        def pieces():
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(json_path)

            def many(words):
                # In parts, since the results of a call are much larger than the ids.
                return [np.array(e.ids, "<u2").tobytes() for i in range(0, len(words), 4096)
                        for e in tok.encode_batch_fast(words[i:i + 4096], add_special_tokens=False)]

            return Encoder(many, lower_word_pieces)

        _BUILT.clear()
        _BUILT[json_path] = Texts(PLAIN, _NONE, lambda t: ids[merge(t)], pieces, closed_parts)
    return _BUILT[json_path]


def _put(target: str, data: bytes) -> None:
    """Write a file of the shared folder in one step (a retried task writes
    the same bytes to the same name)."""
    parsed = urllib.parse.urlparse(target)
    if parsed.scheme in ("", "file"):
        path = parsed.path
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
    else:
        fs, path = pafs.FileSystem.from_uri(target)
        with fs.open_output_stream(path + ".part") as f:
            f.write(data)
        fs.move(path + ".part", path)


def write_files(docs: DataFrame, json_path: str, folder: str, partitions: int | None = None) -> DataFrame:
    """Encode and write all documents; one row per file (partition, number in
    it, name, rows, ids), stored. ``folder`` must exist."""
    spark = docs.sparkSession
    from pyspark import TaskContext

    def go(batches):
        encoder = word_encoder(json_path)
        part = TaskContext.get().partitionId()
        number = 0
        held: list = []

        def flush():
            nonlocal number, held
            doc_id = np.concatenate([h[0] for h in held])
            counts = np.concatenate([h[1] for h in held])
            ids = np.concatenate([h[2] for h in held])
            held = []
            name = f"part-{part:05d}-{number:05d}.tids"
            _put(f"{folder}/{name}", write_shard(doc_id, counts, ids))
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number - 1], pa.int32()), pa.array([name]),
                 pa.array([len(doc_id)], pa.int64()), pa.array([len(ids)], pa.int64())],
                names=["part", "number", "name", "rows", "ids"])

        total = 0
        for b in chunks(batches, max_bytes=CHUNK_BYTES):
            ids, row = with_ends(*encoder.batch(b.column(1)), END_ID)
            doc_id = b.column(0).fill_null(NO_ID).to_numpy()
            held.append((doc_id, np.diff(row), ids.astype(np.uint16)))
            total += len(ids)
            if total >= SHARD:
                yield flush()
                total = 0
        if held:
            yield flush()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = slim.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(go, "part int, number int, name string, rows long, ids long"),
                  "op1-files")


#: A null doc_id in a file.
NO_ID = -(1 << 63)


def read_rows(spark: SparkSession, folder: str) -> DataFrame:
    """name, position in the file, doc_id, first id within the file, id count
    and ids (bytes, 32-bit little-endian) of every row of the files."""

    def go(batches):
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1)):
                doc_id, counts, ids = read_shard(raw.as_buffer().to_pybytes())
                wide = ids.astype("<u4").tobytes()
                ends = np.cumsum(counts)
                for i in range(0, len(doc_id), 4096):
                    k = slice(i, i + 4096)
                    own = doc_id[k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(own)), pa.array(np.arange(i, i + len(own))),
                         pa.array(own, mask=own == NO_ID), pa.array((ends - counts)[k]),
                         pa.array(counts[k]),
                         pa.array([wide[4 * (e - c):4 * e] for e, c in zip(ends[k], counts[k])], pa.binary())],
                        names=["name", "at", "doc_id", "first", "n_tokens", "ids"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tids").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInArrow(
        go, "name string, at long, doc_id long, first long, n_tokens long, ids binary")


def files_query(docs: DataFrame, json_path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "op1-tids")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    files = write_files(docs, json_path, folder)
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    # One row per file of up to SHARD ids: its ids start after all earlier files.
    begun = sorted((r["part"], r["number"], r["name"], r["ids"]) for r in files.collect())
    starts, total = [], 0
    for _, _, name, n in begun:
        starts.append((name, total))
        total += n
    starts = spark.createDataFrame(starts, "name string, before long")
    return read_rows(spark, folder).join(F.broadcast(starts), "name").select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens",
        F.crc32("ids").alias("ids_crc32"))
