"""Operators 1, 3 and 9 against the tokenizer libraries."""

import gc
import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from encore.llm import byte_bpe, packing, range_coder
from tests.llm import brute

RANKS, JSON, WORDS = (P.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
TEXT = st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab thE\n\t'sé漢1.#"), st.characters(codec="utf-8")),
                        max_size=40), max_size=10)


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(byte_bpe.load(RANKS, P.PATTERN))


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS),
                             special_tokens={})


@settings(max_examples=120, deadline=None)
@given(TEXT)
def test_byte_bpe_equals_tiktoken(bpe, plain, texts):
    ids, row = bpe.encode_batch(pa.array(texts, pa.string()))
    raw, at = bpe.decode_batch(ids, row)
    for i, t in enumerate(texts):
        assert ids[row[i]:row[i + 1]].tolist() == plain.encode_ordinary(t)
        assert raw[at[i]:at[i + 1]].tobytes() == t.encode()


def test_byte_bpe_long_pieces(bpe, plain):
    r = random.Random(4)
    texts = ["a" * 4000, "ab" * 2500, "".join(r.choice("aeiourst") for _ in range(6000)), " " * 999 + "x"]
    ids, row = bpe.encode_batch(pa.array(texts))
    assert [ids[row[i]:row[i + 1]].tolist() for i in range(4)] == [plain.encode_ordinary(t) for t in texts]


def test_other_vocabulary(spark):
    ranks = byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("m", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(1, "größere Häuser, l'été à Séville — 漢字"), (2, None)]
    out = byte_bpe.encode(brute.edge_docs(spark, rows), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in out.collect()}
    assert got == {i: (other.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows}


def test_vocabularies_take_turns(spark):
    """Reused Python workers meet two vocabularies again and again."""
    rows = [(i, f"größere Häuser {i}, l'été à Séville, the thing") for i in range(24)]
    docs = brute.edge_docs(spark, rows).select("doc_id", "text").cache()
    other = P.path("byte_bpe_multi_50k.tiktoken")
    expect = {}
    for path in (RANKS, other):
        ranks = byte_bpe.read_ranks(path)
        one = tiktoken.Encoding("v", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        expect[path] = {i: one.encode_ordinary(t) for i, t in rows}
    for turn in range(20):
        path = (RANKS, other)[turn % 2]
        got = {r.doc_id: r.ids for r in byte_bpe.encode(docs, path, P.PATTERN).collect()}
        assert got == expect[path]
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def test_byte_bpe_query(spark, plain):
    got = brute.rows_of(byte_bpe.digest_query(brute.edge_docs(spark), RANKS, P.PATTERN),
                        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    expect = []
    for i, t in brute.EDGE:
        ids = plain.encode_ordinary(t or "")
        expect.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == brute.ordered(expect)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_word_ids_equal_the_tokenizer(texts):
    tok = Tokenizer.from_file(WORDS)
    ids, row = range_coder.word_encoder(WORDS).batch(pa.array(texts, pa.string()))
    assert [ids[row[i]:row[i + 1]].tolist() for i in range(len(texts))] == \
        [tok.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 49407), max_size=400), st.integers(1, 6), st.integers(1, 30))
def test_file_round_trip(ids, repeat, cut):
    ids = np.array(ids * repeat, np.int64)
    counts = np.diff(np.r_[0, np.sort(np.minimum(np.arange(3) * cut, len(ids))), len(ids)])
    doc_id = np.array([-5, 0, 7, 1 << 40])
    a, b, c = range_coder.read_shard(range_coder.write_shard(doc_id, counts, ids))
    assert (a == doc_id).all() and (b == counts).all() and (c == ids).all()


def test_blocks_are_independent_and_checked():
    r = np.random.default_rng(1)
    ids = r.zipf(1.3, 5 * range_coder.BLOCK + 77) % 49408
    raw = range_coder.write_shard(np.array([1]), np.array([len(ids)]), ids)
    assert (range_coder.read_shard(raw)[2] == ids).all()
    assert len(raw) < 2 * len(ids)
    freq = range_coder.prior(ids, int(ids.max()) + 1)
    blocks = range_coder.encode_blocks(ids, freq)
    # A block alone has the same bytes as among others.
    part = ids[range_coder.BLOCK:2 * range_coder.BLOCK]
    assert range_coder.encode_blocks(part, freq)[0] == blocks[1]
    broken = bytearray(raw)
    broken[-20] ^= 1           # the last block has some 90 bytes
    with pytest.raises(ValueError, match="block 5 is damaged"):
        range_coder.read_shard(bytes(broken))
    with pytest.raises(ValueError):
        range_coder.read_shard(b"other file")


def test_constant_and_predictable_ids_compress():
    ids = np.tile(np.arange(40), 2000)
    raw = range_coder.write_shard(np.array([1]), np.array([len(ids)]), ids)
    assert (range_coder.read_shard(raw)[2] == ids).all() and len(raw) < len(ids) / 4


def test_files_query(spark):
    docs = brute.edge_docs(spark)
    tok = Tokenizer.from_file(WORDS)
    got = brute.rows_of(range_coder.files_query(docs, WORDS), "doc_id", "start", "n_tokens", "ids_crc32")
    expect, at = [], 0
    for i, t in sorted(brute.EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        expect.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == brute.ordered(expect)
    assert range_coder.files_query(docs.limit(0), WORDS).count() == 0


def test_listed_merges_are_what_the_ranks_give():
    """Each token's listed pair is what the merges before it leave of it, so
    the rank forms give the ids of the tokenizers."""
    def ranks_of(path):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if path == WORDS:
            return model, *range_coder.rank_form(model["vocab"], model["merges"])
        ranks = byte_bpe.read_ranks(RANKS)
        return model, ranks, np.arange(max(ranks.values()) + 1)

    for path in (JSON, WORDS):
        model, ranks, ids = ranks_of(path)
        merged = sorted(ranks, key=ranks.get)[-len(model["merges"]):]
        for token, pair in zip(merged, model["merges"], strict=True):
            left = byte_bpe._merge_all(token, ranks, ranks[token])
            assert [ids[ranks[x]] for x in left] == [model["vocab"][x] for x in pair]


LATIN = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xC0, 0x250)] if c not in (0xD7, 0xF7)]
ODD = ["".join(LATIN), " ".join(LATIN), "  ".join(LATIN), "'tis don't we''ll ''t 'RE 're-'s'S a'tb 12'd3 x'",
       "".join(c + "'t" for c in LATIN), " \n a\x0b b  \n\nc '", "", "'", "'l", "漢字 été"]


@pytest.mark.parametrize("module", [packing, range_coder])
def test_latin_texts_need_no_pieces(module):
    """Whole texts of ASCII and Latin letters never reach the slower tokenizer."""
    module._BUILT.clear()
    encoder = packing.text_encoder(JSON, RANKS, P.PATTERN) if module is packing else range_coder.word_encoder(WORDS)
    tok = Tokenizer.from_file(JSON if module is packing else WORDS)
    plain = [t for t in ODD if t.isascii()] + ["été à Séville", "Größe ÑANDÚ"]
    for texts in (plain, ODD, ["<|endoftext|>", "a <|endoftext|> B"]):
        ids, row = encoder.batch(pa.array(texts))
        assert [ids[row[i]:row[i + 1]].tolist() for i in range(len(texts))] == \
            [tok.encode(t, add_special_tokens=False).ids for t in texts]
        assert texts is not plain or encoder.other is None


def test_parts_are_those_of_the_pattern():
    find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
    r = random.Random(8)
    texts = ["".join(r.choice("'''stmdrevlaé1-. \n") for _ in range(r.randrange(30))) for _ in range(4000)]
    got = range_coder.closed_parts(pa.array(texts)).to_pylist()
    assert [[x.strip() for x in t.split("\x01")[:-1]] for t in got] == [find(t) for t in texts]
    assert [t.replace("\x01", "") for t in got] == texts


def test_very_long_white_space():
    """The scanner of the rank form gives up on it, and did before."""
    text = " " * 3_000_000 + "x"
    ids, row = packing.text_encoder(JSON, RANKS, P.PATTERN).batch(pa.array(["a", text]))
    assert ids[row[1]:].tolist() == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


def check_packing(rows, expect, size=1024):
    """rows: (doc_id, piece, start, length, crc, sequence_id, offset)."""
    assert sorted((brute.key(r[0]), *r[1:5]) for r in rows) == sorted((brute.key(r[0]), *r[1:]) for r in expect)
    by = {}
    for r in rows:
        by.setdefault(r[5], []).append((r[6], r[3]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def pieces_of(rows, size=1024):
    tok = Tokenizer.from_file(JSON)
    out = []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        n = -(-len(ids) // size)
        start = 0
        for k in range(n):
            length = len(ids) - (n - 1) * size if k == 0 else size
            out.append((i, k, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            start += length
    return out


def test_pack_query(spark):
    docs = brute.edge_docs(spark)
    out = packing.pack_query(docs, JSON, RANKS, P.PATTERN)
    rows = [tuple(r) for r in out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                                         "offset").collect()]
    expect = pieces_of(brute.EDGE)
    used = check_packing(rows, expect)
    least = -(-sum(r[3] for r in expect) // 1024)
    assert least <= used <= least + 1
    assert packing.pack_query(docs.limit(0), JSON, RANKS, P.PATTERN).count() == 0


def test_groups_are_packed_apart(spark):
    r = random.Random(1)
    rows = [(k, 0, 0, r.randrange(1, 1025), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = [tuple(x) for x in packing.pack(df, group=700).collect()]
    used = check_packing(got, rows)
    assert used <= 1.02 * sum(x[3] for x in rows) / 1024 + 5 + sum(x[3] > 512 for x in rows) * 0.02


@pytest.mark.parametrize("same", [7, None])
def test_pieces_of_one_id_are_dealt_to_many_groups(spark, same):
    rows = [(same, 0, 0, 1 + k % 1000, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = [tuple(x) for x in packing.pack(df, group=300).collect()]
    check_packing(got, rows)
    sizes = Counter(x[5] >> 32 for x in got)
    assert len(sizes) == 10 and max(sizes.values()) < 450


@pytest.mark.parametrize("low,high", [(1, 1023), (300, 420), (100, 260), (250, 515)])
def test_local_search_empties_bins(low, high):
    r = random.Random(low)
    lengths = [r.randrange(low, high) for _ in range(600)]
    first = packing.best_fit(lengths)
    after = packing.local_search([list(b) for b in first])
    assert sorted(x for b in after for x in b) == sorted(lengths)
    assert all(0 < sum(b) <= 1024 for b in after)
    square = lambda bins: sum(sum(b) ** 2 for b in bins)
    assert len(after) <= len(first) and square(after) >= square(first)


def test_local_search_frees_a_bin_that_best_fit_leaves():
    bins = [[600, 300], [500, 400], [130, 110]]
    # 130 and 110 fit the two gaps of 124 only by exchange.
    after = packing.local_search([[600, 310], [500, 414], [110, 114]])
    assert len(after) == 2 and packing.local_search(bins)


@pytest.mark.parametrize("low,high", [(300, 420), (250, 515)])
def test_local_search_ends_without_a_gainful_exchange(low, high):
    r = random.Random(low)
    lengths = [r.randrange(low, high) for _ in range(3000)]
    first = packing.best_fit(lengths)
    after = packing.local_search(first)
    assert sorted(x for b in after for x in b) == sorted(lengths) and len(after) < 0.98 * len(first)
    open_ = [b for b in after if sum(b) < 1024]
    length = np.array([x for b in open_ for x in b])
    where = np.repeat(np.arange(len(open_)), [len(b) for b in open_])
    room = 1024 - np.array([sum(b) for b in open_])
    for k, b in enumerate(open_):
        other = where != k
        assert packing._best_exchange(b, sum(b), length[other], room[where[other]], 1024)[0] == 0


def test_exchange_kinds():
    import numpy as np
    gain, out, back, to = packing._best_exchange([300, 200], 500, np.array([480]), np.array([40]), 1024)
    assert gain > 0 and out == (300, 200) and back == 0     # two for one
    gain, out, back, to = packing._best_exchange([300], 300, np.array([700]), np.array([324]), 1024)
    assert out == (300,) and back == -1                     # move
    gain, out, back, to = packing._best_exchange([300], 300, np.array([700, 290]), np.array([30, 34]), 1024)
    assert out == (300,) and back == 1                      # one for one
