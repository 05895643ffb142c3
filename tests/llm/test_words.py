"""Words, hashes and components against plain versions."""

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from encore.llm.common import components, sketch
from encore.llm.words import Words, chunks
from tests.llm import brute

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab A\t\n\r\x0bé漢 ", max_size=30)), max_size=12)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_words_of_a_batch(texts):
    arr = pa.array(texts, pa.string())
    w = Words(arr)
    raw = w.raw.tobytes()
    got = [[raw[w.start[k]:w.end[k]].decode() for k in range(w.row[i], w.row[i + 1])] for i in range(len(texts))]
    assert got == [brute.words(t) for t in texts]
    flat = [x for t in texts for x in brute.words(t)]
    assert len({*zip(flat, w.hash.tolist())}) == len({*flat}) == len({*w.hash.tolist()})
    for size in (1, 2, 3):
        runs, fits = w.runs(size), w.fits(size)
        named = {}
        for i, t in enumerate(texts):
            own = brute.words(t)
            for k in range(len(own)):
                at = w.row[i] + k
                assert fits[at] == (k + size <= len(own))
                if fits[at]:
                    assert named.setdefault(tuple(own[k:k + size]), runs[at]) == runs[at]
        assert len({*named.values()}) == len(named)
    lower = Words(arr, lower=True)
    low = [x.translate(brute.LOWER) for x in flat]
    assert len({*zip(low, lower.hash.tolist())}) == len({*low})


def test_chunks_cover_all_rows_and_bound_their_size():
    texts = ["x" * n for n in (0, 5, 100, 3, 3, 3, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(chunks([batch, batch.slice(0, 0)], max_bytes=10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(8))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 10 for p in parts)


def test_components_match_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(1001, 1080)]
    edges += [(k, k + 1) for k in range(2000, 2040)] + [(5, 5)]
    u = brute.Union()
    for a, b in edges:
        u.join(a, b)
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(v, v) == u.find(v) for e in edges for v in e)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_has_every_hash(spark):
    r = np.random.default_rng(1)
    h = r.integers(-2**63, 2**63 - 1, 500)
    flags = sketch(spark.createDataFrame([(int(x),) for x in h], "h long"), "h")
    assert flags[h & (len(flags) - 1)].all() and flags.sum() <= 500
