"""Operator 13: exact round trips, and outputs against slicing."""

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from encore.llm import fill_in_middle as M
from tests.llm import brute

ODD = brute.EDGE + [(31, "a<P>b\nc"), (32, "\n"), (33, "\n\n\nx"), (34, "no newline"), (35, "ends\n"), (36, "<S>"),
                    (37, "x <M> y"), (38, "<" * 7 + "P\n>S<P\n<M"), (39, "é\n漢\r\n\U0001f600"), (40, "one\ntwo\nthree")]


def sliced(doc_id, text, seed=7, rate=100, spm=50, unit=r"[^\n]*\n|[^\n]+"):
    """(n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    u = re.findall(unit, text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(u), "plain", None, None, text
    low, high = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:low]), "".join(u[low:high]), "".join(u[high:])
    if h[3] % 100 < spm:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digest_query(spark):
    out = M.digest_query(brute.edge_docs(spark, ODD))
    expect = [(i, *sliced(i, t)[:4], sha(sliced(i, t)[4]), sha(t or "")) for i, t in ODD]
    assert brute.rows_of(out, *out.columns) == brute.ordered(expect)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert set(Counter(r[2] for r in expect)) == {"plain", "spm", "psm"}


@pytest.mark.parametrize("plan,unit", [(M.Plan(11, 60, 20), r"[^\n]*\n|[^\n]+"), (M.Plan(3, unit="char"), r"(?s:.)")])
def test_other_plans(spark, plan, unit):
    out = M.restore(M.transform(brute.edge_docs(spark, ODD), plan), plan)
    expect = [(i, *sliced(i, t, plan.seed, plan.rate, plan.spm, unit), t or "") for i, t in ODD]
    assert brute.rows_of(out, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored") == \
        brute.ordered(expect)


def test_empty_table(spark):
    assert M.digest_query(brute.edge_docs(spark, [])).collect() == []


@given(st.binary(max_size=60), st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]))
def test_rebuild_inverts_arrange(raw, a, b, form):
    plan = M.Plan()
    if any(m in raw for m in (plan.prefix, plan.suffix, plan.middle)):
        return
    low, high = sorted((min(a, len(raw)), min(b, len(raw))))
    p, m, s = raw[:low], raw[low:high], raw[high:]
    out = M.arrange(raw, low, high, form, plan)
    assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    assert M.rebuild(out, form, plan) == raw


@given(st.binary(min_size=1, max_size=40), st.integers(0, 40), st.integers(0, 40))
def test_rotate_exchanges_blocks(raw, a, b):
    begin, border = sorted((min(a, len(raw)), min(b, len(raw))))
    buffer = bytearray(raw)
    M.rotate(buffer, begin, border)
    assert bytes(buffer) == raw[:begin] + raw[border:] + raw[begin:border]


def test_sentinels_that_can_overlap_are_refused():
    for marks in ((b"<P>", b"<P>", b"<M>"), (b"", b"<S>", b"<M>"), (b"aba", b"bab", b"c"), (b"<P>", b"<P>x", b"<M>"),
                  (b"aa", b"<S>", b"<M>")):
        with pytest.raises(ValueError):
            M.Plan(prefix=marks[0], suffix=marks[1], middle=marks[2]).check()
    assert M.Plan(prefix=b"<|pre|>", suffix=b"<|suf|>", middle=b"<|mid|>").check()
