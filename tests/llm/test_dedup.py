"""Operators 5, 6 and 8 against brute force, edge cases included."""

import random

import pyarrow as pa
import pytest

from encore.llm import jaccard_join, quality_rules, substring_dedup
from tests.llm import brute


def near_copies(seed=5, groups=14, size=(6, 240)):
    """Groups of texts whose similarities lie around the threshold."""
    r = random.Random(seed)
    rows, n = [], 100
    for _ in range(groups):
        base = [f"t{r.randrange(10**6)}" for _ in range(r.randrange(*size))]
        for _ in range(r.randrange(2, 7)):
            own = list(base)
            for _ in range(r.randrange(0, 1 + len(own) // 30)):
                own[r.randrange(len(own))] = f"u{r.randrange(10**6)}"
            if r.random() < 0.4:
                own = own[r.randrange(0, 1 + len(own) // 8):]
            rows.append((n, " ".join(own)))
            n += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [brute.EDGE, near_copies()], ids=["edge", "near"])
def test_jaccard_join(spark, rows):
    got = brute.rows_of(jaccard_join.join_query(brute.edge_docs(spark, rows)),
                        "doc_id", "n_shingles", "component_id")
    assert got == brute.ordered(brute.jaccard(rows))


def test_small_sets_at_every_size(spark):
    rows, n = [], 1
    for size in range(5, 20):
        own = [f"s{size}_{k}" for k in range(size)]
        for text in (own, own[1:], own[:-1], own[1:-1], own + ["more"], own[2:]):
            rows.append((n, " ".join(text)))
            n += 1
    got = brute.rows_of(jaccard_join.join_query(brute.edge_docs(spark, rows)),
                        "doc_id", "n_shingles", "component_id")
    assert got == brute.ordered(brute.jaccard(rows))


def test_one_of_each_group(spark):
    docs = brute.edge_docs(spark)
    out = jaccard_join.one_of_each_group(docs)
    assert out.columns == docs.columns
    expect = brute.jaccard(brute.EDGE)
    kept = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    groups = {c for d, n, c in expect if n}
    alone = [d for d, n, c in expect if not n]
    assert sorted(set(kept)) == sorted(groups | set(alone))


@pytest.mark.parametrize("rows", [brute.EDGE, near_copies(9, 6, (40, 160))], ids=["edge", "near"])
def test_substring_dedup(spark, rows):
    got = brute.rows_of(substring_dedup.dedup_query(brute.edge_docs(spark, rows)),
                        "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == brute.ordered(brute.dedup(rows))


def test_cover_is_a_difference_cover():
    assert substring_dedup.check_cover()
    assert not substring_dedup.check_cover(31, (1, 5, 11))


def test_remove_repeats_changes_texts(spark):
    rows = [(1, brute.PASSAGE + " own first"), (2, "head  here " + brute.PASSAGE + " tail"),
            (3, brute.PASSAGE), (4, "untouched  text"), (5, None), (6, "")]
    docs = brute.edge_docs(spark, rows)
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: brute.PASSAGE + " own first", 2: "head here tail", 4: "untouched  text", 5: None, 6: ""}


def test_quality_rules(spark):
    docs = brute.edge_docs(spark)
    got = brute.rows_of(quality_rules.quality_rows(docs), "doc_id", "n_words", "word_chars", "n_symbols",
                        "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert got == brute.ordered([(i, *brute.quality(t)) for i, t in brute.EDGE])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert brute.rows_of(kept, "doc_id") == brute.ordered([(i,) for i, t in brute.EDGE if brute.quality(t)[-1]])


def test_repeats_of_random_texts():
    r = random.Random(2)
    texts = [" ".join(r.choice("ab" if k % 2 else "abcdefgh") for _ in range(r.randrange(0, 90))) for k in range(60)]
    block = " ".join(f"v{k}" for k in range(120))
    texts += [block + " mid " + block, block + " " + block[:300], "x " + " ".join(f"y{k}" for k in range(300))]
    found = quality_rules.judge(pa.array(texts))
    keys = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert [tuple(found[k][i].item() for k in keys) for i in range(len(texts))] == [brute.quality(t) for t in texts]


@pytest.mark.parametrize("run", [
    jaccard_join.join_query, jaccard_join.one_of_each_group, substring_dedup.dedup_query,
    substring_dedup.remove_repeats, quality_rules.quality_rows, quality_rules.keep_good])
def test_empty_table(spark, run):
    assert run(brute.edge_docs(spark).limit(0)).count() == 0


def test_stages_keep_columns_of_any_name(spark):
    """Columns called as the operators call their own come back unchanged."""
    names = ["h1", "h2", "node", "_id", "_first", "_gone", "_kept", "_words", "doc", "first_id", "root", "x.y"]
    rows = [(1, brute.PASSAGE + " own first"), (2, "head  here " + brute.PASSAGE + " tail"), (4, "untouched  text"),
            (5, None), (6, ""), (7, brute.BASE), (8, brute.BASE), (None, "a text without an id")]
    docs = spark.createDataFrame([(i, t, *(f"{c}-{k}" for c in names)) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    held = {r[0]: tuple(r) for r in docs.collect()}
    out = jaccard_join.one_of_each_group(docs)
    assert out.columns == docs.columns
    assert {r[0]: tuple(r) for r in out.collect()} == {i: v for i, v in held.items() if i not in (2, 8)}
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r[0]: tuple(r) for r in out.collect()}
    assert set(got) == {1, 2, 4, 5, 6, 7, None} and got[2][1] == "head here tail"
    assert all(v[2:] == held[i][2:] and (i == 2 or v[1] == held[i][1]) for i, v in got.items())
