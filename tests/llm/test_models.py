"""Operators 2, 4 and 7: exact parts against brute force, learned parts on
held-out rows."""

import functools
import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from encore.llm import language_id, suffix_tree, toxicity
from encore.llm.common import table
from encore.llm.words import Words
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def crc(i, n):
    return None if i is None else zlib.crc32(str(i).encode()) % n


def base_scores(rows):
    toks = [[x for x in brute.words((t or "").translate(brute.LOWER))] + [None] for _, t in rows]
    c = Counter(x for (i, _), w in zip(rows, toks) if crc(i, 10) not in (None, 0) for x in w)
    n, v = sum(c.values()), len(c)
    return [(i, None if i is None else crc(i, 10) == 0, len(w), sum(c[x] > 0 for x in w), n,
             sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for (i, _), w in zip(rows, toks)]


@pytest.mark.parametrize("frequent", [1 << 20, 3])
def test_base_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
    got = brute.rows_of(suffix_tree.score_query(spark, brute.edge_docs(spark)), "doc_id", "held_out",
                        "n_tokens", "n_known", "train_tokens", "base_score", "score")
    expect = brute.ordered(base_scores(brute.EDGE))
    assert [r[:5] for r in got] == [r[:5] for r in expect]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, expect))
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)


def test_no_training_rows(spark):
    held = next(i for i in range(1000) if crc(i, 10) == 0)
    rows = suffix_tree.score_query(spark, brute.edge_docs(spark, [(held, "a b")])).collect()
    assert rows[0].n_known == 0 and rows[0].train_tokens == 0 and rows[0].base_score == 0.0
    assert math.isclose(rows[0].score, -4 * math.log10(256), rel_tol=1e-6)
    assert suffix_tree.score_query(spark, brute.edge_docs(spark).limit(0)).count() == 0


def test_symbols_of_a_text():
    x, begin = suffix_tree.symbols(Words(pa.array(["Ab  c", None, " \n", "d"]), lower=True))
    own = [x[s:e].tobytes() for s, e in zip(begin[:-1], begin[1:])]
    lead = bytes([suffix_tree.BEFORE] * (suffix_tree.DEPTH - 1) + [32])
    assert own == [lead + b"ab c\n", lead + b"\n", lead + b"\n", lead + b"d\n"]


def test_tree_scores_with_the_longest_suffix():
    r = np.random.default_rng(2)
    counts = Counter()
    texts = ["".join(r.choice(list("ab "), 40)) for _ in range(40)]
    x, begin = suffix_tree.symbols(Words(pa.array(texts), lower=True))
    d = suffix_tree.DEPTH
    for s, e in zip(begin[:-1], begin[1:]):
        for p in range(s + d, e):
            for k in range(0, 3):
                ctx = sum(int(x[p - j]) << (8 * (j - 1)) for j in range(1, k + 1))
                counts[k, ctx, int(x[p])] += 1
    keep = {(k, c) for k, c, _ in counts if k < 2 or c & 255 == ord("a")}
    rows = [(k, c, s, n) for (k, c, s), n in counts.items() if (k, c) in keep]
    tree = suffix_tree.build_tree(*map(np.array, zip(*rows)))
    assert np.allclose((10.0 ** tree.logp.astype(float))[:, tree.column].sum(axis=1), 1, atol=1e-4)

    def p(ctx_len, ctx, sym):
        if ctx_len == 0:
            total = sum(n for (k, c, _), n in counts.items() if k == 0)
            return (counts[0, 0, sym] + 0.1) / (total + 25.6)
        own = {s: n for (k, c, s), n in counts.items() if (k, c) == (ctx_len, ctx)}
        below = p(ctx_len - 1, ctx & ((1 << (8 * (ctx_len - 1))) - 1), sym)
        return (own.get(sym, 0) + suffix_tree.PRIOR * below) / (sum(own.values()) + suffix_tree.PRIOR)

    expect = []
    for s, e in zip(begin[:-1], begin[1:]):
        total = 0.0
        for q in range(s + d, e):
            k = 0
            while k < 2 and (k + 1, sum(int(x[q - j]) << (8 * (j - 1)) for j in range(1, k + 2))) in keep:
                k += 1
            total += math.log10(p(k, sum(int(x[q - j]) << (8 * (j - 1)) for j in range(1, k + 1)), int(x[q])))
        expect.append(total)
    assert np.allclose(tree.score(x, begin), expect, rtol=1e-5)


def test_tree_beats_unigrams_on_held_out_texts(spark):
    rows = suffix_tree.score_query(spark, table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    held = rows[rows.held_out.astype(bool)]
    assert held.score.sum() > held.base_score.sum()


@pytest.mark.parametrize("near,grams", [(10**6, 10**6), (300, 10**6), (10**6, 500), (0, 0)])
def test_contexts_beyond_the_broadcast_tree_score_too(spark, monkeypatch, near, grams):
    monkeypatch.setattr(suffix_tree, "NEAR_GRAMS", grams)
    docs = table(spark, SF, "documents").limit(60)
    whole = brute.rows_of(suffix_tree.score_query(spark, docs), "doc_id", "score")
    monkeypatch.setattr(suffix_tree, "fit_tree", functools.partial(suffix_tree.fit_tree, nodes=40, near=near))
    got = brute.rows_of(suffix_tree.score_query(spark, docs), "doc_id", "score")
    assert [i for i, _ in got] == [i for i, _ in whole]
    assert np.allclose([v for _, v in got], [v for _, v in whole], rtol=1e-5)


def test_six_symbols_back_decide(spark):
    docs = [(i, "axxxxxa" if i % 2 else "bxxxxxb") for i in range(400)]
    rows = suffix_tree.score_query(spark, brute.edge_docs(spark, [*docs, (1000, "axxxxxb"), (1001, "bxxxxxa")]))
    by = {r.doc_id: r.score for r in rows.collect()}
    assert min(by[0], by[1]) > max(by[1000], by[1001]) + 0.5


def plain_scores(rows):
    """Counts, divergence tests and scores by the plain recursion."""
    depth, prior = suffix_tree.DEPTH, suffix_tree.PRIOR
    lead = bytes([suffix_tree.BEFORE] * depth + [suffix_tree.BLANK])
    texts = [lead + " ".join(brute.words((t or "").translate(brute.LOWER))).encode() + b"\n" for _, t in rows]
    counts = {}
    for (i, _), x in zip(rows, texts):
        if crc(i, 10):
            for q in range(depth + 1, len(x)):
                for k in range(depth + 1):
                    counts.setdefault(x[q - k:q], Counter())[x[q]] += 1
    whole = {c: sum(n.values()) for c, n in counts.items()}
    keep = {b""}
    for c, n in counts.items():
        if c and sum(m * math.log(m * whole[c[1:]] / (whole[c] * counts[c[1:]][s])) for s, m in n.items()) \
                >= suffix_tree.FLOOR:
            keep |= {c[k:] for k in range(len(c))}

    @functools.cache
    def p(c, s):
        if not c:
            return (counts[c][s] + suffix_tree.ADD) / (whole[c] + 256 * suffix_tree.ADD)
        return (counts[c][s] + prior * p(c[1:], s)) / (whole[c] + prior)

    def score(x):
        total = 0.0
        for q in range(depth + 1, len(x)):
            k = 0
            while k < depth and x[q - k - 1:q] in keep:
                k += 1
            total += math.log10(p(x[q - k:q], x[q]))
        return total
    return [(i, score(x)) for (i, _), x in zip(rows, texts)]


def some_texts(n, words, vocabulary=150):
    r = np.random.default_rng(11)
    names = ["".join(r.choice(list("aeiounrstlé"), r.integers(1, 9))) for _ in range(vocabulary)]
    return [(i, " ".join(names[j] for j in np.minimum(r.zipf(1.3, words), vocabulary) - 1)) for i in range(n)]


@pytest.mark.parametrize("nodes,near", [(None, None), (40, 30), (1, 0)])
def test_scores_match_the_plain_recursion(spark, monkeypatch, nodes, near):
    rows = [*some_texts(40, 60), (40, None), (41, " A b"), (None, "rare words"), (41, " A b")]
    monkeypatch.setattr(suffix_tree, "fit_tree", functools.partial(suffix_tree.fit_tree, nodes=nodes, near=near))
    got = brute.rows_of(suffix_tree.score_query(spark, brute.edge_docs(spark, rows)), "doc_id", "score")
    expect = brute.ordered(plain_scores(rows))
    assert [i for i, _ in got] == [i for i, _ in expect]
    assert np.allclose([v for _, v in got], [v for _, v in expect], rtol=1e-6)


def test_stored_tables_stay_near_the_size_of_the_texts(spark, monkeypatch):
    """No table has a row for each context symbol of each text."""
    rows = some_texts(200, 400, 20_000)
    sizes = {}

    def stored(df, name, real=suffix_tree.stored):
        out = real(df, name)
        sizes[name] = sum(os.path.getsize(f.split(":", 1)[1]) for f in out.inputFiles())
        return out

    monkeypatch.setattr(suffix_tree, "stored", stored)
    assert suffix_tree.score_query(spark, brute.edge_docs(spark, rows)).count() == 200
    assert sum(sizes.values()) < 2 * sum(len(t.encode()) for _, t in rows), sizes


def test_partial_counts_come_back_from_their_parts():
    key = np.sort(np.random.default_rng(3).integers(0, 1 << 56, 1000))
    n = np.r_[np.arange(1, 301), np.full(699, 1), 5_000_000_000]
    assert np.array_equal(suffix_tree.turned(suffix_tree.turned(key)), key)
    back = [suffix_tree._full(b) for b in suffix_tree._slim(0, key, n, suffix_tree.part_of(key, 7))]
    got = sorted((k, m) for keys, counts in back for k, m in zip(keys.tolist(), counts.tolist()))
    assert got == list(zip(key.tolist(), n.tolist()))


def viterbi(scores, switch):
    """Best total of a path, by the plain recursion."""
    value = list(scores[0])
    for row in scores[1:]:
        top = max(value) - switch
        value = [max(v, top) + s for v, s in zip(value, row)]
    return max(value)


def test_best_path_is_optimal():
    r = np.random.default_rng(5)
    texts = [" ".join(["w"] * n) for n in (1, 2, 30, 0, 60, 7, 30)]
    w = Words(pa.array(texts))
    for scale in (0.2, 1.0, 3.0):
        s = -r.random((len(w), 3)) * scale
        s[20:45, 1] += 0.8 * scale
        path = language_id.best_path(w, s, switch=1.5)
        for i in range(len(texts)):
            own = slice(w.row[i], w.row[i + 1])
            if w.counts[i]:
                total = s[own][np.arange(w.counts[i]), path[own]].sum() - 1.5 * (np.diff(path[own]) != 0).sum()
                assert math.isclose(total, viterbi(s[own].tolist(), 1.5), rel_tol=1e-9, abs_tol=1e-9)


def test_scripts():
    w = Words(pa.array(["hello Straße Привет ελλη 漢字 かな 한글 שלום مرحبا 123 ... ไทย"]))
    names = ["", *language_id.SCRIPTS]
    assert [names[k] for k in language_id.word_scripts(w)] == [
        "latin", "latin", "cyrillic", "greek", "han", "kana", "hangul", "hebrew", "arabic", "", "", "thai"]


def test_scripts_narrow_and_spans_follow_languages(spark):
    de = "und der die das nicht ein ist mit auf für von dem sich den werden bei oder wurde "
    ru = "и в не на что он как это по но из у за от так для или был "
    rows = [(k, de if k % 2 else ru, "de" if k % 2 else "ru") for k in range(40)]
    docs = spark.createDataFrame([(i, t * 3, lang) for i, t, lang in rows], "doc_id long, text string, lang string")
    model = language_id.fit(docs)
    assert model.langs == ["de", "ru"]
    latin, cyrillic = 1, list(language_id.SCRIPTS).index("cyrillic") + 1
    assert model.candidates[latin].tolist() == [True, False]
    assert model.candidates[cyrillic].tolist() == [False, True]
    text = de * 2 + ru * 2
    names, score, spans = language_id.label(pa.array([text, "12 34 !", None, "", "漢字"]), model)
    assert [s["lang"] for s in spans[0]] == ["de", "ru"]
    raw = text.encode()
    assert raw[spans[0][0]["begin"]:spans[0][0]["end"]].decode().split() == (de * 2).split()
    assert list(names[1:4]) == ["und"] * 3 and score[1:4].tolist() == [0, 0, 0]
    assert names[4] in ("de", "ru") and 0 < score[0] < 1


def test_scripts_that_are_not_listed_are_learned(spark):
    am = "ሰላም ነው እና ላይ ውስጥ ግን ሁሉም "
    km = "ខ្មែរ ភាសា និង នៃ ក្នុង ដែល "
    ti = "ከመይ ኣሎ ድማ ኣብ ምስ ግና ኩሉ "
    texts = {"am": am, "de": "und der die das nicht ein ist ", "km": km, "ti": ti, "zz": "\U00020000\U00020001 \U00020002 "}
    rows = [(k, t * 3, lang) for k, (lang, t) in enumerate(list(texts.items()) * 8)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    names, score, _ = language_id.label(pa.array([*texts.values(), "፩ 12 !"]), model)
    assert names == [*texts, "und"] and (score[:5] == 1).all()
    assert language_id.word_scripts(Words(pa.array(["ሰላም ខ្មែរ \U00020000 ፩ — ½ 漢ሰ"]))).tolist() == [
        language_id.OTHER] * 3 + [0] * 3 + [list(language_id.SCRIPTS).index("han") + 1]


def test_sample_of_a_huge_language_is_not_empty():
    for n in (1, 1500, 2_000_000_000, 10**13):
        expected = n * language_id._share(n, 1500) / language_id.HASHES
        assert math.isclose(expected, min(n, 1500), rel_tol=1e-6)


def test_language_query(spark):
    rows = language_id.predict_query(spark, table(spark, SF, "documents")).toPandas()
    lang = table(spark, SF, "documents").select("doc_id", "lang").toPandas()
    held = rows[rows.held_out].merge(lang, on="doc_id")
    assert len(held) > 30 and (held.lang == held.lang_pred).mean() >= 0.97
    assert rows.score.between(0, 1).all()
    assert [crc(i, 3) == 1 for i in rows.doc_id] == rows.held_out.tolist()


def test_language_edge_rows(spark):
    docs = brute.edge_docs(spark)
    got = language_id.predict_query(spark, docs).toPandas()
    assert len(got) == len(brute.EDGE)
    by = {i: p for i, p in zip(got.doc_id, got.lang_pred)}
    assert by[1] == by[2] == by[3] == "und" and by[7] == "en"
    assert (got.score[got.lang_pred == "und"] == 0).all()
    kept = language_id.keep_known(spark, docs)
    assert kept.columns == docs.columns and kept.count() == (got.lang_pred != "und").sum()
    assert language_id.predict_query(spark, docs.limit(0)).count() == 0
    nothing = language_id.predict_query(spark, docs.drop("lang").selectExpr("*", "cast(null as string) as lang"))
    assert set(nothing.toPandas().lang_pred) == {"und"}


def test_ordinal_fit_recovers_order():
    r = np.random.default_rng(1)
    n, size = 3000, 6
    x = r.random((n, size)) < 0.4
    f = x @ np.array([2.0, 1.0, 0.0, 0.0, -1.0, 3.0])
    y = (f[:, None] + r.logistic(size=n)[:, None] > np.array([1.0, 2.5, 4.5])).sum(axis=1)
    row, slot = np.nonzero(x)
    w, t = toxicity.fit_ordinal(row, slot, y, size)
    assert (np.diff(t) > 0).all()
    assert w[5] > w[0] > w[1] > max(w[2], w[3]) > w[4]
    assert np.allclose(w, [2, 1, 0, 0, -1, 3], atol=0.5)


def test_toxicity_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.score_query(spark, table(spark, sf, "documents"), table(spark, sf, "labels")).toPandas()
    labels = table(spark, sf, "labels").toPandas().rename(columns={"toxic": "label"})
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert rows.expected_severity.between(0, 3).all()
    assert held[held.label == 0].toxic.mean() < 0.02
    assert held[held.label == 1].toxic.mean() > 0.6
    order = held.expected_severity.rank()
    pos, neg = (held.label == 1), (held.label == 0)
    auc = (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * neg.sum())
    assert auc > 0.85


def test_toxicity_edge_rows(spark):
    docs = brute.edge_docs(spark)
    labels = spark.createDataFrame([(i, k % 2 if k % 5 else None) for k, (i, _) in enumerate(brute.EDGE)],
                                   "doc_id long, toxic int")
    got = toxicity.score_query(spark, docs, labels).toPandas()
    assert len(got) == len(brute.EDGE) and got.expected_severity.between(0, 3).all()
    none = toxicity.score_query(spark, docs, labels.limit(0)).toPandas()
    assert (none.expected_severity == 0).all() and not none.toxic.any()
    assert toxicity.score_query(spark, docs.limit(0), labels).count() == 0


def test_features_are_bytes_of_words():
    a = toxicity.features(pa.array(["Idiot!", "the (idiot), now", "xidiotx", None, "..", ""]))
    rows = [set(a[1][a[0] == k].tolist()) for k in range(6)]
    assert rows[0] <= rows[1] and rows[0] & rows[2] and not rows[3] and not rows[5]
