"""Exact inner product search against scoring every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.plans import lake
from encore.plans.inner_product import by_norm, top_inner_products
from encore.plans.ml import als_recommend_catalogue, candidates

USERS, ITEMS = "u int, features array<float>", "i string, features array<float>"


def factors(rng, n, rank, spread):
    """Vectors with long and short ones, some zero and some equal."""
    v = rng.normal(size=(n, rank)) * np.exp(rng.normal(scale=spread, size=(n, 1)))
    v[::17] = 0
    v[5::23] = v[5]
    return v.astype(np.float32)


def brute(users, items, excluded, n):
    """{u: [(score, i)]} with ties by the length of the vector, then i."""
    norm = {i: float(np.sqrt((v.astype(float) ** 2).sum())) for i, v in items}
    out = {}
    for u, f in users:
        s = [(-float(f.astype(float) @ v.astype(float)), -norm[i], i) for i, v in items if (u, i) not in excluded]
        out[u] = [(-a, i) for a, _, i in sorted(s)[:n]]
    return out


def search(spark, users, items, excluded, n, block):
    u = spark.createDataFrame([(k, v.tolist()) for k, v in users], USERS)
    i = spark.createDataFrame([(k, v.tolist()) for k, v in items], ITEMS)
    e = spark.createDataFrame(sorted(excluded), "u int, i string")
    found, scored = {}, {}
    for r in top_inner_products(u, "u", i, "i", n, e, block).collect():
        found.setdefault(r.u, []).append((r.rank, r.score, r.i))
        scored[r.u] = r.scored
    return {u: sorted(v) for u, v in found.items()}, scored


@pytest.mark.parametrize("n,block", [(3, 16), (5, 7), (2, 1000)])
def test_search_equals_brute_force(spark, n, block):
    rng = np.random.default_rng(block)
    users = list(enumerate(factors(rng, 60, 6, 0.2)))
    items = [(f"i{k:03d}", v) for k, v in enumerate(factors(rng, 120, 6, 1.0))]
    # one user has had everything but one item, one everything
    excluded = {(1, i) for i, _ in items[1:]} | {(2, i) for i, _ in items} \
        | {(u, f"i{k:03d}") for u in range(3, 60) for k in rng.integers(0, 120, 9).tolist()} | {(3, "no such item")}
    found, scored = search(spark, users, items, excluded, n, block)
    expect = brute(users, items, excluded, n)
    assert set(found) == {u for u, v in expect.items() if v}
    for u, rows in found.items():
        assert [r for r, _, _ in rows] == list(range(1, len(rows) + 1))
        assert np.allclose([s for _, s, _ in rows], [s for s, _ in expect[u]], rtol=1e-9, atol=1e-9)
        clear = [i for k, (s, i) in enumerate(expect[u]) if all(abs(s - t) > 1e-7 for j, (t, _) in enumerate(expect[u]) if j != k)]
        assert set(clear[:-1]) <= {i for _, _, i in rows}
        assert not {(u, i) for _, _, i in rows} & excluded
    if block == 16:          # long vectors first: most pairs are never scored
        assert sum(scored.values()) < 0.7 * len(scored) * len(items)


def test_places_run_from_the_longest_vector(spark):
    rng = np.random.default_rng(3)
    items = [(f"i{k}", v.tolist()) for k, v in enumerate(factors(rng, 50, 4, 1.0))]
    rows = by_norm(spark.createDataFrame(items, ITEMS), "i").orderBy("place").collect()
    assert [r.place for r in rows] == list(range(50))
    assert all((-a.norm, a.i) <= (-b.norm, b.i) for a, b in zip(rows, rows[1:]))


def test_no_users_or_items(spark):
    v = np.ones(3, np.float32)
    assert search(spark, [(1, v)], [], {(1, "x")}, 3, 4)[0] == {}
    assert search(spark, [], [("a", v)], {(1, "x")}, 3, 4)[0] == {}


def test_catalogue_recommendations(spark):
    gold = lake.from_tables(spark, "/root/testdata/sf0.001").gold
    played = {(r.user_id, r.song_id) for r in gold.filter("event_type = 'PLAY'").select("user_id", "song_id").collect()}
    users, songs = {u for u, _ in played}, {s for _, s in played}
    by_user = {}
    for r in als_recommend_catalogue(gold, n=3, block=16).collect():
        by_user.setdefault(r.user_id, []).append(r)
    assert set(by_user) == users
    for u, rows in by_user.items():
        rows.sort(key=lambda r: r.rank)
        left = len(songs) - sum(1 for x in played if x[0] == u)
        assert [r.rank for r in rows] == list(range(1, min(3, left) + 1))
        assert all(a.score >= b.score for a, b in zip(rows, rows[1:]))
        assert not {(u, r.song_id) for r in rows} & played


def test_candidates_of_heavy_listeners(spark):
    """Who has played the whole top of the chart gets the songs below it."""
    plays = spark.createDataFrame(
        [(1, "EG", f"s{k:03d}", 300 - k) for k in range(60)] + [(2, "EG", f"s{k:03d}", 1) for k in range(100)]
        + [(3, "EG", "s000", 1), (4, "FR", "s001", 1)], "user_id int, country string, song_id string, plays long")
    got = {}
    for r in candidates(plays, k=10).collect():
        got.setdefault(r.user_id, set()).add(r.song_id)
    assert got == {1: {f"s{k:03d}" for k in range(60, 70)}, 3: {f"s{k:03d}" for k in range(1, 11)}}
