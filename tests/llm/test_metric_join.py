"""Operator 10 against brute force."""

import numpy as np
import pytest

from encore.llm import metric_join
from tests.llm import brute


def clusters(seed=3, n=900, dim=12, groups=40):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(groups, dim))
    rows = []
    for k in range(n):
        g = r.integers(groups)
        v = centre[g] / np.linalg.norm(centre[g]) + r.normal(size=dim) * r.choice([0.0, 0.02, 0.045, 0.3])
        rows.append((k, [float(x) for x in (v * r.choice([1.0, 3.0])).astype(np.float32)], int(r.choice([0, 0, 0, 1]))))
    rows += [(n + k, list(rows[0][1]), rows[0][2]) for k in range(60)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dim, [nan] + [1.0] * (dim - 1), [inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1),
           rows[0][1][:5]]
    rows += [(n + 100 + k, v, 0) for k, v in enumerate(odd)]
    rows += [(n + 200, list(rows[0][1]), None), (None, list(rows[0][1]), rows[0][2]), (5, list(rows[5][1]), rows[5][2])]
    return rows


def brute_join(rows, cosine=0.98):
    unit = []
    for _, v, label in rows:
        ok = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    u, links = brute.Union(), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] \
                    and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                u.join(i, j)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[u.find(k)] = min(low.get(u.find(k), brute.BIG), i)
    out = []
    for k, (i, _, _) in enumerate(rows):
        comp = low.get(u.find(k))
        out.append((i, links[k], comp, i is not None and i == comp))
    return brute.ordered(out)


@pytest.mark.parametrize("block", [2048, 128, 16])
def test_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(metric_join, "BLOCK", block)
    monkeypatch.setattr(metric_join, "COPIES", 40.0)
    rows = clusters()
    df = spark.createDataFrame([(*r, "x", "x") for r in rows],
                               "vec_id long, embedding array<float>, label int, node string, n string")
    got = brute.rows_of(metric_join.join_query(df), "vec_id", "n_links", "component_id", "kept")
    assert got == brute_join(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert metric_join.join_query(df).count() == 0


def test_cells_hold_every_partner():
    r = np.random.default_rng(7)
    x = r.normal(size=(400, 6))
    x[1::2] = x[::2] + 0.05 * r.normal(size=(200, 6))
    x /= np.linalg.norm(x, axis=1)[:, None]
    radius = float(np.sqrt(2 - 2 * 0.98))
    home, near = metric_join._copies(x, x[:32], radius)
    for i, j in zip(*np.nonzero(x @ x.T >= 0.98)):
        assert near[j, home[i]]
    assert near.sum() < 0.9 * near.size


def test_pivots_are_chosen_when_they_help():
    r = np.random.default_rng(8)
    centre = r.normal(size=(200, 8))
    x = np.repeat(centre, 20, axis=0) + 0.02 * r.normal(size=(4000, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r.shuffle(x)
    assert len(metric_join.choose_pivots(x[:2000], 1_000_000, 0.2)) >= 16
    assert len(metric_join.choose_pivots(x[:100], 100, 0.2)) == 1
