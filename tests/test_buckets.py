"""Upserts that rewrite only the buckets of their keys."""

import os

from encore.sinks import buckets as B

SCHEMA = "k int, g string, v string"


def rows(spark, items):
    return spark.createDataFrame([(k, "x", v) for k, v in items], SCHEMA)


def table(spark, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    found = sorted((r.k, r.v) for r in B.read_buckets(spark, path, schema).collect())
    assert schema.fieldNames() == ["k", "g", "v"]
    return found


def files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith(B.BUCKET)}


def test_upserts_equal_a_dictionary_and_keep_other_buckets(spark, tmp_root):
    path, held = f"{tmp_root}/t", {}
    steps = [[(k, f"a{k}") for k in range(200)], [(3, "b3"), (500, "new")], [(500, None)], [], [(3, "b3")]]
    for step in steps:
        before = files(path) if held else {}
        touched = B.upsert_buckets(rows(spark, step), path, ["k", "g"], buckets=16)
        held.update(step)
        assert table(spark, path) == sorted(held.items())
        after = files(path)
        changed = {d for d in after if after[d] != before.get(d)}
        assert changed == {f"{B.BUCKET}={b}" for b in touched} and len(touched) <= max(len(step), 0)
        assert len(touched) == 16 if len(step) == 200 else len(touched) <= 2
    assert all(len(f) == 1 for f in files(path).values())
    assert not os.path.exists(f"{path}/{B._STAGE}")


def test_an_unfinished_upsert_is_finished_by_the_next(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/t"
    B.upsert_buckets(rows(spark, [(1, "a"), (2, "b")]), path, ["k", "g"], buckets=4)

    monkeypatch.setattr(B, "finish_replace", lambda *a: False)     # dies after the stage is whole
    B.upsert_buckets(rows(spark, [(1, "A"), (3, "c")]), path, ["k", "g"], buckets=4)
    assert table(spark, path) == [(1, "a"), (2, "b")]               # readers see no part of it
    monkeypatch.undo()
    B.upsert_buckets(rows(spark, [(2, "B")]), path, ["k", "g"], buckets=4)
    assert table(spark, path) == [(1, "A"), (2, "B"), (3, "c")]
