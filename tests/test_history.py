"""Point-in-time joins and back-fills against plain Python."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from encore import schemas
from encore.operators.backfill import affected_months, backfill_gold, dimension_changes
from encore.operators.enrich import enrich
from encore.operators.gold import gold_layout, split_gold, standardize_gold
from encore.operators.history import (
    SONG_ATTRIBUTES, USER_ATTRIBUTES, build_history, current, enrich_as_of, join_as_of, user_history,
)
from encore.sinks import fs

T0 = datetime(2024, 1, 1)


def stamp(minutes):
    return T0 + timedelta(minutes=minutes)


def landed(spark, rows):
    return spark.createDataFrame([(k, v, None if m is None else stamp(m).isoformat()) for k, v, m in rows],
                                 "k int, v string, ingested_at string")


def test_history_merges_repeats_and_orders_ties(spark):
    rows = [(1, "a", 0), (1, "a", 5), (1, "b", 9), (1, "a", 12), (1, "a", 20), (2, "y", 3), (2, "x", 3),
            (None, "z", 1), (3, "q", None), (4, None, 0), (4, None, 7), (4, "n", 8)]
    h = build_history(landed(spark, rows), "k", ["v"])
    got = sorted(((r.k, r.v, r.valid_from, r.valid_to) for r in h.collect()), key=str)
    assert got == sorted([(1, "a", stamp(0), stamp(9)), (1, "b", stamp(9), stamp(12)), (1, "a", stamp(12), None),
                          (2, "x", stamp(3), None), (4, None, stamp(0), stamp(8)), (4, "n", stamp(8), None)], key=str)
    assert sorted((r.k, r.v) for r in current(h).collect()) == [(1, "a"), (2, "x"), (4, "n")]


@pytest.mark.parametrize("days", [1, 30])
def test_join_as_of_equals_a_scan_of_all_versions(spark, days):
    r = random.Random(days)
    versions = [(r.randrange(12), r.choice("abc"), r.randrange(0, 60 * 1440)) for _ in range(150)]
    at = [m for _, _, m in versions]              # also exactly at a version's instant
    # key 0 holds a third of all rows
    rows = [(i, 0 if i % 3 == 0 else r.randrange(14), r.choice([r.choice(at), r.randrange(-1440, 70 * 1440)]))
            for i in range(600)] + [(600, None, 5), (601, 1, None)]
    h = build_history(landed(spark, versions), "k", ["v"])
    plain = h.collect()

    def valid(k, m):
        if k is None or m is None:
            return None
        return next((x.v for x in plain if x.k == k and x.valid_from <= stamp(m)
                     and (x.valid_to is None or stamp(m) < x.valid_to)), None)

    df = spark.createDataFrame([(i, k, None if m is None else stamp(m)) for i, k, m in rows],
                               "i int, k int, at timestamp")
    out = join_as_of(df, h, "k", "at", days)
    assert out.columns == ["i", "k", "at", "v"]
    assert sorted((x.i, x.v) for x in out.collect()) == [(i, valid(k, m)) for i, k, m in rows]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_join_as_of_without_rows_or_versions(spark):
    df = spark.createDataFrame([], "i int, k int, at timestamp")
    h = build_history(landed(spark, [(1, "a", 0)]), "k", ["v"])
    assert join_as_of(df, h, "k", "at").collect() == []
    one = spark.createDataFrame([(1, 1, T0)], "i int, k int, at timestamp")
    none = build_history(landed(spark, []), "k", ["v"])
    assert [x.v for x in join_as_of(one, none, "k", "at").collect()] == [None]


def test_late_version_changes_only_events_after_it(spark):
    users = spark.createDataFrame(
        [("1", "u", "EG", "Free", "2024-01-01T00:00:00"), ("1", "u", "FR", "Free", "2024-01-03T00:00:00")],
        "user_id string, user_name string, country string, subscription_type string, ingested_at string")
    songs = spark.createDataFrame([], "song_id string, song_name string, artist_name string, genre string, "
                                      "valid_from timestamp, valid_to timestamp")
    events = spark.createDataFrame(
        [("a", 1, " s ", "2024-01-02 00:00:00", "PLAY"), ("b", 1, "s", "2024-01-03 00:00:00", "PLAY"),
         ("c", 1, "s", "2023-12-31 23:59:59", "PLAY"), ("d", 1, "s", "soon", "PLAY")],
        "event_id string, user_id int, song_id string, timestamp string, event_type string")
    got = {r.event_id: r.country for r in enrich_as_of(events, user_history(users), songs).collect()}
    assert got == {"a": "EG", "b": "FR", "c": None, "d": None}


def lake(spark):
    """Events of three months and two dimensions."""
    events = spark.createDataFrame(
        [(f"e{i}", i % 7, f"s{i % 5}" if i % 3 else f" s{i % 5} ", f"2024-0{1 + m}-1{i % 9} 10:00:00", "PLAY")
         for m in range(3) for i in range(m * 100, m * 100 + 40) if not (m == 1 and i % 7 in (2, 6))],
        "event_id string, user_id int, song_id string, timestamp string, event_type string")
    users = spark.createDataFrame([(k, f"u{k}", "EG", "Free", True) for k in range(6)], schemas.DIM_USERS)
    songs = spark.createDataFrame([(f"s{k}", f"n{k}", "a", "g") for k in range(5)], schemas.DIM_SONGS)
    return events, users, songs


def gold_of(events, users, songs):
    return split_gold(standardize_gold(enrich(events, users, songs, as_of="2024-05-01 00:00:00")))[0]


def files(path):
    return {m: sorted(f for f in os.listdir(f"{path}/{m}") if f.endswith(".parquet"))
            for m in sorted(os.listdir(path)) if m.startswith("event_month=")}


def same(a, b):
    cols = [c for c in a.columns if c != "processed_at"]
    return a.select(cols).exceptAll(b.select(cols)).isEmpty() and b.select(cols).exceptAll(a.select(cols)).isEmpty()


def test_dimension_changes(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, None), (4, "d", "y")], "k int, p string, q string")
    new = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, None, "z"), (5, "e", "w")], "k int, p string, q string")
    got = sorted(tuple(r) for r in dimension_changes(old, new, "k", ["p", "q"]).collect())
    assert got == [(2, "b", None, "update"), (3, None, "z", "update"), (4, None, None, "delete"), (5, "e", "w", "insert")]


def test_backfill_equals_a_rebuild_and_leaves_other_months_alone(spark, tmp_root):
    events, users, songs = lake(spark)
    path = f"{tmp_root}/gold"
    gold_layout(gold_of(events, users, songs)).write.partitionBy("event_month").parquet(path)
    before = files(path)
    # a late user (6), one that moved (2) and one that is gone: none of 2 and 6 in February
    later = users.filter("user_id <> 9").withColumn(
        "country", F.when(F.col("user_id") == 2, None).otherwise(F.col("country"))) \
        .unionByName(spark.createDataFrame([(6, "late", "FR", "Premium", True)], schemas.DIM_USERS))
    du = dimension_changes(users, later, "user_id", USER_ATTRIBUTES)
    ds = dimension_changes(songs, songs, "song_id", SONG_ATTRIBUTES)
    gold = spark.read.schema(schemas.GOLD).parquet(path)
    assert sorted(affected_months(gold, du, ds)) == [202401, 202403]
    assert backfill_gold(spark, path, du, ds, as_of="2024-06-01 00:00:00") == [202401, 202403]
    after = files(path)
    assert after["event_month=202402"] == before["event_month=202402"]
    assert after["event_month=202401"] != before["event_month=202401"]
    got = spark.read.schema(schemas.GOLD).parquet(path)
    assert same(got, gold_of(events, later, songs))
    renewed = got.filter("processed_at = timestamp'2024-06-01 00:00:00'").select("user_id").distinct().collect()
    assert sorted(r.user_id for r in renewed) == [2, 6]
    # a song with other attributes is in every month; the song key is trimmed
    moved = songs.withColumn("genre", F.when(F.col("song_id") == "s3", "new").otherwise(F.col("genre")))
    ds = dimension_changes(songs, moved, "song_id", SONG_ATTRIBUTES)
    du = dimension_changes(later, later, "user_id", USER_ATTRIBUTES)
    assert backfill_gold(spark, path, du, ds) == [202401, 202402, 202403]
    assert same(spark.read.schema(schemas.GOLD).parquet(path), gold_of(events, later, moved))
    assert backfill_gold(spark, path, du, dimension_changes(moved, moved, "song_id", SONG_ATTRIBUTES)) == []


def test_backfill_goes_on_from_staged_months(spark, tmp_root, monkeypatch):
    events, users, songs = lake(spark)
    path = f"{tmp_root}/gold"
    gold_layout(gold_of(events, users, songs)).write.partitionBy("event_month").parquet(path)
    later = users.withColumn("user_name", F.concat("user_name", F.lit("!")))
    du = dimension_changes(users, later, "user_id", USER_ATTRIBUTES)
    ds = dimension_changes(songs, songs, "song_id", SONG_ATTRIBUTES)

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(fs, "list_dirs", lost)
    with pytest.raises(RuntimeError):
        backfill_gold(spark, path, du, ds)
    monkeypatch.undo()
    # readers still see the old months; the next run finishes the job
    assert same(spark.read.schema(schemas.GOLD).parquet(path), gold_of(events, users, songs))
    assert backfill_gold(spark, path, du, ds) == [202401, 202402, 202403]
    assert same(spark.read.schema(schemas.GOLD).parquet(path), gold_of(events, later, songs))
