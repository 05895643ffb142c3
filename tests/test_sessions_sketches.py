"""Sessions, cardinality sketches and daily leaders against plain Python."""

import os
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from encore import schemas
from encore.operators import sketches as S
from encore.operators.sessions import listening_patterns, sessions, stream_sessions

T0 = datetime(2024, 1, 1)


def gold(spark, rows):
    """(user, seconds since T0, event type, song) as gold rows."""
    df = spark.createDataFrame([(u, T0 + timedelta(seconds=s), t, song) for u, s, t, song in rows],
                               "user_id int, event_timestamp timestamp, event_type string, song_name string")
    return df.withColumn("artist_name", F.lit("a")).withColumn(
        "country", F.when(F.col("user_id") % 2 == 0, "EG").otherwise("FR"))


def islands(rows, gap):
    by = defaultdict(list)
    for u, s, t, _ in rows:
        if u is not None:
            by[u].append((s, t))
    out = []
    for u, events in by.items():
        events.sort()
        runs = [[events[0]]]
        for a, b in zip(events, events[1:]):
            if b[0] - a[0] > gap:
                runs.append([])
            runs[-1].append(b)
        out += [(u, r[0][0], r[-1][0], len(r), sum(t == "PLAY" for _, t in r), sum(t == "SKIP" for _, t in r))
                for r in runs]
    return sorted(out)


def some_events(seed=2, n=500):
    r = random.Random(seed)
    rows = [(0 if k % 3 == 0 else r.randrange(9), r.randrange(0, 9 * 86400), r.choice(["PLAY", "SKIP", "LIKE"]), "s")
            for k in range(n)]
    # pauses of exactly the gap, one second more and less; repeated instants; no user
    rows += [(50, x, "PLAY", "s") for x in (0, 1800, 3600, 5401, 7200, 7200)] + [(None, 5, "PLAY", "s")]
    return rows


def seconds(t):
    return int((t - T0).total_seconds())


def rows_of(df):
    return sorted((r.user_id, seconds(r.started), seconds(r.ended), r.events, r.plays, r.skips) for r in df.collect())


def test_sessions_are_gaps_and_islands(spark):
    rows = some_events()
    assert rows_of(sessions(gold(spark, rows))) == islands(rows, 1800)
    assert rows_of(sessions(gold(spark, rows), "6 hours")) == islands(rows, 6 * 3600)
    assert sessions(gold(spark, rows).limit(0)).collect() == []


def test_streamed_sessions_come_once_when_they_are_over(spark, tmp_root):
    rows = sorted(some_events(), key=lambda x: x[1])
    for k in range(0, len(rows), 130):           # in rising time, one file after another
        folder = f"{tmp_root}/in/{k:04d}"
        gold(spark, rows[k:k + 130]).coalesce(1).write.parquet(folder)
        for name in os.listdir(folder):
            os.utime(os.path.join(folder, name), (1_700_000_000 + k, 1_700_000_000 + k))
    schema = "user_id int, event_timestamp timestamp, event_type string, song_name string, artist_name string, country string"

    def run():
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_root}/in/*")
        q = (stream_sessions(src, delay="1 hour").writeStream.format("parquet").option("checkpointLocation", f"{tmp_root}/c")
             .trigger(availableNow=True).start(f"{tmp_root}/out"))
        q.awaitTermination()
        return rows_of(spark.read.parquet(f"{tmp_root}/out"))

    every = islands(rows, 1800)
    open_from = rows[-1][1] - 3600 - 1800
    assert run() == [x for x in every if x[2] < open_from]
    gold(spark, [(-1, 40 * 86400, "PLAY", "s")]).coalesce(1).write.parquet(f"{tmp_root}/in/9999")
    assert [x for x in run() if x[0] != -1] == every


def test_listening_patterns(spark):
    rows = some_events(4)
    by = defaultdict(list)
    for x in islands(rows, 1800):
        by[x[0]].append(x)
    got = {r.user_id: r for r in listening_patterns(sessions(gold(spark, rows))).collect()}
    assert set(got) == set(by)
    for u, s in by.items():
        r, length = got[u], [b - a for _, a, b, *_ in s]
        pauses = [b[1] - a[2] for a, b in zip(s, s[1:])]
        assert (r.sessions, r.events, r.longest_seconds) == (len(s), sum(x[3] for x in s), max(length))
        assert r.median_seconds == median(length) and r.median_events == median(x[3] for x in s)
        assert r.median_pause_seconds == (median(pauses) if pauses else None)


def test_sketches_answer_any_range_of_days(spark, tmp_root):
    r = random.Random(8)
    # 30,000 users of one day is far beyond what a sketch counts exactly
    big = spark.range(60_000).select(
        (F.col("id") % 30_000).cast("int").alias("user_id"),
        (F.lit(T0) + F.make_dt_interval((F.col("id") % 5).cast("int"))).alias("event_timestamp"),
        F.when(F.col("id") % 2 == 0, "EG").otherwise("FR").alias("country"))
    S.listener_sketches(big).write.parquet(f"{tmp_root}/s")
    stored = spark.read.parquet(f"{tmp_root}/s")
    assert stored.count() == 10 and stored.agg(F.max(F.length("users"))).first()[0] <= (1 << S.LG_K) + 64
    plain = [(i % 30_000, i % 5, "EG" if i % 2 == 0 else "FR") for i in range(60_000)]
    for _ in range(4):
        a, b = sorted((r.randrange(5), r.randrange(5)))
        exact = len({u for u, d, _ in plain if a <= d <= b})
        told = S.listeners_between(stored, f"2024-01-0{1 + a}", f"2024-01-0{1 + b}").first()["listeners"]
        assert abs(told - exact) <= S.error_bound() * exact
    by = {x.country: x.listeners for x in S.listeners_between(stored, "2024-01-01", "2024-01-05", ["country"]).collect()}
    assert set(by) == {"EG", "FR"} and all(abs(n - 15_000) <= S.error_bound() * 15_000 for n in by.values())
    # a day merged twice changes nothing, and small sets are exact
    twice = S.listeners_between(stored.unionByName(stored), "2024-01-01", "2024-01-05").first()["listeners"]
    assert twice == S.listeners_between(stored, "2024-01-01", "2024-01-05").first()["listeners"]
    few = gold(spark, [(u, 60 * u, "PLAY", "s") for u in range(300)] * 2 + [(None, 0, "PLAY", "s")])
    assert S.listeners_between(S.listener_sketches(few), "2024-01-01", "2024-01-01").first()["listeners"] == 300


@pytest.mark.parametrize("m,skewed", [(3, True), (3, False), (1, False), (50, False)])
def test_leaders_prove_or_give_way(spark, m, skewed):
    r = random.Random(m)
    rows = []
    for day in range(6):
        for k in range(300):
            song = int(r.paretovariate(1.1)) if skewed else r.randrange(30)
            rows.append((1, day * 86400 + k, r.choice(["PLAY", "PLAY", "SKIP"]), f"s{min(song, 40)}"))
    daily = S.daily_song_plays(gold(spark, rows)).cache()
    leaders = S.daily_leaders(daily, m)
    n = Counter(f"{s} - a" for _, x, t, s in rows if t == "PLAY" and 86400 <= x < 5 * 86400)
    expect = sorted(n.items(), key=lambda x: (-x[1], x[0]))[:2]
    _, proven = S.top_songs_of_days(daily, leaders, 2, "2024-01-02", "2024-01-05")
    assert proven == {(3, True): True, (3, False): False, (1, False): False, (50, False): True}[m, skewed]
    best, told = S.top_songs_between(daily, leaders, 2, "2024-01-02", "2024-01-05")
    assert told == proven and [(x.song, x.plays) for x in best.collect()] == expect
    none, whole = S.top_songs_between(daily, leaders, 2, "2025-01-01", "2025-01-02")
    assert whole and none.collect() == []
