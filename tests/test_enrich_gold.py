from pyspark.sql import functions as F

from encore.operators.enrich import enrich
from encore.operators.gold import split_gold, standardize_gold

EV = "event_id string, user_id int, song_id string, timestamp string, event_type string, " \
     "ingestion_time timestamp, source string"


def _frames(spark):
    ev = spark.createDataFrame([
        ("e1", 1, " s1 ", "2024-01-01 10:00:00", "PLAY", None, "k"),
        ("e2", 9, "s9", "2024-01-01 10:00:01", "SKIP", None, "k"),
        ("e3", 1, "", "2024-01-01 10:00:02", None, None, "k"),
        ("e4", 2, "s1", "not a time", "PLAY", None, "k"),
        (None, 2, "s1", "2024-01-01 10:00:03", "PLAY", None, "k"),
    ], EV)
    users = spark.createDataFrame([(1, "u1", "EG", "Premium", True), (2, "u2", "", "Free", True)],
                                  "user_id int, user_name string, country string, "
                                  "subscription_type string, is_current boolean")
    songs = spark.createDataFrame([("s1", "song1", "art1", "pop")],
                                  "song_id string, song_name string, artist_name string, genre string")
    return ev, users, songs


def test_enrich_keeps_every_event_and_raw_song_id(spark):
    ev, users, songs = _frames(spark)
    s = enrich(ev, users, songs, as_of="2024-02-01 00:00:00")
    assert s.count() == ev.count()
    r = {x.event_id: x for x in s.collect() if x.event_id}
    assert r["e1"].song_name == "song1" and r["e1"].song_id == " s1 "
    assert r["e2"].user_name is None and r["e2"].song_name is None


def test_gold_defaults_types_and_rejects(spark):
    ev, users, songs = _frames(spark)
    ok, rej = split_gold(standardize_gold(enrich(ev, users, songs, as_of="2024-02-01 00:00:00")))
    r = {x.event_id: x for x in ok.collect()}
    assert set(r) == {"e1", "e2", "e3"}
    assert (r["e2"].user_name, r["e2"].country, r["e2"].subscription_type) == ("Guest", "Unknown", "Free")
    assert (r["e2"].song_name, r["e2"].artist_name, r["e2"].genre) == ("Unknown",) * 3
    assert r["e3"].event_type == "N/A"
    assert r["e1"].event_month == 202401
    assert str(r["e1"].event_timestamp) == "2024-01-01 10:00:00"
    rj = rej.collect()
    assert [x.event_id for x in rj] == ["e4"] and rj[0].country == ""  # '' is not defaulted
    assert dict(ok.dtypes)["event_timestamp"] == "timestamp"


def test_write_gold_batches_and_rejects(spark, tmp_root):
    from encore.sinks import fs
    from encore.sinks.writers import write_gold
    ev, users, songs = _frames(spark)
    silver = enrich(ev, users, songs, as_of="2024-02-01 00:00:00")
    gold, rej = f"{tmp_root}/gold", f"{tmp_root}/rejects"
    assert write_gold(silver.limit(0), 0, gold, rej) == 0          # empty batch: nothing
    assert not fs.exists(spark, f"{gold}/batch_id=0")
    assert write_gold(silver.filter(F.col("event_id") != "e4"), 1, gold, rej) == 1
    assert fs.exists(spark, f"{gold}/batch_id=1")
    assert not fs.exists(spark, f"{rej}/batch_id=1")                # no rejects, no output
    assert write_gold(silver, 2, gold, rej) == 1
    assert [r.event_id for r in spark.read.parquet(f"{rej}/batch_id=2").collect()] == ["e4"]
    loaded = spark.read.parquet(gold)
    assert sorted(r.event_id for r in loaded.collect()) == ["e1", "e1", "e2", "e2", "e3", "e3"]
