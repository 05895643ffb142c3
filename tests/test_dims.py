from pyspark.sql import functions as F

from encore.operators.dims import build_dim_songs, build_dim_users, upsert, upsert_table
from encore.sinks.tables import current_version, resolve_current

SONG_COLS = "song_id string, song_name string, artist_name string, album_name string, " \
            "duration_ms long, genre string, ingested_at string"
USER_COLS = "user_id string, user_name string, country string, subscription_type string, " \
            "ingested_at string"


def test_songs_trim_dedupe_latest(spark):
    df = spark.createDataFrame([
        (" s1 ", "old", "a", None, None, "g", "2024-01-01T00:00:00"),
        ("s1", "new", "a", None, None, "g", "2024-01-02T00:00:00"),
        (None, "x", "a", None, None, "g", "2024-01-02T00:00:00"),
        ("s2", "b", "a", None, None, "g", "2024-01-01T00:00:00"),
    ], SONG_COLS)
    out = {r.song_id: r.song_name for r in build_dim_songs(df).collect()}
    assert out == {"s1": "new", "s2": "b"}


def test_users_cast_and_current(spark):
    df = spark.createDataFrame([
        ("3.0", "a", "EG", "Free", "t1"), (" 2 ", "b", "US", "Premium", "t1"),
        ("x", "c", "UK", "Free", "t1"), ("1e2", "d", "UK", "Free", "t1"),
    ], USER_COLS)
    out = build_dim_users(df).collect()
    assert sorted(r.user_id for r in out) == [2, 3]
    assert all(r.is_current for r in out)


def test_upsert_semantics(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    out = sorted(tuple(r) for r in upsert(t, s, ["k"]).collect())
    assert out == [(1, "a"), (2, "B"), (3, "C")]
    again = sorted(tuple(r) for r in upsert(upsert(t, s, ["k"]), s, ["k"]).collect())
    assert again == out


def test_upsert_table_versions(spark, tmp_root):
    path = f"{tmp_root}/dim"
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    upsert_table(a, path, ["k"])
    assert current_version(spark, path) == 0
    upsert_table(spark.createDataFrame([(2, "B")], "k int, v string"), path, ["k"])
    assert current_version(spark, path) == 1
    cur = sorted(tuple(r) for r in spark.read.parquet(resolve_current(spark, path)).collect())
    assert cur == [(1, "a"), (2, "B")]
    # a replayed upsert leaves the content unchanged
    upsert_table(spark.createDataFrame([(2, "B")], "k int, v string"), path, ["k"])
    cur2 = sorted(tuple(r) for r in spark.read.parquet(resolve_current(spark, path)).collect())
    assert cur2 == cur


def test_prune_versions_keeps_newest(spark, tmp_root):
    from encore.sinks import fs
    from encore.sinks.tables import prune_versions, publish_version
    root = f"{tmp_root}/t"
    for i in range(5):
        publish_version(spark.range(i + 1), root)
    fs.mkdirs(spark, f"{root}/v=000005")                  # a failed attempt (no _SUCCESS)
    assert prune_versions(spark, root, keep=2) == []      # all too recent by default
    cur = resolve_current(spark, root)
    gone = prune_versions(spark, root, keep=2, min_age_seconds=0)
    assert [g.rsplit("/", 1)[1] for g in gone] == ["v=000000", "v=000001", "v=000002"]
    assert resolve_current(spark, root) == cur and spark.read.parquet(cur).count() == 5
    assert sorted(d for d in fs.list_dirs(spark, root)) == ["v=000003", "v=000004", "v=000005"]


def test_uncommitted_version_is_never_read(spark, tmp_root):
    import pytest

    from encore.sinks import fs
    from encore.sinks.tables import publish_version, resolve_current
    fs.mkdirs(spark, f"{tmp_root}/t/v=000000")
    with pytest.raises(RuntimeError, match="no committed version"):
        resolve_current(spark, f"{tmp_root}/t")
    path = publish_version(spark.range(3), f"{tmp_root}/t")
    assert resolve_current(spark, f"{tmp_root}/t") == path and path.endswith("v=000001")
