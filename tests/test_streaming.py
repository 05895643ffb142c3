import pytest
from pyspark.sql import functions as F

from encore.operators.dims import build_dim_songs, build_dim_users, upsert_table
from encore.plans import lake
from encore.sinks import writers
from encore.sources import fixtures
from encore.sources.readers import event_stream
from encore.streaming.pipeline import LakePaths, run_pipeline

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


def _gold(spark, paths):
    return spark.read.parquet(paths.gold).drop("processed_at", "batch_id")


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp_root):
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    writers.publish_messages(fixtures.event_messages(spark, SF), msgs)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 2})
    run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF)
    streamed = _gold(spark, paths)
    batch = lake.from_tables(spark, SF).gold.drop("processed_at")
    assert streamed.count() == 801
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0
    # restart from the same checkpoints: nothing new, nothing duplicated
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 2})
    run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF)
    assert _gold(spark, paths).count() == 801


def test_publish_batch_skips_published(spark, tmp_root):
    df = spark.range(5)
    assert writers.publish_batch(df, f"{tmp_root}/t", 0)
    assert not writers.publish_batch(df, f"{tmp_root}/t", 0)
    assert spark.read.parquet(f"{tmp_root}/t").count() == 5


def test_dimension_update_seen_by_next_batch(spark, tmp_root):
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    users = spark.createDataFrame([("1", "old", "EG", "Free", "t0")],
                                  "user_id string, user_name string, country string, "
                                  "subscription_type string, ingested_at string")
    songs = spark.createDataFrame([("s1", "n", "a", None, None, "g", "t0")],
                                  "song_id string, song_name string, artist_name string, "
                                  "album_name string, duration_ms long, genre string, "
                                  "ingested_at string")
    upsert_table(build_dim_users(users), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(songs), paths.dim_songs, ["song_id"])
    m1 = '{"event_id":"a","user_id":1,"song_id":"s1","timestamp":"2024-01-01 00:00:00","event_type":"PLAY"}'
    m2 = '{"event_id":"b","user_id":1,"song_id":"s1","timestamp":"2024-01-01 00:00:01","event_type":"PLAY"}'
    spark.createDataFrame([(m1,)], "value string").coalesce(1).write.text(f"{msgs}/1")
    run_pipeline(spark, event_stream(spark, fmt="text", path=f"{msgs}/*"), paths, trigger=NOW)
    upsert_table(build_dim_users(users.withColumn("user_name", F.lit("new"))),
                 paths.dim_users, ["user_id"])
    spark.createDataFrame([(m2,)], "value string").coalesce(1).write.text(f"{msgs}/2")
    run_pipeline(spark, event_stream(spark, fmt="text", path=f"{msgs}/*"), paths, trigger=NOW)
    names = {r.event_id: r.user_name for r in _gold(spark, paths).collect()}
    assert names == {"a": "old", "b": "new"}


def test_new_checkpoint_over_published_table_is_refused(spark, tmp_root):
    import pytest

    from encore.streaming.pipeline import guard_checkpoint
    writers.publish_batch(spark.range(1), f"{tmp_root}/t", 0)
    with pytest.raises(RuntimeError):
        guard_checkpoint(spark, f"{tmp_root}/ckpt", f"{tmp_root}/t")
    guard_checkpoint(spark, f"{tmp_root}/ckpt2", f"{tmp_root}/empty")


def test_single_read_bronze_matches_two_queries(spark, tmp_root):
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    writers.publish_messages(fixtures.event_messages(spark, SF), msgs)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 3})
    run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF, single_read=True)
    assert _gold(spark, paths).count() == 801
    assert spark.read.parquet(paths.bronze_invalid).count() == 199


def test_publish_batch_marker_commit(spark, tmp_root):
    df = spark.range(3)
    # a broken final directory (no marker) is replaced, a whole one is not
    from encore.sinks import fs
    fs.mkdirs(spark, f"{tmp_root}/m/batch_id=0")
    assert writers.publish_batch(df, f"{tmp_root}/m", 0)
    assert not writers.publish_batch(df, f"{tmp_root}/m", 0)
    with pytest.raises(RuntimeError, match="atomic rename"):
        writers.publish_batch(df, "s3a://bucket/x", 0)
    assert spark.read.parquet(f"{tmp_root}/m").count() == 3


def test_partitioned_dims_with_hot_keys_equal_batch(spark, tmp_root):
    # No dimension may be broadcast and any key with 10+ events is hot, so
    # micro-batches take the partitioned join with the hot-key split.
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    writers.publish_messages(fixtures.event_messages(spark, SF), msgs)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 2})
    run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF,
                 enrich_options={"broadcast_rows": 0, "hot_key_rows": 10})
    streamed = _gold(spark, paths)
    batch = lake.from_tables(spark, SF).gold.drop("processed_at")
    assert streamed.count() == 801
    assert streamed.select(*batch.columns).exceptAll(batch).count() == 0


def test_recommendation_inputs_track_gold(spark, tmp_root):
    import pytest
    from encore.plans.recommend import active_users, plays_by_country
    from encore.sinks import fs
    from encore.streaming.pipeline import (
        gold_stream_schema, read_recommendation_inputs, run_recommendation_inputs,
    )
    from encore.sources.readers import stream_table
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    writers.publish_messages(fixtures.event_messages(spark, SF), msgs)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 2})
    run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF)
    one_file = stream_table(spark, paths.gold, gold_stream_schema(), max_files=1)
    for q in run_recommendation_inputs(one_file, paths, trigger=NOW):
        q.awaitTermination()
    versions = [d for d in fs.list_dirs(spark, paths.play_counts) if d.startswith("v=")]
    assert len(versions) > 1                       # counts merged over several batches
    plays, users = read_recommendation_inputs(spark, paths)
    gold = _gold(spark, paths)
    exp_plays, exp_users = plays_by_country(gold), active_users(gold)
    assert plays.count() == exp_plays.count() and users.count() == exp_users.count() == 29
    assert plays.exceptAll(exp_plays.select(*plays.columns)).count() == 0
    assert users.exceptAll(exp_users.select(*users.columns)).count() == 0
    # restart: same checkpoints, nothing new, same tables
    gs = stream_table(spark, paths.gold, gold_stream_schema())
    for q in run_recommendation_inputs(gs, paths, trigger=NOW):
        q.awaitTermination()
    plays2, users2 = read_recommendation_inputs(spark, paths)
    assert plays2.exceptAll(plays).count() == 0 and users2.count() == users.count()
    # a fresh checkpoint over the existing counts would restart them at 0
    other = LakePaths(tmp_root)
    other.ckpt = lambda name: f"{tmp_root}/_other_ckpt/{name}"
    with pytest.raises(RuntimeError):
        run_recommendation_inputs(gs, other, trigger=NOW)


def test_continuous_pipeline_starts_on_empty_lake(spark, tmp_root):
    import time
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    writers.publish_messages(fixtures.event_messages(spark, SF), msgs)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs)
    # all stages start at once; the downstream tables do not exist yet
    run_pipeline(spark, raw, paths, trigger={"processingTime": "1 second"}, timeout=1,
                 as_of=lake.FIXED_AS_OF)
    try:
        deadline = time.time() + 120
        n = 0
        while time.time() < deadline:
            try:
                n = _gold(spark, paths).count()
            except Exception:  # noqa: BLE001 - no gold file yet
                n = 0
            if n == 801:
                break
            time.sleep(2)
        assert n == 801
        assert all(q.exception() is None for q in spark.streams.active)
    finally:
        for q in spark.streams.active:
            q.stop()


def _json_step(spark, src, step, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{src}/step={step}")


def test_trend_watermark_drops_late_events(spark, tmp_root):
    from encore.streaming.pipeline import stream_listening_trend
    src, ckpt = f"{tmp_root}/src", f"{tmp_root}/ckpt"
    schema = "event_type string, event_timestamp string"
    got = {}

    def _collect(df, batch_id):
        for r in df.collect():                 # test-only: a handful of window rows
            got[(str(r.time), r.event_type)] = r["count"]

    steps = [[("PLAY", "2024-01-01 10:10:00"), ("PLAY", "2024-01-01 10:20:00")],
             [("PLAY", "2024-01-01 12:30:00")],    # watermark moves to 12:20
             [("PLAY", "2024-01-01 10:30:00")]]    # behind the watermark: dropped
    for i, rows in enumerate(steps):
        _json_step(spark, src, i, rows, schema)
        stream = spark.readStream.schema(schema + ", step int").json(src)
        q = (stream_listening_trend(stream, "1 hour", "10 minutes").writeStream
             .outputMode("update").foreachBatch(_collect).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    assert got == {("2024-01-01 10:00:00", "PLAY"): 2, ("2024-01-01 12:00:00", "PLAY"): 1}


def test_dedupe_within_watermark(spark, tmp_root):
    from encore.streaming.pipeline import dedupe_events
    src, out, ckpt = f"{tmp_root}/src", f"{tmp_root}/out", f"{tmp_root}/ckpt"
    schema = "event_id string, event_time timestamp"
    steps = [[("e1", "2024-01-01 10:00:00"), ("e2", "2024-01-01 10:05:00"),
              ("e2", "2024-01-01 10:06:00")],             # repeat in the same batch
             [("e1", "2024-01-01 10:30:00"), ("e3", "2024-01-01 10:40:00")]]  # repeat later
    for i, rows in enumerate(steps):
        df = spark.createDataFrame(rows, "event_id string, t string")
        df.selectExpr("event_id", "cast(t as timestamp) as event_time").coalesce(1) \
          .write.json(f"{src}/step={i}")
        stream = spark.readStream.schema(schema + ", step int").json(src)
        q = (dedupe_events(stream, "1 hour", "event_time").select("event_id").writeStream
             .format("parquet").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start(out))
        q.awaitTermination()
    ids = sorted(r.event_id for r in spark.read.parquet(out).collect())
    assert ids == ["e1", "e2", "e3"]


@pytest.mark.parametrize("files", [3, 24])
def test_streamed_counts_do_not_depend_on_the_number_of_files(spark, tmp_root, files):
    from encore.sources.readers import stream_table
    from encore.streaming.pipeline import late_rows, stream_listening_trend
    from encore import schemas
    gold = lake.from_tables(spark, SF).gold
    gold.repartition(files).write.partitionBy("event_month").parquet(f"{tmp_root}/gold")
    src = stream_table(spark, f"{tmp_root}/gold", schemas.GOLD, max_files=2)
    q = (stream_listening_trend(src).writeStream.outputMode("complete").format("memory")
         .queryName(f"trend_{files}").option("checkpointLocation", f"{tmp_root}/c")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert late_rows(q) == 0
    assert spark.table(f"trend_{files}").agg(F.sum("count")).first()[0] == 801


def test_pipeline_removes_repeated_events(spark, tmp_root):
    paths = LakePaths(tmp_root)
    msgs = f"{tmp_root}/msgs"
    both = fixtures.event_messages(spark, SF).unionByName(fixtures.repeated_messages(spark, SF))
    writers.publish_messages(both, msgs)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    raw = event_stream(spark, fmt="text", path=msgs, options={"maxFilesPerTrigger": 2})
    run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF, dedupe_delay="62 days")
    got = _gold(spark, paths)
    assert got.count() == 801 == got.select("event_id").distinct().count()


def test_late_rows_fail_a_catch_up_run(spark, tmp_root):
    from encore.sources.readers import stream_table
    from encore.streaming.pipeline import dedupe_events, refuse_late_rows
    for day in (20, 1, 2):      # written in this order, one file a day
        spark.createDataFrame([(f"e{day}", f"2024-01-{day:02d} 00:00:00")], "event_id string, t string") \
            .selectExpr("event_id", "cast(t as timestamp) as event_time") \
            .coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
        __import__("time").sleep(1.1)   # files are taken by modification time
    src = stream_table(spark, f"{tmp_root}/in", "event_id string, event_time timestamp", max_files=1)
    q = (dedupe_events(src, "1 hour").writeStream.format("parquet")
         .option("checkpointLocation", f"{tmp_root}/c").trigger(availableNow=True).start(f"{tmp_root}/out"))
    q.awaitTermination()
    with pytest.raises(RuntimeError, match="later than the watermark"):
        refuse_late_rows(q)
