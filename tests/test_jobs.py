from pyspark.sql import functions as F

from encore import jobs
from encore.plans.dashboard import latest_recommendations
from encore.sinks import writers
from encore.sources import fixtures
from encore.sources.readers import read_table
from encore.streaming.pipeline import LakePaths

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark, tmp_root):
    land = f"{tmp_root}/landing"
    writers.land_songs(fixtures.songs_landing(spark, SF), f"{land}/songs", "20240101_000000")
    writers.land_users(fixtures.users_landing(spark, SF), f"{land}/users")
    writers.publish_messages(fixtures.event_messages(spark, SF), f"{land}/messages")
    jobs.dimension_job(spark, tmp_root, f"{land}/songs/*", f"{land}/users")
    paths = LakePaths(tmp_root)
    assert read_table(spark, paths.dim_users).count() == fixtures.users_landing(spark, SF).count()
    # re-running the dimension job publishes an identical new version
    jobs.dimension_job(spark, tmp_root, f"{land}/songs/*", f"{land}/users")
    assert read_table(spark, paths.dim_songs).count() == fixtures.songs_landing(spark, SF).count()
    jobs.streaming_job(spark, tmp_root, "text", source_path=f"{land}/messages",
                       trigger={"availableNow": True}, recommendation_inputs=True)
    assert spark.read.parquet(paths.gold).count() == 801
    jobs.recommendation_job(spark, tmp_root, as_of="2024-01-31 00:00:00")
    recs = jobs.recommendation_job(spark, tmp_root, as_of="2024-02-01 00:00:00")
    assert recs.count() == 58
    cur = latest_recommendations(recs)
    assert cur.count() == 29
    assert cur.filter(F.col("updated_at") != F.lit("2024-02-01 00:00:00").cast("timestamp")).count() == 0
    # the same generation from the streamed play counts and active users
    inc = jobs.recommendation_job(spark, tmp_root, as_of="2024-02-02 00:00:00", incremental=True)
    gen = F.col("updated_at")
    new = inc.filter(gen == F.lit("2024-02-02 00:00:00").cast("timestamp")).drop("updated_at")
    old = inc.filter(gen == F.lit("2024-02-01 00:00:00").cast("timestamp")).drop("updated_at")
    assert new.count() == 29 and new.exceptAll(old).count() == 0
    # the serving table holds exactly the newest row per user of the history
    from encore.sinks.tables import resolve_current
    paths = LakePaths(tmp_root)
    current = spark.read.parquet(resolve_current(spark, paths.recommendations_current))
    hist = latest_recommendations(inc)
    assert current.count() == 29
    assert current.exceptAll(hist.select(*current.columns)).count() == 0


def test_current_recommendations_newest_per_user(spark, tmp_root):
    from encore.sinks.tables import resolve_current
    root = f"{tmp_root}/current"
    schema = "user_id int, user_name string, recommended_songs array<string>, updated_at timestamp"

    def gen(rows):
        return spark.createDataFrame(rows, "user_id int, user_name string, "
                                           "recommended_songs array<string>, t string") \
            .selectExpr("user_id", "user_name", "recommended_songs",
                        "cast(t as timestamp) as updated_at")

    def current():
        df = spark.read.schema(schema).parquet(resolve_current(spark, root))
        return {r.user_id: (r.recommended_songs, str(r.updated_at)) for r in df.collect()}

    jobs.publish_current_recommendations(spark, gen([(1, "a", ["x"], "2024-01-01 01:00:00"),
                                                     (2, "b", ["y"], "2024-01-01 01:00:00")]), root)
    jobs.publish_current_recommendations(spark, gen([(1, "a", ["z"], "2024-01-01 02:00:00")]), root)
    assert current() == {1: (["z"], "2024-01-01 02:00:00"), 2: (["y"], "2024-01-01 01:00:00")}
    # a backfilled, older generation does not replace newer rows
    jobs.publish_current_recommendations(spark, gen([(1, "a", ["old"], "2024-01-01 00:30:00")]), root)
    assert current()[1] == (["z"], "2024-01-01 02:00:00")
