"""Deployable jobs: the dimension batch, the streaming pipeline and the
recommendation batch, over one lake root on shared storage.

    python -m encore.jobs dimensions --lake hdfs:///lake --songs .../songs --users .../users
    python -m encore.jobs stream --lake ... --kafka-servers host:9092 --topic music_events
    python -m encore.jobs recommend --lake ... [--n 3] [--fallback global]
"""

from __future__ import annotations

import argparse
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from encore import schemas
from encore.operators.dims import build_dim_songs, build_dim_users, upsert_table
from encore.plans.dashboard import latest_recommendations
from encore.plans.recommend import recommend, recommend_from
from encore.session import checkpoint_root
from encore.sinks.tables import prune_versions, publish_version, resolve_current, table_exists
from encore.sinks.writers import write_recommendations
from encore.sources.readers import event_stream, read_gold, read_songs, read_users
from encore.streaming.pipeline import LakePaths, read_recommendation_inputs, run_pipeline


def dimension_job(spark: SparkSession, lake: str, songs_path: str, users_path: str,
                  songs_multiline: bool | None = None) -> tuple[str, str]:
    """Landed songs/users -> deduplicated dimensions, upserted and published
    as new versions. Returns the two version paths."""
    paths = LakePaths(lake)
    songs = build_dim_songs(read_songs(spark, songs_path, multiline=songs_multiline))
    users = build_dim_users(read_users(spark, users_path))
    out = (upsert_table(songs, paths.dim_songs, ["song_id"]),
           upsert_table(users, paths.dim_users, ["user_id"]))
    for root in (paths.dim_songs, paths.dim_users):
        prune_versions(spark, root)
    return out


def streaming_job(spark: SparkSession, lake: str, source_format: str = "kafka",
                  source_options: dict | None = None, source_path: str | None = None,
                  trigger: dict | None = None, timeout: float | None = None,
                  single_read: bool = False, recommendation_inputs: bool = False,
                  dedupe_delay: str | None = None, gold_jdbc: dict | None = None) -> None:
    """Messages -> bronze -> silver -> gold until stopped (or to completion
    with ``trigger={'availableNow': True}``). ``recommendation_inputs`` also
    keeps the play counts and active users current from the gold table."""
    raw = event_stream(spark, source_format, source_options, path=source_path)
    run_pipeline(spark, raw, LakePaths(lake), trigger=trigger, timeout=timeout,
                 single_read=single_read,
                 gold_trigger=None if trigger else {"processingTime": "10 seconds"},
                 recommendation_inputs=recommendation_inputs, dedupe_delay=dedupe_delay, gold_jdbc=gold_jdbc,
                 inputs_trigger=None if trigger else {"processingTime": "5 minutes"})


def recommendation_job(spark: SparkSession, lake: str, n: int = 3,
                       fallback: str = "first_country", as_of=None,
                       incremental: bool = False) -> DataFrame:
    """Gold -> one new recommendation generation appended to the
    recommendations table (readers take the newest row per user), and the
    current (newest-per-user) serving table republished.
    ``incremental`` reads the play counts and active users kept current by
    the streaming job (``--recommendation-inputs``) instead of all of gold."""
    paths = LakePaths(lake)
    if as_of is None:  # one time for the history and the serving table
        as_of = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    if incremental:
        plays, users = read_recommendation_inputs(spark, paths)
        recs = recommend_from(plays, users, n=n, fallback=fallback, as_of=as_of)
    else:
        recs = recommend(read_gold(spark, paths.gold), n=n, fallback=fallback, as_of=as_of)
    # Evaluated once: the serving table is made from the generation as written.
    made = f"{checkpoint_root(spark)}/generation-{uuid.uuid4().hex[:12]}"
    write_recommendations(recs, made)
    generation = spark.read.schema(schemas.RECOMMENDATIONS).parquet(made)
    write_recommendations(generation, paths.recommendations)
    publish_current_recommendations(spark, generation, paths.recommendations_current)
    return spark.read.schema(schemas.RECOMMENDATIONS).parquet(paths.recommendations)


def publish_current_recommendations(spark: SparkSession, generation: DataFrame,
                                    root: str) -> str:
    """The serving table: one row per user, the newest one (ties: user_name),
    as readers of the append-only history would pick it. Published as a new
    version from the previous version plus the new generation, so its size
    follows the users, not users x generations; old versions are pruned."""
    gen = generation.select(*schemas.RECOMMENDATIONS.fieldNames())
    if table_exists(spark, root):
        gen = spark.read.schema(schemas.RECOMMENDATIONS).parquet(
            resolve_current(spark, root)).unionByName(gen)
    path = publish_version(latest_recommendations(gen), root)
    prune_versions(spark, root)
    return path


def main(argv=None) -> None:
    from encore.session import get_session

    ap = argparse.ArgumentParser(prog="encore.jobs")
    ap.add_argument("job", choices=["dimensions", "stream", "recommend"])
    ap.add_argument("--lake", required=True)
    ap.add_argument("--songs")
    ap.add_argument("--users")
    ap.add_argument("--songs-json-lines", action="store_true")
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topic", default="music_events")
    ap.add_argument("--messages", help="text-file message source instead of Kafka")
    ap.add_argument("--single-read", action="store_true")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--n", type=int, default=3)
    ap.add_argument("--fallback", default="first_country")
    ap.add_argument("--recommendation-inputs", action="store_true",
                    help="stream: keep play counts / active users current")
    ap.add_argument("--max-offsets", type=int, help="stream: Kafka messages per micro-batch")
    ap.add_argument("--jdbc-url", help="stream: also append gold to this store (needs its driver)")
    ap.add_argument("--jdbc-table", default="realtime_music_events")
    ap.add_argument("--dedupe-delay", help="stream: drop event ids repeated within this time")
    ap.add_argument("--incremental", action="store_true",
                    help="recommend: read the streamed play counts / active users")
    a = ap.parse_args(argv)
    spark = get_session(app=f"encore-{a.job}")
    if a.job == "dimensions":
        dimension_job(spark, a.lake, a.songs, a.users, songs_multiline=False if a.songs_json_lines else None)
    elif a.job == "stream":
        trig = {"availableNow": True} if a.available_now else None
        jdbc = {"url": a.jdbc_url, "dbtable": a.jdbc_table} if a.jdbc_url else None
        if a.messages:
            streaming_job(spark, a.lake, "text", source_path=a.messages, trigger=trig,
                          single_read=a.single_read, dedupe_delay=a.dedupe_delay, gold_jdbc=jdbc,
                          recommendation_inputs=a.recommendation_inputs)
        else:
            streaming_job(spark, a.lake, "kafka",
                          {"kafka.bootstrap.servers": a.kafka_servers, "subscribe": a.topic}
                          | ({"maxOffsetsPerTrigger": str(a.max_offsets)} if a.max_offsets else {}),
                          trigger=trig, single_read=a.single_read, dedupe_delay=a.dedupe_delay, gold_jdbc=jdbc,
                          recommendation_inputs=a.recommendation_inputs)
    else:
        recommendation_job(spark, a.lake, a.n, a.fallback, incremental=a.incremental)


if __name__ == "__main__":
    main()
