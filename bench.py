"""Benchmark: builds the lake from the test tables, then runs the headline
queries against the written gold table, and prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full with the no-op sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from encore import schemas  # noqa: E402
from encore.operators.gold import gold_layout  # noqa: E402
from encore.operators.sessions import sessions  # noqa: E402
from encore.operators.sketches import listener_sketches  # noqa: E402
from encore.plans import catalog, dashboard, insights, lake, ml, recommend, streams  # noqa: E402
from encore.session import get_session, scratch_path  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app="encore-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    # Warm-up (JVM, class loading), not timed.
    _run(catalog.q_total_plays(spark, sf_dir))

    gold_path = scratch_path(spark, "bench-gold")
    timed("build_gold", lambda: gold_layout(lake.from_tables(spark, sf_dir).gold)
          .write.partitionBy("event_month").parquet(gold_path))
    gold = spark.read.schema(schemas.GOLD).parquet(gold_path)

    plans = {
        "total_plays": lambda: dashboard.total_plays(gold),
        "avg_listening_minutes": lambda: dashboard.avg_listening_minutes(gold),
        "top_songs": lambda: dashboard.top_songs(gold, 5),
        "genre_distribution": lambda: dashboard.genre_distribution(gold),
        "listening_trend": lambda: dashboard.listening_trend(
            gold, catalog.TREND_INTERVAL, catalog.TREND_FROM, catalog.TREND_TO),
        "country_distribution": lambda: dashboard.country_distribution(gold, 10),
        "recent_users": lambda: dashboard.recent_users(gold, 20),
        "recommendations": lambda: recommend.recommendation_rows(
            recommend.recommend(gold, 3, as_of=lake.FIXED_AS_OF)),
        "user_engagement": lambda: insights.user_engagement(gold),
        "daily_volume": lambda: insights.daily_volume(gold),
        "platform_growth": lambda: insights.platform_growth(gold),
        "listening_sessions": lambda: sessions(gold),
        "listener_sketches": lambda: listener_sketches(gold),
        "silver_point_in_time": lambda: catalog.q_silver_point_in_time(spark, sf_dir),
    }
    for name, fn in plans.items():
        timed(name, lambda fn=fn: _run(fn()))
    recs_path = scratch_path(spark, "bench-recs")
    catalog.recommendation_table(gold).write.parquet(recs_path)
    recs = spark.read.schema(schemas.RECOMMENDATIONS).parquet(recs_path)
    more = {
        "latest_recommendations": lambda: dashboard.latest_recommendations(recs),
        "recommendation_engagement": lambda: insights.recommendation_engagement(recs, gold),
        "als_recommend": lambda: ml.als_recommend(gold, 3),
        "streaming_pipeline": lambda: streams.streaming_gold(spark, sf_dir),
        "streaming_trend": lambda: streams.streaming_trend(spark, sf_dir),
        "streaming_dedupe": lambda: streams.streaming_dedupe(spark, sf_dir),
        "recommendations_incremental": lambda: streams.recommendations_incremental(spark, sf_dir),
    }
    for name, fn in more.items():
        timed(name, lambda fn=fn: _run(fn()))

    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
