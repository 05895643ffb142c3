"""X10 with late rows kept: nothing is lost, nothing comes twice."""

import random

import pytest
from pyspark.sql import functions as F

from encore import schemas
from encore.operators.dims import build_dim_songs, build_dim_users, upsert_table
from encore.plans import lake, streams
from encore.sources import fixtures
from encore.sources.readers import event_stream, stream_table
from encore.streaming.late import first_arrivals, millis, rocksdb_state, run_first_arrivals, settle_late
from encore.streaming.pipeline import LakePaths, run_pipeline

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


@pytest.fixture()
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def valid_rows(spark, rows):
    """(event_id, minute or None) as valid events."""
    return spark.createDataFrame(rows, "event_id string, minute long").select(
        "event_id", F.lit(1).alias("user_id"), F.lit("s").alias("song_id"),
        F.coalesce(F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("minute") * 60), "yyyy-MM-dd HH:mm:ss"),
                   F.lit("soon")).alias("timestamp"),
        F.lit("PLAY").alias("event_type"), F.lit(None).cast("timestamp").alias("ingestion_time"),
        F.lit("x").alias("source"))


def land(spark, path, files):
    """One file for each list of rows, taken in this order by a file stream."""
    import os
    for k, rows in enumerate(files):
        folder = f"{path}/{k:04d}"
        valid_rows(spark, rows).coalesce(1).write.parquet(folder)
        for name in os.listdir(folder):
            os.utime(os.path.join(folder, name), (1_700_000_000 + k, 1_700_000_000 + k))
    return f"{path}/*"


def tables(spark, paths):
    def ids(path):
        return sorted((r.event_id, r.timestamp) for r in spark.read.schema(schemas.BRONZE_VALID).parquet(path).collect())
    return ids(paths.bronze_unique), ids(paths.bronze_late)


def minute(m):
    return f"2024-01-{1 + m // 1440:02d} {m // 60 % 24:02d}:{m % 60:02d}:00"


def test_first_arrivals_late_rows_and_repeats(spark, tmp_root, one_partition):
    files = [
        [("a", 0), ("a", 0), ("b", 100), ("q", None)],       # a repeat in one batch, a time that does not parse
        [("c", 300), ("b", 100)],                            # a known repeat
        [("d", 299), ("late", 10), ("late", 10), ("b", 100), ("c", 300)],
        [("late", 10), ("late2", 5), ("e", 1000)],
        [("late2", 5), ("a", 0), ("f", 1001), ("e", 1000), ("b", 1002)],
    ]
    paths = LakePaths(tmp_root)
    src = stream_table(spark, land(spark, f"{tmp_root}/in", files), schemas.BRONZE_VALID, max_files=1)
    run_first_arrivals(src, paths, "1 hour", NOW, buckets=3).awaitTermination()
    unique, late = tables(spark, paths)
    # b at 1002 is a new event of an id that was forgotten long before
    assert unique == sorted([("a", minute(0)), ("b", minute(100)), ("b", minute(1002)), ("c", minute(300)),
                             ("d", minute(299)), ("e", minute(1000)), ("f", minute(1001)), ("q", "soon")])
    assert late == sorted([("late", minute(10)), ("late", minute(10)), ("late2", minute(5)), ("late2", minute(5)),
                           ("a", minute(0)), ("b", minute(100))])    # forgotten, so they might be first arrivals
    assert settle_late(spark, paths) and not settle_late(spark, paths)
    settled, _ = tables(spark, paths)
    assert settled == sorted(unique + [("late", minute(10)), ("late2", minute(5))])


def test_nothing_is_lost_over_many_batches(spark, tmp_root, one_partition):
    """More micro-batches than a query keeps progress reports of."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    r = random.Random(5)
    line = sorted(((m + r.randrange(0, 240), f"e{k}", m) for k, m in enumerate(r.randrange(6000) for _ in range(1500))))
    line += [(at + r.randrange(0, 500), i, m) for at, i, m in r.sample(line, 400)]
    line.sort()
    files = [[(i, m) for _, i, m in line[k:k + 100]] for k in range(0, len(line), 100)]
    assert len(files) == 19
    paths = LakePaths(tmp_root)
    src = stream_table(spark, land(spark, f"{tmp_root}/in", files), schemas.BRONZE_VALID, max_files=1)
    try:
        q = run_first_arrivals(src, paths, "90 minutes", NOW, buckets=2)
        q.awaitTermination()
        assert len(q.recentProgress) <= 6 and q.lastProgress["batchId"] >= 18
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    unique, late = tables(spark, paths)
    every = {(i, minute(m)) for _, i, m in line}
    assert len(late) > 5 and len(set(unique)) == len(unique) == len({i for i, _ in unique})
    assert set(unique) | set(late) == every
    assert settle_late(spark, paths)
    assert tables(spark, paths)[0] == sorted(every)
    # Spans that the watermark has passed are forgotten.
    rows = spark.read.format("statestore").option("path", paths.ckpt("unique")).option("stateVarName", "seen") \
        .load().count()
    assert rows < 300


def test_pipeline_with_late_rows_settled(spark, tmp_root):
    paths = LakePaths(tmp_root)
    upsert_table(build_dim_users(fixtures.users_landing(spark, SF)), paths.dim_users, ["user_id"])
    upsert_table(build_dim_songs(fixtures.songs_landing(spark, SF)), paths.dim_songs, ["song_id"])
    streams.land_disordered(spark, SF, f"{tmp_root}/msgs", files=4)

    def run():
        raw = event_stream(spark, fmt="text", path=f"{tmp_root}/msgs", options={"maxFilesPerTrigger": 1})
        run_pipeline(spark, raw, paths, trigger=NOW, as_of=lake.FIXED_AS_OF, dedupe_delay="6 hours",
                     max_files=2)
        return spark.read.parquet(paths.gold)

    first = run()
    n = first.count()
    assert n < 801 and n == first.select("event_id").distinct().count()
    assert settle_late(spark, paths)
    batch = lake.from_tables(spark, SF).gold.drop("processed_at")
    whole = run().select(*batch.columns)
    assert whole.count() == 801 and whole.exceptAll(batch).count() == 0


def test_delay_and_provider(spark):
    assert millis(spark, "62 days") == 62 * 86_400_000 and millis(spark, "1 hour") == 3_600_000
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before
    stream = spark.readStream.format("rate").load().selectExpr("timestamp as event_time", "cast(value as string) as event_id")
    assert first_arrivals(stream, "1 hour").columns == ["event_id", "late"]


class Handle:
    """State of one bucket in memory, counting what is written."""

    def __init__(self):
        self.values, self.timers, self.writes = {}, set(), 0

    def getMapState(self, name, key, value):
        return self

    def iterator(self):
        return iter([(k, v) for k, v in self.values.items()])

    def updateValue(self, key, value):
        self.writes += 1
        self.values[key] = value

    def removeKey(self, key):
        del self.values[key]

    def registerTimer(self, due):
        self.timers.add(due)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_a_bucket_writes_spans_not_ids():
    from pyspark.sql import Row

    from encore.streaming.late import FirstArrivals
    row = Row("event_id", "_event_millis")
    p, h = FirstArrivals(["event_id"], "event_id", 100), Handle()
    p.init(h)

    def batch(ids, now):
        return [(r.event_id, r.late) for r in p.handleInputRows((0,), (row(f"e{i}", i) for i in ids), At(now))]

    assert batch([*range(1000), *range(1000)], 0) == [(f"e{i}", False) for i in range(1000)]
    assert h.writes == len(h.values) == len(h.timers) == 10
    assert batch(range(1000), 50) == []
    assert batch(range(940, 1005), 60) == [(f"e{i}", False) for i in range(1000, 1005)]
    assert len(h.values[(1100,)][0]) == 100 and len(h.values[(1200,)][0]) == 5 and h.writes == 11
    assert [*p.handleExpiredTimer((0,), At(1100), At(1100))] == [] and (1100,) not in h.values
    assert batch([999, 1004], 1101) == [("e999", True)]
    # one more of a span that is held keeps the others
    assert batch([1050], 1050) == [("e1050", False)]
    assert len(h.values[(1200,)][0]) == 6
