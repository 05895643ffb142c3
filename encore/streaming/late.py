"""X10 with nothing lost: duplicate removal in which rows behind the watermark
go to a table of their own instead of being dropped.

A watermark operator of Spark drops late rows before any user code sees them.
Here the watermark column is left out of the grouped rows (its value goes on
as plain milliseconds), so the query still advances the watermark but filters
nothing, and a keyed stateful processor decides: an id that it knows is a
repeat, an unknown id in time is a first arrival, an unknown id behind the
watermark is late, since its first arrival may have been forgotten.

Ids are kept in hashed buckets, not one by one: a bucket holds one array of ids
for each span of event time, read and written once per micro-batch, and a
timer drops a span whole, so the cost per row is that of a Python set and
not of a state-store call. ``buckets`` is
fixed for the life of a checkpoint; size it so that a bucket holds some
thousands of ids within the delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from encore import schemas
from encore.operators.dims import latest_per_key
from encore.sinks import fs, writers
from encore.sinks.tables import published_batches
from encore.streaming.pipeline import LakePaths, guard_checkpoint

BUCKETS = 256
#: Settled late rows are published behind all batches of the stream.
SETTLED_FROM = 1 << 40
_MILLIS, _BUCKET = "_event_millis", "_id_bucket"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class FirstArrivals(StatefulProcessor):
    """Of each event id, the first row within ``delay`` ms, marked late when
    it came behind the watermark. Of equal ids in one micro-batch the earliest
    counts, so a repeated batch decides the same."""

    def __init__(self, columns: list[str], id_col: str, delay: int):
        self.columns, self.id_col, self.delay = columns, id_col, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState(
            "seen", T.StructType([T.StructField("due", T.LongType())]),
            T.StructType([T.StructField("ids", T.ArrayType(T.StringType())),
                          T.StructField("until", T.ArrayType(T.LongType()))]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = max(0, timerValues.getCurrentWatermarkInMs())
        spans = {due: (list(ids), list(until)) for (due,), (ids, until) in self.seen.iterator()}
        known = {i for ids, until in spans.values() for i, u in zip(ids, until) if u >= now}
        first: dict[str, tuple] = {}
        for r in rows:
            i = r[self.id_col]
            if i in known:
                continue
            # A time that does not parse counts as the present.
            at = now if r[_MILLIS] is None else r[_MILLIS]
            held, mine = first.get(i), (at < now, at)
            if held is None or mine < held[:2] or mine == held[:2] and str(r) < str(held[2]):
                first[i] = (*mine, r)
        fresh: dict[int, tuple] = {}
        for i, (late, at, _) in first.items():
            if not late:
                until = at + self.delay
                ids, untils = fresh.setdefault((until // self.delay + 1) * self.delay, ([], []))
                ids.append(i)
                untils.append(until)
        for due, (ids, untils) in fresh.items():
            if due in spans:
                ids, untils = spans[due][0] + ids, spans[due][1] + untils
            else:
                self.handle.registerTimer(due)     # behind every ``until`` of the span
            self.seen.updateValue((due,), (ids, untils))
        out = Row(*self.columns, "late")
        for late, _, r in first.values():
            yield out(*[r[c] for c in self.columns], late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.removeKey((expiredTimerInfo.getExpiryTimeInMs(),))
        yield from ()

    def close(self) -> None:
        pass


def millis(spark: SparkSession, delay: str) -> int:
    """Milliseconds of an interval text without months."""
    return spark.sql(f"select unix_millis(timestamp_seconds(0) + interval {delay}) as ms").first()["ms"]


def first_arrivals(events: DataFrame, delay: str, time_col: str = "event_time", id_col: str = "event_id",
                   buckets: int = BUCKETS) -> DataFrame:
    """The rows of a stream without ids repeated within ``delay``, with
    ``late``. Every input row is a first arrival, late, or a known repeat."""
    columns = [f for f in events.schema.fields if f.name != time_col]
    names = [f.name for f in columns]
    rows = (events.withWatermark(time_col, delay)
            .select(*names, F.unix_millis(time_col).alias(_MILLIS),
                    F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int").alias(_BUCKET)))
    out = T.StructType([*columns, T.StructField("late", T.BooleanType())])
    return rows.groupBy(_BUCKET).transformWithState(
        FirstArrivals(names, id_col, millis(events.sparkSession, delay)), out, "Append", "EventTime")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started within use the state store that such processors need."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def unique_schema() -> T.StructType:
    return T.StructType(schemas.BRONZE_VALID.fields + [T.StructField("batch_id", T.LongType())])


def run_first_arrivals(valid_stream: DataFrame, paths: LakePaths, delay: str, trigger=None,
                       buckets: int = BUCKETS):
    """Split valid events into a table of first arrivals and one of late
    rows, each micro-batch published exactly once to both."""
    spark = valid_stream.sparkSession
    guard_checkpoint(spark, paths.ckpt("unique"), paths.bronze_unique)
    names = schemas.BRONZE_VALID.fieldNames()
    timed = valid_stream.select(*names, F.try_to_timestamp("timestamp").alias("event_time"))
    marked = first_arrivals(timed, delay, buckets=buckets)

    def _batch(df: DataFrame, batch_id: int) -> None:
        kept = df.persist()                    # the stateful operator runs once
        try:
            writers.publish_batch(kept.filter("late").drop("late"), paths.bronze_late, batch_id)
            writers.publish_batch(kept.filter("not late").drop("late"), paths.bronze_unique, batch_id)
        finally:
            kept.unpersist()

    w = marked.writeStream.foreachBatch(_batch).option("checkpointLocation", paths.ckpt("unique"))
    if trigger:
        w = w.trigger(**trigger)
    with rocksdb_state(spark):
        return w.start()


def settle(unique: DataFrame, late: DataFrame) -> DataFrame:
    """Late rows that are no repeats after all: unknown to the whole table of
    first arrivals, one row of each id (the earliest)."""
    new = late.join(unique.select("event_id"), "event_id", "left_anti")
    return latest_per_key(new, ["event_id"], [F.col("timestamp").asc_nulls_last()],
                          [F.col(c).asc_nulls_last() for c in ("user_id", "song_id", "event_type")])


def settle_late(spark: SparkSession, paths: LakePaths) -> bool:
    """Publish the settled late rows as one more batch of the first arrivals,
    from where the later stages take them like any other. Settled rows are
    known from then on, so running it again adds nothing. Run it as a job from
    time to time, one at a time. Returns whether anything was published."""
    if not fs.exists(spark, paths.bronze_late):
        return False
    schema = unique_schema()
    unique = spark.read.schema(schema).parquet(paths.bronze_unique)
    late = spark.read.schema(schema).parquet(paths.bronze_late)
    found = settle(unique, late).select(*schemas.BRONZE_VALID.fieldNames()).persist()
    try:
        if found.isEmpty():
            return False
        done = [b for b in published_batches(spark, paths.bronze_unique) if b >= SETTLED_FROM]
        return writers.publish_batch(found, paths.bronze_unique, max(done, default=SETTLED_FROM - 1) + 1)
    finally:
        found.unpersist()
