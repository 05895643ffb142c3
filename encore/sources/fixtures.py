"""Mapping of the driver's test tables onto this library's input shapes.

events   -> JSON event messages (the upstream message format)
customer x nation -> users landing rows (all text, like the landing CSV)
part     -> songs landing rows
part     -> chart pages (nested tracks)

The mapping is chosen so that every branch occurs: signup events carry no
song (invalid), some events name users and songs outside the dimensions (Guest
/ Unknown), and user 8 lives in a country without plays (fallback list). All
customers and parts are landed.
Everything stays a lazy DataFrame over the given tables, so the work grows
with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions import to_message
from encore.sources.readers import spread

# Fixed values of the test mapping.
SONG_PREFIX = "song_"
NO_PLAY_USER = 8
NO_PLAY_COUNTRY = "NO_PLAY"
PREMIUM_SEGMENTS = ["FURNITURE", "MACHINERY"]
TRACKS_PER_PAGE = 100
STRANGER_OFFSET = 100_000_000   # added to the user of every tenth event
STRANGE_SONG = "lost_"          # song prefix of every seventh event


# Column types of the driver's test tables, for the columns
# this mapping reads. A declared schema also skips the footer-inference job
# Spark runs for every schemaless parquet read.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events in the message shape (timestamp still a timestamp)."""
    ev = spread(table(spark, sf_dir, "events"))
    et = F.col("event_type")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_id") % 10 == 9, F.col("user_id") + STRANGER_OFFSET)
         .otherwise(F.col("user_id")).cast("int").alias("user_id"),
        F.when(et == "signup", F.lit(None).cast("string"))
         .otherwise(F.concat(F.when(F.col("event_id") % 7 == 6, F.lit(STRANGE_SONG))
                             .otherwise(F.lit(SONG_PREFIX)), F.get_json_object("props", "$.k")))
         .alias("song_id"),
        F.col("ts"),
        F.when((F.col("user_id") == NO_PLAY_USER) | (et == "error"), F.lit("SKIP"))
         .when(et == "click", F.lit("LIKE"))
         .otherwise(F.lit("PLAY")).alias("event_type"),
        F.floor("value").cast("int").alias("duration_seconds"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary JSON messages, one per event (the raw stream payload)."""
    ev = raw_events(spark, sf_dir).withColumn(
        "timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    msg = to_message("event_id", "user_id", "song_id", "timestamp", "event_type",
                     "duration_seconds")
    return ev.select(msg.cast("binary").alias("value"))


def repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of every fifth event once more (published twice)."""
    ev = raw_events(spark, sf_dir).filter(F.col("event_id").cast("long") % 5 == 0).withColumn(
        "timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    msg = to_message("event_id", "user_id", "song_id", "timestamp", "event_type",
                     "duration_seconds")
    return ev.select(msg.cast("binary").alias("value"))


def faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One faulty message for some events, by event_id mod 50: 0 bad time,
    1 no type, 2 not JSON, 3 user id as text, 4 a repeated id, 5 user id -1,
    6 unknown type. Ids other than the repeated one get the suffix 'f'."""
    k = F.col("event_id") % 50
    ev = spread(table(spark, sf_dir, "events")).filter(k <= 6)
    eid = F.col("event_id").cast("string")
    q = F.lit('"')
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    user = F.when(k == 3, F.concat(q, F.col("user_id").cast("string"), q)) \
        .when(k == 5, F.lit("-1")).otherwise(F.col("user_id").cast("string"))
    kind = F.when(k == 1, F.lit("null")).when(k == 6, F.lit('"DANCE"')).otherwise(F.lit('"PLAY"'))
    text = F.concat(
        F.lit('{"event_id":"'), F.when(k == 4, eid).otherwise(F.concat(eid, F.lit("f"))),
        F.lit('","user_id":'), user, F.lit(',"song_id":" song_1 ","timestamp":"'),
        F.when(k == 0, F.lit("soon")).otherwise(stamp), F.lit('","event_type":'), kind, F.lit("}"))
    text = F.when(k == 2, F.concat(F.lit("not json "), eid)).otherwise(text)
    return ev.select(text.cast("binary").alias("value"))


def users_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as landed text rows."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)  # nation: 25 rows, auto-broadcast
    return j.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("user_name"),
        F.when(F.col("c_custkey") == NO_PLAY_USER, F.lit(NO_PLAY_COUNTRY))
         .otherwise(F.col("n_name")).alias("country"),
        F.when(F.col("c_mktsegment").isin(PREMIUM_SEGMENTS), F.lit("Premium"))
         .otherwise(F.lit("Free")).alias("subscription_type"),
        F.lit("2024-01-01T00:00:00").alias("ingested_at"),
    )


def songs_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs as landed rows."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit(SONG_PREFIX), F.col("p_partkey").cast("string")).alias("song_id"),
        F.col("p_name").alias("song_name"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.col("p_name"), F.lit(" - Single")).alias("album_name"),
        F.col("p_size").cast("long").alias("duration_ms"),
        F.col("p_type").alias("genre"),
        F.lit("2024-01-01T00:00:00").alias("ingested_at"),
    )


def chart_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat chart tracks (the rows inside landed pages): name, mbid, artist.
    Parts of size divisible by 3 have no catalogue id, size 1 has an empty
    artist name and size 2 no name at all (corrupt records)."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("rank_key"),
        F.when(size == 2, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("name"),
        F.when(size % 3 == 0, F.lit("")).otherwise(
            F.concat(F.lit("mb-"), F.col("p_partkey").cast("string"))).alias("mbid"),
        F.struct(F.when(size == 1, F.lit("")).otherwise(F.col("p_brand")).alias("name"))
         .alias("artist"),
    )


def chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart pages: ``TRACKS_PER_PAGE`` tracks nested per page (bounded
    groups), in the landed JSON shape."""
    t = chart_tracks(spark, sf_dir)
    page = F.floor((F.col("rank_key") - 1) / TRACKS_PER_PAGE).alias("page")
    return (t.groupBy(page)
             .agg(F.sort_array(F.collect_list(F.struct("rank_key", "name", "mbid", "artist")))
                  .alias("ts"))
             .select("page", F.struct(F.transform(
                 "ts", lambda x: F.struct(x["name"].alias("name"), x["mbid"].alias("mbid"),
                                          x["artist"].alias("artist"))).alias("track"))
                 .alias("tracks")))


def user_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed version of the users: all on January 1; every third moved
    on the 10th; a third landed again unchanged on the 12th; every fifth got
    a Premium subscription on the 20th at noon (movers as moved)."""
    first = users_landing(spark, sf_dir)
    k = F.col("user_id").cast("long")
    moved = F.when(k % 3 == 0, F.lit("MOVED")).otherwise(F.col("country"))

    def landed(rows: DataFrame, at: str) -> DataFrame:
        return rows.withColumn("ingested_at", F.lit(at))

    return (first
            .unionByName(landed(first.filter(k % 3 == 0).withColumn("country", moved), "2024-01-10T00:00:00"))
            .unionByName(landed(first.filter(k % 3 == 1), "2024-01-12T00:00:00"))
            .unionByName(landed(first.filter(k % 5 == 0).withColumn("country", moved)
                                .withColumn("subscription_type", F.lit("Premium")), "2024-01-20T12:00:00")))


def song_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed version of the songs: every seventh first landed on
    January 5, all others on the 1st; every fourth was renamed on the 15th."""
    k = F.substring("song_id", len(SONG_PREFIX) + 1, 20).cast("long")
    first = songs_landing(spark, sf_dir).withColumn(
        "ingested_at", F.when(k % 7 == 0, F.lit("2024-01-05T00:00:00")).otherwise(F.col("ingested_at")))
    renamed = first.filter(k % 4 == 0).withColumn("song_name", F.concat("song_name", F.lit(" (remaster)")))
    return first.unionByName(renamed.withColumn("ingested_at", F.lit("2024-01-15T06:00:00")))
