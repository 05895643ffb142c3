"""Model-based recommendations (G14): implicit-feedback ALS on play counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.operators.topn import top_n_per_group
from encore.plans.inner_product import BLOCK, top_inner_products
from encore.session import checkpoint_root, scratch_path

_PART_SHIFT = 33  # monotonically_increasing_id = partition << 33 | row in partition
_BLOCK_RATINGS = 200_000  # (user, song) counts of a factor block


def dense_ids(keys: DataFrame, key: str, id_col: str = "idx") -> DataFrame:
    """Give every distinct ``key`` a dense int id 0..n-1 without moving the
    keys through the driver or into one task: the keys are checkpointed (so
    the numbering is stable on recomputation), each partition's row count
    becomes an offset (one row per partition, so the small table is bounded
    by the partition count), and id = offset + position in the partition."""
    spark = keys.sparkSession
    checkpoint_root(spark)
    base = keys.select(key).distinct().checkpoint(eager=True)
    mid = base.withColumn("_m", F.monotonically_increasing_id())
    part = F.shiftright("_m", _PART_SHIFT)
    counts = mid.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    local = F.col("_m") - F.shiftleft(F.col("_p"), _PART_SHIFT)
    return (mid.withColumn("_p", part).join(F.broadcast(offsets.select("_p", "_off")), "_p")
               .select(key, (F.col("_off") + local).cast("int").alias(id_col)))


def user_song_plays(gold: DataFrame) -> DataFrame:
    """PLAY count per (user_id, country, song_id)."""
    return (gold.filter((F.col("event_type") == "PLAY") & F.col("user_id").isNotNull())
                .groupBy("user_id", "country", "song_id").agg(F.count(F.lit(1)).alias("plays")))


def candidates(plays: DataFrame, k: int = 50) -> DataFrame:
    """(user_id, song_id): of each user's countries, the ``k`` most played songs
    (ties: song_id) that the user has not played, for the heaviest users too.

    A user who has played p songs finds k others within the first k + p places
    of the chart, so those places are fetched: the chart is cut into runs of k
    places, one array each, and a user asks for as many runs as needed (equi-join
    on country and run). The rows follow users x k plus plays, never users x
    songs."""
    chart = (plays.groupBy("country", "song_id").agg(F.sum("plays").alias("plays"))
             .withColumn("place", F.row_number().over(
                 Window.partitionBy("country").orderBy(F.col("plays").desc(), "song_id"))))
    runs = (chart.withColumn("run", F.floor((F.col("place") - 1) / k).cast("long"))
            .groupBy("country", "run").agg(F.collect_list(F.struct("place", "song_id")).alias("songs")))
    heard = plays.groupBy("user_id").agg(F.count_distinct("song_id").alias("heard"))
    users = (plays.select("user_id", "country").distinct().join(heard, "user_id")
             .withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"),
                                                     F.ceil((F.col("heard") + k) / k).cast("long") - 1))))
    offered = (users.join(runs, ["country", "run"]).select("user_id", "country", F.inline("songs"))
               .join(plays.select("user_id", "song_id").distinct(), ["user_id", "song_id"], "left_anti"))
    return (top_n_per_group(offered, ["user_id", "country"], [F.col("place").asc()], k)
            .select("user_id", "song_id").distinct())


def factor_blocks(ratings: int) -> int:
    """Factor blocks for so many ratings. Every user block sends to every item
    block, so their number follows the ratings and not the shuffle partitions,
    of which there are far more."""
    return max(10, -(-ratings // _BLOCK_RATINGS))


def _fitted(gold: DataFrame, rank: int, max_iter: int, reg: float, alpha: float, seed: int):
    """(play counts, item ids, ALS model) of a gold table."""
    from pyspark.ml.recommendation import ALS

    spark = gold.sparkSession
    path = scratch_path(spark, "als-plays")
    user_song_plays(gold).write.parquet(path)
    plays = spark.read.schema("user_id int, country string, song_id string, plays long").parquet(path)
    ids = dense_ids(plays, "song_id", "item")
    data = plays.groupBy("user_id", "song_id").agg(F.sum("plays").cast("float").alias("plays")) \
        .join(ids, "song_id").select("user_id", "item", "plays")
    blocks = factor_blocks(plays.count())
    # ALS cuts and groups the ratings in as many tasks as they come in.
    data = data.repartition(blocks, "user_id")
    model = ALS(userCol="user_id", itemCol="item", ratingCol="plays", implicitPrefs=True,
                rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, seed=seed,
                numUserBlocks=blocks, numItemBlocks=blocks,
                coldStartStrategy="drop", checkpointInterval=2).fit(data)
    return plays, ids, model


def als_recommend(gold: DataFrame, n: int = 3, rank: int = 10, max_iter: int = 5,
                  reg: float = 0.1, alpha: float = 1.0, seed: int = 42, k: int = 50) -> DataFrame:
    """The n best of each user's :func:`candidates` by the preference of an
    implicit ALS model fitted on PLAY counts per (user, song). Returns
    (user_id, rank, song_id, score); no song that the user has played.

    Only candidates are scored: ``model.transform`` joins them to the user
    and song factors on their ids. Scoring every user against every song
    (``recommendForAllUsers``) costs O(users x songs) and is not used. The
    counts are written once and read by the id, fit and candidate steps; the
    number of factor blocks follows the counts. The per-user top n is a window
    group limit, so it ships at most n rows per user and map partition."""
    plays, ids, model = _fitted(gold, rank, max_iter, reg, alpha, seed)
    scored = model.transform(candidates(plays, k).join(ids, "song_id")) \
        .select("user_id", "song_id", F.col("prediction").alias("score"))
    return top_n_per_group(scored, ["user_id"], [F.col("score").desc(), F.col("song_id")], n)


def als_recommend_catalogue(gold: DataFrame, n: int = 3, rank: int = 10, max_iter: int = 5,
                            reg: float = 0.1, alpha: float = 1.0, seed: int = 42,
                            block: int = BLOCK) -> DataFrame:
    """The n best unplayed songs of the whole catalogue for each user by the
    same model, exactly: (user_id, rank, song_id, score, scored), the last being
    how many songs were scored for the user (see :mod:`plans.inner_product`)."""
    plays, ids, model = _fitted(gold, rank, max_iter, reg, alpha, seed)
    items = model.itemFactors.withColumnRenamed("id", "item").join(ids, "item").select("song_id", "features")
    users = model.userFactors.withColumnRenamed("id", "user_id")
    found = top_inner_products(users, "user_id", items, "song_id", n,
                               plays.select("user_id", "song_id").distinct(), block)
    return found.select("user_id", "rank", "song_id", "score", "scored")
