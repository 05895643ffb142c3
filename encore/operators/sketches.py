"""Stored per-day summaries that answer range questions without reading the
events again: mergeable cardinality sketches (G4, G11) and daily leaders whose
bounds prove a ranking complete (T1, Q4, G1)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions import song_label
from encore.operators.topn import top_k, top_n_per_group

#: 2^LG_K registers of a sketch: at most 4 KB, standard error 1.04 / sqrt(2^LG_K) = 1.6 %.
LG_K = 12


def error_bound(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Relative error that an estimate stays within (three standard errors:
    99.7 % of estimates). Small sets are counted exactly."""
    return sigmas * 1.04 / math.sqrt(1 << lg_k)


def listener_sketches(gold: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """day, country, users: a sketch of the distinct users of each day and
    country. One partial aggregation; a row is at most 2^lg_k bytes, so the
    table grows with days x countries, not with events. New days are
    appended; a day loaded twice may be merged twice without harm."""
    return gold.filter("user_id is not null").groupBy(
        F.to_date("event_timestamp").alias("day"), "country").agg(
        F.hll_sketch_agg("user_id", lg_k).alias("users"))


def listeners_between(sketches: DataFrame, first: str | Column, last: str | Column,
                      by: list[str] | None = None) -> DataFrame:
    """Estimated distinct users from day ``first`` to ``last`` (both
    included), in all or per column of ``by`` (country): ``listeners``."""
    first, last = (F.lit(d).cast("date") if isinstance(d, str) else d for d in (first, last))
    some = sketches.filter((F.col("day") >= first) & (F.col("day") <= last))
    return some.groupBy(*(by or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("listeners"))


def daily_song_plays(gold: DataFrame) -> DataFrame:
    """day, song, plays: PLAY counts of each day. Grows with days x songs."""
    plays = gold.filter((F.col("event_type") == "PLAY") & (F.col("song_name") != ""))
    return plays.groupBy(F.to_date("event_timestamp").alias("day"),
                         song_label("song_name", "artist_name").alias("song")).agg(F.count("*").alias("plays"))


def daily_leaders(daily: DataFrame, m: int) -> DataFrame:
    """The ``m`` most played songs of each day, with ``rest``: the most plays
    that any other song of that day can have (the m-th count, or 0 where the
    day has fewer songs)."""
    top = top_n_per_group(daily, ["day"], [F.col("plays").desc(), F.col("song").asc()], m)
    rest = top.filter(F.col("rank") == m).select("day", F.col("plays").alias("rest"))
    return top.join(rest, "day", "left").select("day", "song", "plays", F.coalesce("rest", F.lit(0)).alias("rest"))


def top_songs_of_days(daily: DataFrame, leaders: DataFrame, k: int, first: str, last: str) -> tuple[DataFrame, bool]:
    """(song, plays of the ``k`` most played songs from ``first`` to ``last``,
    proven). Only songs that lead some day are counted exactly. A song that
    leads none has at most the sum of the days' ``rest``; if the k-th counted
    song has more, no other song can belong to the ranking, and it is proven.
    Otherwise the leaders are too few for this range: see :func:`top_songs_between`."""
    days = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    some = leaders.filter(days)
    named = some.select("song").distinct()
    counted = (daily.filter(days).join(named, "song", "left_semi").groupBy("song")
               .agg(F.sum("plays").alias("plays")))
    best = top_k(counted, [F.col("plays").desc(), F.col("song").asc()], k)
    bound = some.groupBy("day").agg(F.max("rest").alias("rest")).agg(F.coalesce(F.sum("rest"), F.lit(0)).alias("rest"))
    # No more than k rows and one number reach the driver.
    counts = [r["plays"] for r in best.collect()]
    rest = bound.first()["rest"]
    return best, rest == 0 or (len(counts) == k and counts[-1] > rest)


def top_songs_between(daily: DataFrame, leaders: DataFrame, k: int, first: str, last: str) -> tuple[DataFrame, bool]:
    """The ranking from the leaders where they prove it, from all daily counts
    where they do not; and whether the leaders were enough."""
    best, proven = top_songs_of_days(daily, leaders, k, first, last)
    if not proven:
        days = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        whole = daily.filter(days).groupBy("song").agg(F.sum("plays").alias("plays"))
        best = top_k(whole, [F.col("plays").desc(), F.col("song").asc()], k)
    return best, proven
