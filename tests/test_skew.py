from pyspark.sql import functions as F

from encore.operators.enrich import enrich
from encore.operators.skew import find_hot_keys, split_left_join


def _facts(spark):
    # key 1 holds two thirds of all rows; null and unmatched keys included
    return spark.range(3000).selectExpr(
        "id", "case when id % 3 < 2 then 1 when id % 30 = 2 then null else id % 50 end as k")


def test_hot_keys_bounded_and_found(spark):
    f = _facts(spark)
    hot = find_hot_keys(f, {"k": F.col("k"), "m": F.col("id") % 2}, max_hot_keys=3, min_rows=10)
    assert hot["k"] == ["1"]
    assert sorted(hot["m"]) == ["0", "1"]
    big = find_hot_keys(f, {"k": F.col("k")}, max_hot_keys=1000, min_rows=1)["k"]
    assert len(big) <= 1000


def test_split_join_equals_plain_join(spark):
    f = _facts(spark)
    d = spark.range(0, 40).selectExpr("id as dk", "concat('v', id) as v")
    got = split_left_join(f, F.col("k"), d, "dk", max_hot_keys=3, min_rows=10)
    exp = f.join(d, f.k == d.dk, "left").drop("dk")
    assert got.count() == exp.count() == 3000
    assert got.exceptAll(exp.select(*got.columns)).count() == 0


def test_enrich_split_equals_plain(spark):
    ev = spark.range(2000).selectExpr(
        "cast(id as string) event_id",
        "cast(case when id % 4 = 0 then id % 7 else 1 end as int) user_id",
        "case when id % 5 = 0 then ' s1 ' else concat('s', id % 9) end song_id",
        "'2024-01-01 00:00:00' timestamp", "'PLAY' event_type")
    users = spark.range(5).selectExpr("cast(id as int) user_id", "concat('u', id) user_name",
                                      "'EG' country", "'Free' subscription_type")
    songs = spark.range(6).selectExpr("concat('s', id) song_id", "'n' song_name",
                                      "'a' artist_name", "'g' genre")
    a = enrich(ev, users, songs, as_of="2024-02-01 00:00:00")
    b = enrich(ev, users, songs, as_of="2024-02-01 00:00:00", split_hot_keys=True,
               max_hot_keys=2, min_hot_rows=10)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_small_input_has_no_hot_keys(spark):
    # fewer rows than min_rows: no key can be hot, the key count is skipped
    f = _facts(spark)
    assert find_hot_keys(f, {"k": F.col("k")}, max_hot_keys=3, min_rows=10_000) == {"k": []}
