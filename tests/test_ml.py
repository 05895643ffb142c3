from encore.plans.ml import dense_ids


def test_dense_ids_are_unique_and_contiguous(spark):
    keys = spark.range(0, 1000, numPartitions=7).selectExpr("concat('k', id % 300) as k")
    ids = dense_ids(keys, "k").collect()
    assert len(ids) == 300
    assert sorted(r.idx for r in ids) == list(range(300))
    assert len({r.k for r in ids}) == 300


def test_als_recommends_unheard_candidates(spark):
    from encore.plans import lake
    from encore.plans.ml import als_recommend, candidates, user_song_plays
    gold = lake.from_tables(spark, "/root/testdata/sf0.001").gold
    played = {}
    for r in gold.filter("event_type = 'PLAY'").select("user_id", "song_id").distinct().collect():
        played.setdefault(r.user_id, set()).add(r.song_id)
    offered = {}
    for r in candidates(user_song_plays(gold)).collect():
        offered.setdefault(r.user_id, set()).add(r.song_id)
    n = 3
    by_user = {}
    for r in als_recommend(gold, n=n).collect():
        by_user.setdefault(r.user_id, []).append(r)
    assert by_user and set(by_user) == set(offered)
    for u, recs in by_user.items():
        recs.sort(key=lambda r: r.rank)
        songs = {r.song_id for r in recs}
        assert [r.rank for r in recs] == list(range(1, min(n, len(offered[u])) + 1))
        assert all(a.score >= b.score for a, b in zip(recs, recs[1:]))
        assert len(songs) == len(recs) and songs <= offered[u] and not songs & played[u]


def test_factor_blocks_follow_the_counts(spark):
    """Not the shuffle partitions: each user block sends to each item block."""
    from encore.plans.ml import _fitted, factor_blocks

    assert [factor_blocks(n) for n in (0, 2_000_000, 2_000_001)] == [10, 10, 11]
    gold = spark.createDataFrame(
        [("PLAY", u, "EG", f"s{(u * k) % 7}") for u in range(20) for k in range(3)],
        "event_type string, user_id int, country string, song_id string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        _, _, model = _fitted(gold, 2, 1, 0.1, 1.0, 42)
        assert model.userFactors.rdd.getNumPartitions() == model.itemFactors.rdd.getNumPartitions() == 10
        assert model.userFactors.count() == 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
