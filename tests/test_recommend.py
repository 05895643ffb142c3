import datetime as dt

from encore.plans import recommend as R
from encore.schemas import GOLD


def _gold(spark, rows):
    full = []
    for i, (uid, name, country, song, artist, et) in enumerate(rows):
        full.append((f"e{i}", uid, name, "s", song, artist, "g", "Free", country, et,
                     dt.datetime(2024, 1, 1, 0, 0, i), None, 202401))
    return spark.createDataFrame(full, GOLD)


ROWS = [
    (1, "a", "EG", "x", "X", "PLAY"), (1, "a", "EG", "x", "X", "PLAY"),
    (1, "a", "EG", "y", "Y", "PLAY"), (2, "b", "EG", "z", "Z", "PLAY"),
    (2, "b", "EG", "w", "W", "PLAY"), (2, "b", "EG", "w", "W", "SKIP"),
    (3, "c", "US", "q", "Q", "PLAY"),
    (4, "d", "NONE", "q", "Q", "SKIP"),  # country without plays -> fallback
    (0, "z", "EG", "x", "X", "PLAY"),    # user 0 is not recommended to
    (5, "", "EG", "x", "X", "PLAY"),     # empty name neither
]


def test_top_n_per_country_and_fallback(spark):
    recs = {r.user_id: r.recommended_songs for r in
            R.recommend(_gold(spark, ROWS), n=3, as_of="2024-02-01 00:00:00").collect()}
    assert set(recs) == {1, 2, 3, 4}
    assert recs[1] == ["x - X", "w - W", "y - Y"]
    assert recs[3] == ["q - Q"]
    # first rows of the (country, plays desc) list: all of EG's top 3
    assert recs[4] == ["x - X", "w - W", "y - Y"]
    assert all(len(v) <= 3 for v in recs.values())


def test_global_fallback(spark):
    recs = {r.user_id: r.recommended_songs for r in
            R.recommend(_gold(spark, ROWS), n=2, fallback="global").collect()}
    # x has 4 plays; w, q, y, z tie at 1 and break by name
    assert recs[4] == ["x - X", "q - Q"]


def test_no_plays_no_output(spark):
    rows = [(1, "a", "EG", "x", "X", "SKIP")]
    assert R.recommend(_gold(spark, rows)).count() == 0
    assert R.recommend(spark.createDataFrame([], GOLD)).count() == 0
