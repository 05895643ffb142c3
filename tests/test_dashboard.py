import datetime as dt

from encore.plans import dashboard as D
from encore.plans import insights as I
from encore.schemas import GOLD


def _gold(spark, rows):
    out = []
    for i, (uid, name, song, artist, genre, country, et, ts) in enumerate(rows):
        out.append((f"e{i}", uid, name, "s", song, artist, genre, "Free", country, et, ts, None,
                    ts.year * 100 + ts.month))
    return spark.createDataFrame(out, GOLD)


T = dt.datetime(2024, 1, 1, 10, 0, 0)
ROWS = [
    (1, "a", "x", "X", "pop", "EG", "PLAY", T),
    (1, "a", "x", "X", "pop", "EG", "PLAY", T + dt.timedelta(minutes=30)),
    (2, "b", "y", "Y", "rock", "US", "SKIP", T + dt.timedelta(hours=1)),
    (2, "b", "", "Y", "", "", "PLAY", T + dt.timedelta(hours=2)),
    (3, "c", "z", "Z", "pop", "EG", "LIKE", dt.datetime(2024, 2, 1, 0, 0, 0)),
]


def test_empty_gold(spark):
    g = spark.createDataFrame([], GOLD)
    assert D.total_plays(g).collect()[0].total_plays == 0
    assert D.avg_listening_minutes(g).collect()[0].avg_minutes is None
    assert D.top_songs(g).count() == 0
    assert D.genre_distribution(g).count() == 0


def test_dashboard_values(spark):
    g = _gold(spark, ROWS)
    assert D.total_plays(g).collect()[0].total_plays == 3
    assert abs(D.avg_listening_minutes(g).collect()[0].avg_minutes - (3.5 * 3 + 0.5) / 5) < 1e-12
    assert [tuple(r) for r in D.top_songs(g, 5).collect()] == [("x - X", 2)]
    gd = D.genre_distribution(g).collect()
    assert [r.genre for r in gd] == ["pop", "rock"] and abs(sum(r.share for r in gd) - 1) < 1e-12
    assert [r.country for r in D.country_distribution(g).collect()] == ["EG", "US"]
    assert D.recent_users(g, 1).collect()[0].user_name == "c"


def test_trend_bounds_inclusive_and_bucketed(spark):
    g = _gold(spark, ROWS)
    lo, hi = "2024-01-01 10:00:00", "2024-01-01 12:00:00"
    rows = [(r.time.hour, r.event_type, r["count"]) for r in
            D.listening_trend(g, "1 hour", lo, hi).collect()]
    assert rows == [(10, "PLAY", 2), (11, "SKIP", 1), (12, "PLAY", 1)]


def test_growth_and_quality(spark):
    g = _gold(spark, ROWS)
    pg = [(r.new_users, r.total_users) for r in I.platform_growth(g).collect()]
    assert pg == [(2, 2), (1, 3)]
    ue = {r.user_id: r for r in I.user_engagement(g).collect()}
    assert ue[2].skip_rate == 0.5 and ue[1].distinct_songs == 1


def test_genre_trend_compares_calendar_weeks(spark):
    from encore.plans.insights import genre_trend
    rows = [("PLAY", "g", t) for t in ("2024-01-01 10:00:00", "2024-01-02 10:00:00", "2024-01-22 10:00:00",
                                       "2024-01-29 10:00:00", "2024-01-30 10:00:00")]
    gold = spark.createDataFrame(rows, "event_type string, genre string, t string").selectExpr(
        "event_type", "genre", "cast(t as timestamp) as event_timestamp")
    got = [(str(r.week)[:10], r.plays, r.prev_plays, r.change) for r in genre_trend(gold).collect()]
    assert got == [("2024-01-01", 2, None, None), ("2024-01-22", 1, 0, 1), ("2024-01-29", 2, 1, 1)]


def test_engagement_counts_from_the_first_recommendation(spark):
    from encore.plans.insights import recommendation_engagement
    recs = spark.createDataFrame(
        [(1, ["s - a"], "2024-01-01 10:00:00"), (1, ["s - a"], "2024-01-01 11:00:00"),
         (2, ["s - a"], "2024-01-01 11:00:00")], "user_id int, recommended_songs array<string>, t string") \
        .selectExpr("user_id", "recommended_songs", "cast(t as timestamp) as updated_at")
    gold = spark.createDataFrame([(1, "2024-01-01 10:30:00"), (2, "2024-01-01 10:30:00")],
                                 "user_id int, t string").selectExpr(
        "user_id", "'s' as song_name", "'a' as artist_name", "'PLAY' as event_type",
        "cast(t as timestamp) as event_timestamp", "202401 as event_month")
    row = recommendation_engagement(recs, gold).collect()
    assert [(r.song, r.recommended_users, r.engaged_users) for r in row] == [("s - a", 2, 1)]
