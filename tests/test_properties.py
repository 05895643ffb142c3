"""Property tests: lenient int parsing against a model of its rule, and the
bronze split being a partition of its input."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from encore.functions import to_int
from encore.operators.bronze import bronze

BLANKS = "".join(chr(c) for c in range(0x21)) + "".join(chr(c) for c in range(0x7F, 0xA0))


def model(s):
    if s is None:
        return None
    t = s.strip(BLANKS)
    body = t[1:] if t[:1] in ("+", "-") else t
    whole, _, fraction = body.partition(".")
    if not body or not all("0" <= c <= "9" for c in whole + fraction):
        return None
    v = int(whole or "0") * (-1 if t.startswith("-") else 1)
    return v if -2**31 <= v < 2**31 else None


TEXT = st.one_of(
    st.none(),
    st.text(alphabet="0123456789+-.e \t", max_size=14),
    st.integers(-3_000_000_000, 3_000_000_000).map(str),
    st.builds(lambda a, b: f"{a}.{b}", st.integers(-10**10, 10**10), st.integers(0, 999)),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_to_int_follows_its_rule(spark, vals):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", to_int("s").alias("v")).collect()}
    assert [got[i] for i in range(len(vals))] == [model(v) for v in vals]


MSG = st.fixed_dictionaries({}, optional={
    "event_id": st.one_of(st.none(), st.text(max_size=3), st.integers(0, 9)),
    "user_id": st.one_of(st.none(), st.integers(-5, 5), st.text(max_size=2)),
    "song_id": st.one_of(st.none(), st.text(max_size=3)),
    "event_type": st.sampled_from(["PLAY", "SKIP", "LIKE", ""]),
})


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(MSG.map(lambda d: __import__("json").dumps(d)), st.text(max_size=5)),
                min_size=1, max_size=40))
def test_bronze_split_partitions_input(spark, msgs):
    raw = spark.createDataFrame([(m,) for m in msgs], "v string").select(
        F.col("v").cast("binary").alias("value"))
    valid, invalid = bronze(raw, as_of="2024-01-01 00:00:00")
    nv, ni = valid.count(), invalid.count()
    assert nv + ni == len(msgs)
    assert valid.filter("event_id is null or user_id is null or song_id is null").count() == 0


PLAYS = st.dictionaries(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(["s1", "s2", "s3", "s4"]),
              st.sampled_from(["a1", "a2"])),
    st.integers(1, 4), max_size=14)
USERS = st.dictionaries(st.integers(1, 8), st.sampled_from(["A", "B", "C", "D"]),
                        min_size=1, max_size=6)


def recommend_model(plays, users, n):
    """Brute force: each user's country top n by (plays desc, song, artist),
    else the first n rows of the (country, plays desc, song, artist) order."""
    def label(k):
        return f"{k[1]} - {k[2]}"
    order = sorted(plays, key=lambda k: (k[0], -plays[k], k[1], k[2]))
    fallback = [label(k) for k in order[:n]]
    out = set()
    for uid, country in users.items():
        mine = [label(k) for k in order if k[0] == country][:n] or fallback
        for r, song in enumerate(mine, 1):
            out.add((uid, f"u{uid}", r, song))
    return out


@settings(max_examples=6, deadline=None)
@given(PLAYS, USERS, st.integers(1, 3))
def test_recommend_from_matches_brute_force(spark, plays, users, n):
    from encore.plans.recommend import recommend_from, recommendation_rows
    p = spark.createDataFrame([(c, s, a, v) for (c, s, a), v in plays.items()],
                              "country string, song_name string, artist_name string, plays long")
    u = spark.createDataFrame([(i, f"u{i}", c) for i, c in users.items()],
                              "user_id int, user_name string, country string")
    recs = recommend_from(p, u, n=n, as_of="2024-01-01 00:00:00")
    got = {(r.user_id, r.user_name, r.rank, r.song) for r in recommendation_rows(recs).collect()}
    assert got == recommend_model(plays, users, n)
