from pyspark.sql import functions as F

from encore.operators.bronze import ERROR_MISSING_FIELDS, bronze, flag_valid, parse_events

MSGS = [
    '{"event_id":"e1","user_id":1,"song_id":"s1","timestamp":"2024-01-01 00:00:01","event_type":"PLAY"}',
    'not json',
    '[1,2]',
    None,
    '',
    '{"event_id":"e2","user_id":"5","song_id":"s1","timestamp":"2024-01-01 00:00:01","event_type":"PLAY"}',
    '{"event_id":"e3","user_id":5.0,"song_id":"s1","timestamp":"t","event_type":"SKIP"}',
    '{"event_id":"e4","user_id":99999999999,"song_id":"s1","timestamp":"t","event_type":"SKIP"}',
    '{"event_id":7,"user_id":2,"song_id":"s2","timestamp":"2024-01-01 00:00:02","event_type":"LIKE"}',
    '{"event_id":"e5","user_id":3,"song_id":"","timestamp":"2024-01-01 00:00:03","event_type":"PLAY"}',
    '{"event_id":"e6","user_id":3,"song_id":"s3","timestamp":"2024-01-01 00:00:03"}',
    '{"event_id":"e7","user_id":3,"song_id":"s3","timestamp":"bad","event_type":"","extra":1}',
]


def _raw(spark):
    return spark.createDataFrame([(m,) for m in MSGS], "v string").select(
        F.col("v").cast("binary").alias("value"))


def test_split_is_disjoint_and_exhaustive(spark):
    valid, invalid = bronze(_raw(spark), as_of="2024-02-01 00:00:00")
    v = {r.event_id for r in valid.collect()}
    inv = invalid.collect()
    assert len(v) + len(inv) == len(MSGS)
    assert v == {"e1", "7", "e5", "e6", "e7"}
    assert all(r.error_type == ERROR_MISSING_FIELDS and r.is_valid is False for r in inv)
    # the quarantine keeps the payload
    assert {r.raw_value for r in inv if r.raw_value} >= {"not json", "[1,2]"}


def test_bad_int_nulls_only_that_field(spark):
    rows = {r.event_id: r for r in parse_events(_raw(spark)).collect() if r.event_id}
    for eid in ("e2", "e3", "e4"):
        assert rows[eid].user_id is None and rows[eid].song_id == "s1"


def test_valid_keeps_empty_and_missing_type(spark):
    valid, _ = bronze(_raw(spark))
    rows = {r.event_id: r for r in valid.collect()}
    assert rows["e5"].song_id == ""
    assert rows["e6"].event_type is None
    assert rows["e7"].event_type is None  # '' normalised to null like a partitioned read
    assert rows["e1"].source == "kafka_music_events"
    assert "is_valid" not in valid.columns and "raw_value" not in valid.columns


def test_flag_never_null(spark):
    flagged = flag_valid(parse_events(_raw(spark)))
    assert flagged.filter(F.col("is_valid").isNull()).count() == 0
