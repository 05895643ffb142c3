"""Field types of raw messages."""

import json

from encore.operators.contract import EVENT_CONTRACT, Field, field_types, merged_schema


def messages(spark, texts):
    return spark.createDataFrame([(None if t is None else bytearray(t.encode()),) for t in texts], "value binary")


def found(df):
    return {(r.field, r.type): (r.messages, r.ok) for r in df.collect()}


def test_every_field_and_type_is_listed(spark):
    good = {"event_id": "e", "user_id": 1, "song_id": "s", "timestamp": "t", "event_type": "PLAY"}
    texts = [json.dumps(x) for x in (
        good, good | {"duration_seconds": 3}, good | {"duration_seconds": None}, good | {"user_id": "7"},
        good | {"user_id": 1.5}, good | {"song_id": None}, good | {"extra": {"a": 1}}, good | {"extra": [1]},
        good | {"event_type": True}, {"user_id": 2}, {})]
    texts += ["not json", "", None, "[1]", "null", '"text"', "12", '{"event_id":"a","event_id":"b"}']
    got = found(field_types(messages(spark, texts)))
    assert got == {
        ("event_id", "STRING"): (9, True), ("event_id", "MISSING"): (2, False),
        ("user_id", "BIGINT"): (8, True), ("user_id", "STRING"): (1, False), ("user_id", "DECIMAL"): (1, False),
        ("user_id", "MISSING"): (1, False),
        ("song_id", "STRING"): (8, True), ("song_id", "VOID"): (1, False), ("song_id", "MISSING"): (2, False),
        ("timestamp", "STRING"): (9, True), ("timestamp", "MISSING"): (2, False),
        ("event_type", "STRING"): (8, True), ("event_type", "BOOLEAN"): (1, False), ("event_type", "MISSING"): (2, False),
        ("duration_seconds", "BIGINT"): (1, True), ("duration_seconds", "VOID"): (1, True),
        ("extra", "OBJECT"): (1, False), ("extra", "ARRAY"): (1, False),
        ("(message)", "MALFORMED"): (4, False), ("(message)", "ARRAY"): (1, False), ("(message)", "VOID"): (1, False),
        ("(message)", "STRING"): (1, False), ("(message)", "BIGINT"): (1, False)}


def test_other_contract_and_no_messages(spark):
    texts = ['{"a": 1, "b.c": "x"}', '{"a": "one"}']
    got = found(field_types(messages(spark, texts), {"a": Field(("BIGINT", "STRING"))}))
    assert got == {("a", "BIGINT"): (1, True), ("a", "STRING"): (1, True), ("b.c", "STRING"): (1, False)}
    assert found(field_types(messages(spark, []))) == {}


def test_merged_schema(spark):
    texts = ['{"event_id": "a", "user_id": 1}', '{"event_id": "b", "user_id": "x", "more": 2}', "bad"]
    assert merged_schema(messages(spark, texts)).first()["schema"] == \
        "OBJECT<event_id: STRING, more: BIGINT, user_id: VARIANT>"
    assert set(EVENT_CONTRACT) >= {"event_id", "user_id", "song_id"}
