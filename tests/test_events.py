from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rillmark.operators import events as ev
from rillmark.schemas import EVENT, SERVED_JSON
from tests.conftest import rows

NOW = datetime(2024, 1, 1, 12)

CASES = [
    ("view", "user_0001", "item_0042", "view", None, []),
    ("click", "user_0002", "item_0010", "click", None, []),
    ("rating", "user_0003", "item_0099", "rating", 4.5, []),
    ("rating without value", "user_0001", "item_0001", "rating", None, ["rating_missing"]),
    ("view with rating", "user_0001", "item_0001", "view", 3.0, ["rating_unexpected"]),
    ("out of range", "user_0001", "item_0001", "rating", 6.0, ["rating_out_of_range"]),
    ("empty user", "", "item_0001", "view", None, ["user_id_empty"]),
    ("null item", "user_1", None, "view", None, ["item_id_empty"]),
    ("unknown type", "user_1", "item_1", "share", None, ["event_type_unknown"]),
    ("null type with rating", "user_1", "item_1", None, 9.0,
     ["event_type_unknown", "rating_unexpected", "rating_out_of_range"]),
]


def test_schema_cases(spark):
    data = [(name, u, i, t, r, NOW, None) for name, u, i, t, r, _ in CASES]
    valid, rejected = ev.validate_events(spark.createDataFrame(data, EVENT))
    assert {r[0] for r in rows(valid)} == {c[0] for c in CASES if not c[5]}
    assert {r.event_id: r.reasons for r in rejected.collect()} == {c[0]: c[5] for c in CASES if c[5]}


def test_missing_time_is_rejected_with_a_reason(spark):
    sent = spark.createDataFrame([("u", "i", "view", "yesterday")], "user_id string, item_id string, event_type string, timestamp string")
    _, rejected = ev.validate_events(ev.normalise_events(sent))
    assert rejected.first().reasons == ["timestamp_missing"]


def test_json_round_trip_keeps_metadata(spark):
    text = ('{"event_id":"e1","user_id":"user_0042","item_id":"item_0007","event_type":"click","rating":null,'
            '"timestamp":"2024-01-01T10:00:00.123456+00:00","metadata":{"device":"mobile","page":"home"}}')
    first = ev.normalise_events(ev.decode(spark.createDataFrame([(text.encode(),)], "value binary")))
    again = ev.normalise_events(ev.decode(ev.encode(first)))
    assert rows(first) == rows(again)
    assert again.select(F.get_json_object("metadata", "$.device")).first()[0] == "mobile"
    assert again.first().timestamp == datetime(2024, 1, 1, 10, 0, 0, 123456)


def test_both_producer_shapes(spark):
    a = '{"event_id":"x","user_id":"u","item_id":"i","event_type":"view","timestamp":"2024-01-01T00:00:00Z","metadata":{"a":1}}'
    b = '{"user_id":"u","item_id":"i","event_type":"view","received_at":"2024-01-01T00:00:00Z","context":{"a":1}}'
    out = ev.normalise_events(ev.decode(spark.createDataFrame([(a,), (b,)], "value string")))
    got = rows(out, "timestamp", "metadata")
    assert got[0] == got[1]
    ids = {r.event_id for r in out.collect()}
    assert "x" in ids and len(ids) == 2 and None not in ids
    replay = ev.normalise_events(ev.decode(spark.createDataFrame([(b,)], "value string"))).first().event_id
    assert replay in ids


@pytest.mark.parametrize("items,reasons", [(["a", "b", "c"], None), ([], ["no_items"])])
def test_served_record(spark, items, reasons):
    df = spark.createDataFrame(
        [("s1", "user_0001", items, "v1.0", "B", "exp_001", "2024-01-01T00:00:00Z", 42.5, None)], SERVED_JSON)
    back = ev.decode(ev.encode(df), SERVED_JSON)
    valid, rejected = ev.validate_served(back)
    if reasons:
        assert rejected.first().reasons == reasons
    else:
        assert [r.item_id for r in ev.explode_served(valid).orderBy("rank").collect()] == items


def test_dedup_keeps_the_first_of_a_hot_id(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.timestamp_seconds(F.lit(1_000_000) + F.col("id")).alias("timestamp"))
    out = ev.dedup_events(df)
    assert out.count() == 2001
    assert out.where("event_id = 'hot'").first().timestamp.timestamp() == 1_000_000
