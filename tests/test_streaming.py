"""Streams over small file drops: equality with the batch twins, lateness, retries and restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators.monitor import RetrainRule
from rillmark.schemas import EVENT
from rillmark.session import scratch_dir
from rillmark.sources import topics
from rillmark.sources.snapshots import read_batches
from rillmark.streaming import flows, sinks
from tests.conftest import rows

T0 = datetime(2024, 1, 1, 10)


def event(i, user, item, minutes, kind="view", rating=None):
    return (str(i), user, item, kind, rating, T0 + timedelta(minutes=minutes), None)


@pytest.fixture
def drop(spark):
    """A folder of event files, read as a stream one file per micro-batch."""
    path = scratch_dir(spark, "drop")

    def add(data):
        spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(path)

    def stream():
        return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(path)

    def batch():
        return spark.read.schema(EVENT).parquet(path)

    add.stream, add.batch = stream, batch
    return add


def run(start, *args, **kw):
    start(*args, once=True, **kw).awaitTermination()


def test_hourly_stream_equals_batch_and_restarts(spark, drop):
    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    drop([event(1, "u", "i", 0), event(2, "u", "i", 5, "rating", 4.0), event(3, "v", "i", 8)])
    run(sinks.start_feature_query, flows.hourly_pair_stream(drop.stream()), out, cp)
    drop([event(4, "u", "i", 12, "rating", 2.0), event(5, "u", "j", 70)])
    for _ in range(2):  # the second start finds nothing new
        run(sinks.start_feature_query, flows.hourly_pair_stream(drop.stream()), out, cp)
    keys = ["user_id", "item_id", "window_start"]
    got = sinks.read_latest(spark, out, keys)
    want = ft.hourly_pairs(drop.batch())
    cols = [*keys, "interaction_count_1h", "avg_rating", "last_event_time"]
    assert rows(got, *cols) == rows(want, *cols)


def test_late_events_are_dropped_and_append_waits(spark, drop):
    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    drop([event(1, "u", "i", 0)])
    run(sinks.start_feature_query, flows.item_hourly_stream(drop.stream()), out, cp, mode="append")
    drop([event(2, "u", "i", 75)])
    run(sinks.start_feature_query, flows.item_hourly_stream(drop.stream()), out, cp, mode="append")
    drop([event(3, "u", "i", 1)])  # 64 minutes behind the watermark
    run(sinks.start_feature_query, flows.item_hourly_stream(drop.stream()), out, cp, mode="append")
    assert rows(spark.read.parquet(out), "item_id", "item_popularity_1h") == [("i", 1)]


def test_repeats_are_dropped_across_batches(spark, drop):
    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    for _ in range(2):
        drop([event(1, "u", "i", 0), event(1, "u", "i", 0), event(2, "u", "i", 1)])
        run(sinks.start_feature_query, flows.dedup_stream(drop.stream()), out, cp, mode="append")
    assert rows(spark.read.parquet(out), "event_id") == [("1",), ("2",)]


def test_running_state_equals_batch(spark, drop):
    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    drop([event(1, "u", "i", 0), event(2, "u", "i", 1, "rating", 5.0)])
    run(sinks.start_feature_query, flows.running_state_stream(drop.stream(), "user_id"), out, cp)
    drop([event(3, "u", "j", 2, "click"), event(4, "v", "j", 3)])
    run(sinks.start_feature_query, flows.running_state_stream(drop.stream(), "user_id"), out, cp)
    got = sinks.read_latest(spark, out, ["user_id"])
    want = ft.entity_state(drop.batch(), "user_id")
    assert rows(got, *want.columns) == rows(want)


def test_served_without_a_click_comes_out_after_the_window(spark, drop):
    served_path = scratch_dir(spark, "served")
    schema = "event_id string, user_id string, item_id string, timestamp timestamp"

    def serve(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(served_path)

    def query(out, cp):
        served = spark.readStream.schema(schema).parquet(served_path)
        clicks = drop.stream().where("event_type = 'click'")
        run(sinks.start_feature_query, flows.served_clicks_stream(served, clicks, 1, how="leftOuter"), out, cp, mode="append")

    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    serve([("s1", "u", "i", T0), ("s2", "u", "j", T0)])
    drop([event(1, "u", "i", 5, "click")])
    query(out, cp)
    serve([("s9", "z", "z", T0 + timedelta(hours=5))])
    drop([event(2, "z", "q", 300, "click")])
    query(out, cp)
    got = {r.event_id: r.clicked_at for r in spark.read.parquet(out).collect()}
    assert got == {"s1": T0 + timedelta(minutes=5), "s2": None}


def test_dead_letters_and_valid_in_one_write(spark, drop):
    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    drop([event(1, "u", "i", 0), event(2, "", "i", 0), event(3, "u", "i", 0, "view", 3.0)])
    run(sinks.start_ingest, flows.checked_stream(drop.stream()), out, cp)
    got = spark.read.parquet(out).select("event_id", "valid", F.array_join("reasons", ","))
    assert sorted((r[0], str(r[1]).lower(), r[2]) for r in got.collect()) == [
        ("1", "true", ""), ("2", "false", "user_id_empty"), ("3", "false", "rating_unexpected")]


def test_retried_batch_is_not_doubled(spark, drop):
    out = scratch_dir(spark, "out")
    drop([event(1, "u", "i", 0)])
    write = sinks.batch_writer(out)
    for _ in range(3):
        write(drop.batch(), 0)
    write(drop.batch(), 1)
    assert spark.read.parquet(out).count() == 2


def test_publish_land_and_parse(spark, drop):
    topic, raw = scratch_dir(spark, "topic"), scratch_dir(spark, "raw")
    drop([event(1, "u", "i", 0), event(2, "v", "j", 90, "rating", 2.5)])
    topics.publish(drop.stream(), topic, scratch_dir(spark, "cp"), fmt="json", once=True).awaitTermination()
    messages = topics.read_event_stream(spark, topic, "json")
    sinks.land_raw(flows.parse(messages), raw, scratch_dir(spark, "cp2")).awaitTermination()
    landed = spark.read.parquet(raw)
    assert rows(landed, *[f.name for f in EVENT.fields]) == rows(drop.batch())
    assert rows(landed, "hour") == [(10,), (11,)]


def test_online_learning_updates_and_resets_the_trigger(spark, drop):
    root, cp = scratch_dir(spark, "online"), scratch_dir(spark, "cp")
    factors = spark.createDataFrame([("i", [1.0, 0.0]), ("j", [0.0, 1.0])], "item_id string, features array<double>")
    handler = sinks.online_update(root, factors, "2024-01-01 10:00:00", rule=RetrainRule(new_events=3, max_hours=1000.0))
    drop([event(1, "u", "i", 0), event(2, "u", "i", 1, "rating", 4.0)])
    run(sinks.start_online_learning, drop.stream(), handler, cp)
    drop([event(3, "u", "j", 2), event(4, "w", "gone", 3)])
    run(sinks.start_online_learning, drop.stream(), handler, cp)
    state = {r.user_id: r for r in sinks.current_state(spark, f"{root}/user_delta", "user_id").collect()}
    assert state["u"].interaction_count == 3 and state["u"].running_avg_rating == 4.0
    steps = [(r.batch_id, r.events_since, r.retrain, r.reason)
             for r in spark.read.parquet(f"{root}/retrain").orderBy("batch_id").collect()]
    assert steps == [(0, 2, False, "Conditions not met"), (1, 0, True, "events")]
    kept = [(r.batch_id, r.model, r.rows, r.retrain, r.seconds > 0)
            for r in spark.read.parquet(f"{root}/metrics").orderBy("batch_id").collect()]
    assert kept == [(0, "als", 2, False, True), (1, "als", 2, True, True)]
    latest = {r.user_id: r.features for r in sinks.read_latest(spark, f"{root}/user_factors", ["user_id"]).collect()}
    assert latest["u"] == [pytest.approx(0.0), pytest.approx(1 / 1.1)] and latest["w"] == [0.0, 0.0]


@pytest.mark.parametrize("window,slide", [("24 hours", "1 hour"), ("90 minutes", "1 hour"), ("30 minutes", "30 minutes")])
def test_sliding_state_holds_an_event_once_and_late_ones_count_in_open_windows(spark, drop, window, slide):
    out, cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")
    plain_out, plain_cp = scratch_dir(spark, "out"), scratch_dir(spark, "cp")

    def plain():
        return drop.stream().withWatermark("timestamp", "10 minutes").groupBy(
            "user_id", F.window("timestamp", window, slide).alias("w")).agg(
            F.count("*").alias("event_count"), F.avg("rating").alias("avg_rating"), F.max("timestamp").alias("last_event_time")).select(
            "*", "w.start", "w.end").drop("w").withColumnsRenamed({"start": "window_start", "end": "window_end"})

    batches = [
        [event(1, "u", "i", 0), event(2, "u", "i", 20, "rating", 4.0), event(3, None, "i", 45)],
        [event(4, "u", "i", 310), event(5, "v", "i", 300, "rating", 2.0)],
        [event(6, "u", "i", 30, "rating", 1.0), event(7, "w", "i", 200), event(8, "u", "i", 305)],  # late by hours
        [event(9, "u", "i", 2000)],
        [event(10, "u", "i", 31), event(11, "u", "i", 700), event(12, "v", "i", 1990)],  # the first is late by more than a day
    ]
    for data in batches:
        drop(data)
        query = sinks.start_feature_query(flows.sliding_user_stream(drop.stream(), window=window, slide=slide), out, cp, once=True)
        query.awaitTermination()
        run(sinks.start_feature_query, plain(), plain_out, plain_cp)
        if data is batches[0] and window == "24 hours":
            updated = max(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress)
            assert updated <= 2 + 24  # a row per user and hour, and the hours; 48 with every window in the state
    cols = ["user_id", "window_start", "window_end", "event_count", "avg_rating", "last_event_time"]
    got = read_batches(spark, out, flows.sliding_windows(slide))
    assert rows(got, *cols) == rows(sinks.read_latest(spark, plain_out, ["user_id", "window_start"]), *cols)
