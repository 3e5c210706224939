"""Progress rows, lag alerts, and drift read from counts."""

import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillmark.operators import driftcounts as dc
from rillmark.operators import quality as dq
from rillmark.schemas import EVENT
from rillmark.session import scratch_dir
from rillmark.streaming import flows, sinks
from rillmark.streaming.progress import (
    ProgressTable, lag_alerts, lag_by_window, progress_rows, query_totals, read_progress,
)

T0 = datetime(2024, 1, 1, 10)


def test_late_rows_are_counted_exactly(spark):
    drop, out, cp, table = (scratch_dir(spark, n) for n in ("drop", "out", "cp", "progress"))
    listener = ProgressTable(spark, table)
    spark.streams.addListener(listener)
    try:
        def feed(rows):
            data = [(str(i), "u", "i", "view", None, T0 + timedelta(minutes=m), None) for i, m in rows]
            spark.createDataFrame(data, EVENT).coalesce(1).write.mode("append").parquet(drop)
            df = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(drop)
            q = flows.dedup_stream(df).writeStream.queryName("dedup").foreachBatch(sinks.batch_writer(out)).option(
                "checkpointLocation", cp).trigger(availableNow=True).start()
            q.awaitTermination()

        feed([(1, 0), (2, 60)])
        feed([(3, 5), (4, 10), (5, 55), (6, 61)])  # the watermark stands at 50: two are late
        feed([(7, 0), (8, 62)])  # one more
        for _ in range(100):
            got = query_totals(read_progress(spark, table)).collect()
            if got and got[0].late_rows == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    (r,) = got
    assert (r["query"], r.late_rows, r.input_rows) == ("dedup", 3, 8)
    assert spark.read.parquet(out).count() == 5 and r.seconds > 0 and r.state_rows >= 1


def test_rows_of_a_report():
    report = {"id": "q", "runId": "r", "name": None, "batchId": 4, "timestamp": "2024-01-01T00:00:00.000Z", "durationMs": {"triggerExecution": 1500},
              "eventTime": {"watermark": "2023-12-31T23:50:00.000Z"}, "stateOperators": [{"numRowsTotal": 7, "numRowsDroppedByWatermark": 2}],
              "sources": [{"description": "Kafka", "numInputRows": 9, "metrics": {"maxOffsetsBehindLatest": "12000"}}, {"description": "Files"}],
              "observedMetrics": {"m": {"n": 3, "x": "text"}}}
    a, b = progress_rows(report)
    assert (a["query"], a["offsets_behind"], a["late_rows"], a["state_rows"], a["seconds"], a["input_rows"]) == ("q", 12000, 2, 7, 1.5, 9)
    assert b["offsets_behind"] is None and b["input_rows"] == 0 and a["observed"] == {"m.n": 3.0}
    assert progress_rows({"id": "q", "runId": "r", "batchId": 0, "timestamp": "t"})[0]["input_rows"] == 0


def test_lag_alert_needs_ten_minutes(spark):
    rows = [(q, T0 + timedelta(minutes=m, seconds=s), lag) for q, minutes, lag in (
        ("long", range(0, 12), 10_001), ("short", range(0, 9), 50_000), ("low", range(0, 30), 10_000)) for m in minutes for s in (0, 30)]
    rows += [("broken", T0 + timedelta(minutes=m), 20_000) for m in (*range(0, 6), *range(7, 13))]
    df = spark.createDataFrame(rows, "query string, timestamp timestamp, offsets_behind long")
    assert [(r.series, r.windows) for r in lag_alerts(lag_by_window(df)).collect()] == [("long", 12)]


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(1)
    ref = spark.createDataFrame([(r.gauss(0, 1) if r.random() > 0.05 else None, float(r.randint(0, 3)), None) for _ in range(1500)],
                                "x double, y double, z double")
    parts = [spark.createDataFrame([(r.gauss(0.2 * b, 1), float(r.randint(0, 3 + b)), 1.0) for _ in range(200)],
                                   "x double, y double, z double") for b in range(5)]
    return ref, parts


def test_counts_of_batches_equal_the_batch_index(spark, tables):
    ref, parts = tables
    reference = dc.drift_reference(ref, ["x", "y"])
    path = scratch_dir(spark, "counts")
    monitor = sinks.DriftMonitor(reference, ("x", "y"), path, batches=3)
    scores = []
    for b, p in enumerate(parts):
        scores.append(p.sparkSession.range(1).select(monitor.score(p, b).alias("s")).first().s)
        monitor.add(p, b)  # a retried batch replaces itself
    for upto in (1, 4):
        window = dq.union_all(parts[max(0, upto - 2):upto + 1])
        want = {r.column_name: r for r in dq.drift(ref, window, ["x", "y"]).collect()}
        got = {r.column_name: r for r in monitor.index(spark, upto).collect()}
        assert set(got) == {"x", "y"}
        for c in got:
            assert got[c].psi == pytest.approx(want[c].psi) and got[c].drifted == want[c].drifted
        assert scores[upto] == pytest.approx(max(r.psi for r in want.values()))
    assert scores[-1] > 0.2  # it has drifted


def test_empty_sides(spark, tables):
    ref, parts = tables
    reference = dc.drift_reference(ref, ["x", "z"])  # z has only nulls in the reference
    got = {r.column_name: r for r in dc.psi(dc.drift_counts(parts[0], reference, ["x", "z"]), reference).collect()}
    assert got["z"].drifted and got["z"].psi > 1
    assert got["x"].psi == pytest.approx(dq.drift(ref, parts[0], ["x"]).first().psi)  # parts have no nulls, the reference has
    none = dc.psi(dc.drift_counts(parts[0].where("false"), reference, ["x"]), reference)
    assert {(r.column_name, r.psi, r.drifted) for r in none.collect()} == {("x", None, True), ("z", None, True)}
    assert dc.drift_score(none).first()[0] == 0.0
    empty = dc.drift_reference(ref.where("false"), ["x"])
    assert dc.psi(dc.drift_counts(parts[0], empty, ["x"]), empty).first().drifted


def test_drift_fires_the_retrain_rule(spark, tables):
    from rillmark.operators.monitor import RetrainRule
    ref, parts = tables
    events = [p.withColumns({"user_id": F.lit("u"), "item_id": F.lit("i"), "event_type": F.lit("view"), "rating": F.lit(None).cast("double"),
                             "timestamp": F.lit("2024-01-01").cast("timestamp")}) for p in (parts[0], parts[4])]
    root = scratch_dir(spark, "online")
    factors = spark.createDataFrame([("i", [1.0, 0.0])], "item_id string, features array<double>")
    monitor = sinks.DriftMonitor(dc.drift_reference(ref, ["y"]), ("y",), f"{root}/drift", batches=1)
    handle = sinks.online_update(root, factors, "2024-01-01", rule=RetrainRule(10 ** 9, 0.2, 1e9), monitor=monitor)
    for b, e in enumerate(events):
        handle(e, b)
    got = {r.batch_id: (r.retrain, r.reason) for r in spark.read.parquet(f"{root}/retrain").collect()}
    assert got == {0: (False, "Conditions not met"), 1: (True, "drift")}
