"""Manifests: compaction of stream tables and merges of single buckets, with crashes in between."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators.profiles import upsert
from rillmark.session import scratch_dir
from rillmark.sources import snapshots as sn
from rillmark.streaming import sinks
from tests.conftest import rows

STATE = "user_id string, interaction_count long, rating_sum double, rating_n long, views long, clicks long, last_active_timestamp timestamp"


def files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root.removeprefix("file:")) for f in fs
                  if f.endswith(".parquet"))


@pytest.fixture
def deltas(spark):
    """A table of state deltas, one folder per batch."""
    root = scratch_dir(spark, "deltas")
    r = random.Random(1)

    def add(batch):
        data = [(f"u{r.randint(0, 5)}", r.randint(1, 4), 2.5, 1, 1, 0, None) for _ in range(6)]
        df = spark.createDataFrame(data, STATE).withColumn("last_active_timestamp", F.timestamp_seconds(F.lit(1000 * batch)))
        sinks.batch_writer(root)(sinks.summed_state("user_id")(df), batch)

    add.root = root
    return add


def test_reader_sees_the_same_before_and_after_compaction(spark, deltas):
    for b in range(5):
        deltas(b)
    before = rows(sinks.current_state(spark, deltas.root, "user_id"))
    m = sn.compact(spark, deltas.root, sinks.summed_state("user_id"))
    assert m["upto"] == 3  # the last batch may be written again by a stream that restarts
    assert rows(sinks.current_state(spark, deltas.root, "user_id")) == before
    assert sn.drop_unused(spark, deltas.root, kept=1) == [f"batch_id={b}" for b in range(4)]
    assert rows(sinks.current_state(spark, deltas.root, "user_id")) == before
    deltas(4)  # the retried batch replaces itself
    deltas(5)
    after = rows(sinks.current_state(spark, deltas.root, "user_id"))
    assert after != before
    sn.compact(spark, deltas.root, sinks.summed_state("user_id"))
    dropped = sn.drop_unused(spark, deltas.root, kept=1)
    assert [d for d in dropped if d.startswith("data-")] == m["folders"]
    assert rows(sinks.current_state(spark, deltas.root, "user_id")) == after
    assert len(sn.read_manifest(spark, deltas.root)["folders"]) == 1


def test_a_crash_before_the_rename_loses_nothing(spark, deltas, monkeypatch):
    for b in range(4):
        deltas(b)
    before = rows(sinks.current_state(spark, deltas.root, "user_id"))
    with monkeypatch.context() as m:
        m.setattr(sn, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sn.compact(spark, deltas.root, sinks.summed_state("user_id"))
    assert sn.versions(spark, deltas.root) == [] and any(f.startswith("data-") for f in os.listdir(deltas.root))
    assert rows(sinks.current_state(spark, deltas.root, "user_id")) == before
    assert sn.drop_unused(spark, deltas.root) == []  # nothing is dropped before the pointer moves
    sn.compact(spark, deltas.root, sinks.summed_state("user_id"))
    assert rows(sinks.current_state(spark, deltas.root, "user_id")) == before
    sn.drop_unused(spark, deltas.root)
    assert sum(f.startswith("data-") for f in os.listdir(deltas.root)) == 1  # what the crash left is gone
    assert rows(sinks.current_state(spark, deltas.root, "user_id")) == before


def test_newest_rows_survive_compaction(spark):
    root = scratch_dir(spark, "latest")
    for b, data in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)], [("b", 4)]]):
        sinks.batch_writer(root)(spark.createDataFrame(data, "k string, v int"), b)
        if b:
            sn.compact(spark, root, sinks.newest_rows(["k"]))
    assert rows(sinks.read_latest(spark, root, ["k"])) == [("a", 2), ("b", 4), ("c", 3)]
    assert sn.read_manifest(spark, root)["upto"] == 2 and len(sn.versions(spark, root)) == 3


def table(spark):
    return spark.createDataFrame([(k, f"n{k}", float(k)) for k in range(200)], "k long, name string, v double")


def test_only_touched_buckets_are_rewritten(spark):
    root = scratch_dir(spark, "table")
    sn.create_table(table(spark), root, "k", 16)
    first = files(root)
    assert rows(sn.read_table(spark, root)) == rows(table(spark))
    updates = spark.createDataFrame([(3, None, -1.0, 1), (3, "x", None, 2), (500, "new", 5.0, 1)], "k long, name string, v double, at int")
    m = sn.upsert_table(updates, root, ["at"])
    want = rows(upsert(table(spark), updates, "k", ["at"]))
    assert rows(sn.read_table(spark, root)) == want and (3, "x", -1.0) in want and (500, "new", 5.0) in want
    old = sn.read_manifest(spark, root, 1)["of"]
    changed = {b for b in m["of"] if m["of"][b] != old.get(b)}
    assert 1 <= len(changed) <= 2
    assert set(first) <= set(files(root))  # nothing was overwritten
    assert rows(sn.read_table(spark, root, version=1)) == rows(table(spark))  # older readers go on
    sn.drop_unused(spark, root, kept=1)
    assert rows(sn.read_table(spark, root)) == want
    assert sn.upsert_table(updates.where("false"), root, ["at"]) == m


def test_two_writers_of_one_version(spark):
    root = scratch_dir(spark, "table")
    m = sn.create_table(table(spark), root, "k", 4)
    sn.publish(spark, root, m)
    with pytest.raises(sn.Conflict):
        sn.publish(spark, root, m)
    assert sn.versions(spark, root) == [1, 2]
    assert not [f for f in os.listdir(f"{root}/_manifest") if f.endswith(".tmp")]


def test_days_are_dropped_as_folders(spark):
    root = scratch_dir(spark, "raw")
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "k int, date string").write.partitionBy("date").parquet(root)
    assert sn.drop_days(spark, root, "2024-01-03") == ["2024-01-01", "2024-01-02"]
    assert [r.k for r in spark.read.parquet(root).collect()] == [3]
    with pytest.raises(FileNotFoundError):
        sn.read_batches(spark, root, lambda d: d)
