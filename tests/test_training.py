import hashlib

import pytest
from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators import training as tr
from rillmark.session import scratch_dir
from rillmark.sources import store
from tests.conftest import rows


@pytest.fixture(scope="module")
def pairs(spark):
    """600 pairs over 300 items; one user holds a third of them."""
    hot = spark.range(200).select(F.lit("hot").alias("user_id"), F.concat(F.lit("i"), F.col("id")).alias("item_id"))
    rest = spark.range(400).select(F.concat(F.lit("u"), F.col("id") % 40).alias("user_id"),
                                   F.concat(F.lit("i"), (F.col("id") * 7) % 300).alias("item_id"))
    return hot.unionByName(rest).distinct().cache()


@pytest.mark.parametrize("ratio", [1, 4, 6])
def test_negatives_are_new_distinct_and_complete(pairs, ratio):
    neg = tr.sample_negatives(pairs, None, ratio, 1).cache()
    assert neg.count() == neg.distinct().count()
    assert neg.join(pairs, ["user_id", "item_id"]).count() == 0
    n = pairs.select("item_id").distinct().count()
    want = {r.user_id: min(ratio * r["count"], n - r["count"]) for r in pairs.groupBy("user_id").count().collect()}
    assert {r.user_id: r["count"] for r in neg.groupBy("user_id").count().collect()} == {u: c for u, c in want.items() if c}


def test_negatives_follow_the_permutation_without_a_shuffle_of_places(spark, pairs, monkeypatch):
    odd = spark.createDataFrame([(None, "i1"), ("v", None), ("v", "i2"), ("hot", "i0")], "user_id string, item_id string")
    pairs = pairs.unionByName(odd)
    by, ids = {}, sorted({r.item_id for r in pairs.collect()} - {None}, key=lambda i: hashlib.sha256(i.encode()).hexdigest())
    for r in pairs.distinct().collect():
        by.setdefault(r.user_id, set()).add(r.item_id)
    del by[None]
    want = []
    for user, seen in by.items():
        key, n = hashlib.sha256(f"{user}:42".encode()).hexdigest(), len(ids)
        step, start = tr.STEPS[int(key[:8], 16) % len(tr.STEPS)], int(key[8:16], 16)
        left = [i for i in (ids[(place * step + start) % n] for place in range(n)) if i not in seen]
        want += [(user, i) for i in left[:4 * len(seen)]]
    for places in (tr.SLICE, 8):
        monkeypatch.setattr(tr, "SLICE", places)
        neg = tr.sample_negatives(pairs)
        assert rows(neg) == sorted(want, key=repr)
    assert "LeftAnti" not in neg._jdf.queryExecution().toString()


def test_steps_are_prime_and_below_two_to_the_31():
    for p in tr.STEPS:
        assert p < 2**31 and all(p % d for d in range(2, int(p**0.5) + 1))


def test_negatives_repeat_with_the_seed(pairs):
    a, b, c = (rows(tr.sample_negatives(pairs, None, 2, s)) for s in (1, 1, 2))
    assert a == b and a != c


def test_negatives_of_a_saturated_table_end_early(spark):
    full = spark.range(6).select(F.concat(F.lit("u"), F.col("id") % 2).alias("user_id"),
                                 F.concat(F.lit("i"), F.floor(F.col("id") / 2)).alias("item_id"))
    assert tr.sample_negatives(full).count() == 0


def events(spark):
    return spark.createDataFrame(
        [("1", "u", "a", "view", None, 10), ("2", "u", "a", "click", None, 20), ("3", "v", "b", "rating", 4.0, 30),
         ("4", "v", "a", "view", None, 40)],
        "event_id string, user_id string, item_id string, event_type string, rating double, s long",
    ).withColumn("timestamp", F.timestamp_seconds("s")).withColumn("metadata", F.lit('{"category":"c"}')).drop("s")


def test_training_rows_have_suffixed_columns_and_fills(spark):
    df = events(spark)
    parts = ft.pair_features(df, "1970-01-01 01:00:00"), ft.user_features(df), ft.item_features(df)
    out = tr.build_training_set(*parts, ratio=1)
    assert {"total_views_user", "total_views_item", "total_clicks_user", "total_clicks_item"} <= set(out.columns)
    assert "total_views" not in out.columns
    for r in out.where("label = 0").collect():
        assert (r.interaction_count, r.last_interaction_type, r.time_since_last_interaction, r.user_item_rating) == (
            0, "none", -1.0, None)
        assert (r.user_id, r.item_id) == ("u", "b")


def test_pair_features_of_tied_events(spark):
    df = events(spark).withColumn("timestamp", F.timestamp_seconds(F.lit(0)))
    got = {(r.user_id, r.item_id): r for r in ft.pair_features(df, "1970-01-02 12:00:00").collect()}
    assert len(got) == 3
    assert got["u", "a"].last_interaction_type == "click" and got["u", "a"].interaction_count == 2
    assert got["u", "a"].time_since_last_interaction == 36.0


@pytest.mark.parametrize("at", ["1969-12-31 23:59:59.999999", "2042-05-06 07:08:09.000001", "0500-01-01 00:00:00"])
@pytest.mark.parametrize("kind", ["view", "click", "rating"])
def test_pair_features_at_far_times(spark, at, kind):
    df = spark.createDataFrame([("u", "a", kind, 3.0 if kind == "rating" else None)], "user_id string, item_id string, event_type string, rating double")
    df = df.withColumn("timestamp", F.lit(at).cast("timestamp"))
    got = ft.pair_features(df, at).first()
    assert (got.last_interaction_type, got.time_since_last_interaction) == (kind, 0.0)


def test_split_and_folds_cover_everything(pairs):
    by = {r.split: r["count"] for r in tr.split(pairs).groupBy("split").count().collect()}
    assert sum(by.values()) == pairs.count() and by["train"] > 0.7 * pairs.count()
    assert tr.hash_folds(pairs).agg(F.countDistinct("fold")).first()[0] == 5


def test_write_training_set(spark):
    df = events(spark)
    root = scratch_dir(spark, "datasets")
    parts = ft.pair_features(df, "2024-01-01"), ft.user_features(df), ft.item_features(df)
    tr.write_training_set(*parts, root=root, version="20240101", ratio=1)
    tr.write_training_set(*parts, root=root, version="20240102_030000", ratio=1)
    assert store.latest_version(spark, root) == "20240102_030000"
    assert store.read_version(spark, root).count() == store.read_version(spark, root, "20240101").count() == 4


def test_rewrite_replaces_only_its_partition(spark):
    path = scratch_dir(spark, "features")
    store.write_features(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, ["k"])
    store.write_features(spark.createDataFrame([("a", 9)], "k string, v int"), path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [("a", 9), ("b", 2)]


def test_retried_batch_replaces_itself(spark):
    path = scratch_dir(spark, "batches")
    df = events(spark)
    for _ in range(2):
        store.append_batch(df, 7, path)
    assert spark.read.parquet(path).count() == df.count()


def test_scan_filters_reach_the_files(spark, sf):
    plan = store.scan_events(spark, f"{sf}/events.parquet", "2024-01-10", "2024-01-20", ts="ts")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text


def test_state_merge_is_the_mean_with_default(spark):
    df = events(spark)
    merged = ft.merge_state(ft.entity_state(df.where("event_id < '3'"), "item_id", 3.0), df.where("event_id >= '3'"), "item_id", 3.0)
    got = {r.item_id: r for r in ft.state_view(merged, "item_id").collect()}
    assert got["a"].running_avg_rating == 3.0 and got["a"].interaction_count == 3
    assert got["a"].click_through_rate == 0.5 and got["b"].running_avg_rating == 4.0
