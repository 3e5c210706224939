"""Plan shapes that matter at scale."""

import re

import pytest

from rillmark.plans.registry import QUERIES, load_all

load_all()

TOP_K = ["latest_interaction", "user_history", "topk_per_user", "popularity_dampened", "dedup_events", "favorite_categories"]


def plan(spark, sf, name):
    return QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TOP_K)
def test_top_k_is_cut_before_the_shuffle(spark, sf, name):
    assert re.search(r"WindowGroupLimit.*Partial", plan(spark, sf, name))


def test_columns_are_pruned(spark, sf):
    text = plan(spark, sf, "item_popularity")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "value" not in schema and "props" in schema


def test_pair_features_is_one_hash_aggregation(spark, sf):
    text = plan(spark, sf, "pair_features")
    assert "SortAggregate" not in text and "Window" not in text and "Join" not in text


def test_user_features_read_the_log_once(spark):
    from rillmark.operators.features import user_features
    from rillmark.schemas import EVENT
    from rillmark.session import scratch_dir
    path = scratch_dir(spark, "log")
    spark.createDataFrame([("1", "u", "i", "view", None, None, '{"category": "c"}')], EVENT).write.parquet(path)
    df = user_features(spark.read.schema(EVENT).parquet(path))
    assert df.first().favorite_categories == ["c"]
    assert all("user-days" in name for name in df.inputFiles())  # only what was combined in the one pass
