import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators import models as ml
from rillmark.operators import recommend as rc
from rillmark.operators import training as tr
from rillmark.operators import windows as wn
from rillmark.session import scratch_dir
from rillmark.sources import store

SMALL = {"trees": 3, "depth": 2}


@pytest.fixture(scope="module")
def events(spark):
    """Two tastes: even users meet even items, odd users odd items."""
    return spark.range(1200).select(
        F.col("id").cast("string").alias("event_id"),
        F.concat(F.lit("u"), F.col("id") % 20).alias("user_id"),
        F.concat(F.lit("i"), (F.col("id") % 2) + 2 * ((F.col("id") * 13 / 20).cast("int") % 15)).alias("item_id"),
        F.element_at(F.array(F.lit("view"), F.lit("click"), F.lit("view")), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        F.lit(None).cast("double").alias("rating"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("timestamp"),
        F.lit('{"category":"c"}').alias("metadata")).cache()


@pytest.fixture(scope="module")
def fitted(events):
    pairs = ft.pair_features(events, "2023-12-01")
    indexed = ml.index_pairs(pairs.select("user_id", "item_id", "interaction_count")).cache()
    return pairs, indexed, ml.train_als(indexed, rank=4, iters=5, blocks=2)


def test_factorisation_finds_the_tastes(fitted):
    _, indexed, model = fitted
    top = ml.als_candidates(model, indexed, 5).collect()
    assert len(top) == 20 * 5
    same = sum(int(r.user_id[1:]) % 2 == int(r.item_id[1:]) % 2 for r in top)
    assert same == len(top)


def test_factors_and_model_survive_storage(spark, fitted):
    _, indexed, model = fitted
    path = scratch_dir(spark, "als")
    store.write_factors(model, path)
    assert spark.read.parquet(f"{path}/user_factors").count() == 20
    store.save_model(model, f"{path}/model")
    from pyspark.ml.recommendation import ALSModel
    assert ALSModel.load(f"{path}/model").rank == 4


@pytest.fixture(scope="module")
def factors(spark):
    rnd = np.random.default_rng(5)
    y = rnd.normal(size=(12, 3))
    return y, spark.createDataFrame([(f"i{i}", [float(v) for v in row]) for i, row in enumerate(y)],
                                    "item_id string, features array<float>")


def test_gram_and_fold_in_equal_numpy(spark, factors):
    y32, df = factors
    y = np.asarray(y32, dtype="float32").astype("float64")
    got = {(r.i, r.j): r.value for r in ml.gram_matrix(df.repartition(3)).collect()}
    assert np.allclose([[got[i, j] for j in range(3)] for i in range(3)], y.T @ y)
    inter = spark.createDataFrame(
        [("u", "i1", 2.0, 1), ("u", "i1", 5.0, 2), ("u", "i3", 1.0, 1), ("u", "gone", 9.0, 1), ("w", "gone", 1.0, 1)],
        "user_id string, item_id string, rating double, timestamp int")
    out = {r.user_id: r.features for r in ml.fold_in(inter, df, 0.1).collect()}
    want = np.linalg.solve(y.T @ y + 0.1 * np.eye(3), 5.0 * y[1] + 1.0 * y[3])
    assert np.allclose(out["u"], want)
    assert out["w"] == [0.0, 0.0, 0.0]


def test_embedding_shift(spark):
    old = spark.createDataFrame([("u", [1.0, 0.0]), ("v", [1.0, 1.0])], "user_id string, features array<double>")
    new = spark.createDataFrame([("u", [0.0, 2.0]), ("v", [2.0, 2.0])], "user_id string, features array<double>")
    got = {r.user_id: r.cosine for r in ml.embedding_shift(old, new).collect()}
    assert got == {"u": 0.0, "v": pytest.approx(1.0)}


def test_ranker_separates_and_reports_importance(events, fitted):
    pairs = fitted[0]
    data = tr.build_training_set(pairs, ft.user_features(events), ft.item_features(events), 1).cache()
    model = ml.train_ranker(data, **SMALL)
    scored = ml.score(model, data)
    assert 0 <= scored.agg(F.min("score")).first()[0]
    folds, aucs = ml.cross_validate(tr.hash_folds(data, k=2), k=2, **SMALL)
    assert folds.count() == data.count() and min(aucs) > 0.9
    assert set(ml.feature_importance(model)) == set(ml.RANK_FEATURES)


def test_recommend_all_covers_every_user(spark, events, fitted):
    pairs, indexed, als = fitted
    users, items = ft.user_features(events), ft.item_features(events)
    new = users.limit(1).withColumn("user_id", F.lit("newcomer"))
    users = users.unionByName(new)
    ranker = ml.train_ranker(tr.build_training_set(pairs, users, items, 1), **SMALL)
    cats = items.select("item_id", F.array("category").alias("categories"))
    out = rc.recommend_all(ml.als_candidates(als, indexed, 8), ranker, pairs, users, items, ft.item_popularity(events),
                           wn.popularity_percentile(events), cats, 4).cache()
    per_user = {r.user_id: r["count"] for r in out.groupBy("user_id").count().collect()}
    assert len(per_user) == 21 and set(per_user.values()) == {4}
    assert out.where("user_id = 'newcomer'").select("source").distinct().first()[0] == "popular"


def test_warm_retrain_keeps_every_user(spark, events):
    pairs = ft.pair_features(events, "2023-12-01").select("user_id", "item_id", "interaction_count")
    idle = spark.createDataFrame([("idle", "i1", 0)], "user_id string, item_id string, interaction_count long")
    old = spark.createDataFrame([(f"i{i}", [1.0, float(i)]) for i in range(30)], "item_id string, features array<double>")
    users, items = ml.warm_retrain(pairs.unionByName(idle), old, rank=2, iters=2)
    assert users.count() == 21 and items.count() == 30
    assert users.where("user_id = 'idle'").first().features == [0.0, 0.0]


def test_promotion(spark):
    cols = "model string, metric_name string, value double"
    cur = spark.createDataFrame([("als", "ndcg", 0.2), ("rank", "ndcg", 0.5)], cols)
    new = spark.createDataFrame([("als", "ndcg", 0.3), ("rank", "ndcg", 0.5), ("new", "ndcg", 0.1)], cols)
    got = {r.model: r.decision for r in ml.promotion_decision(cur, new, "ndcg").collect()}
    assert got == {"als": "promote", "rank": "keep", "new": "promote"}
