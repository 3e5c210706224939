import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillmark.operators import boosting as bo
from rillmark.operators import models as ml
from rillmark.session import scratch_dir
from rillmark.sources import store

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Labels that need several features at once; ``a`` goes with the user, ``b`` with the item, ``c`` has many values."""
    rnd = np.random.default_rng(3)
    n = 4000
    user, item = rnd.integers(0, 60, n), rnd.integers(0, 25, n)
    x = np.column_stack([rnd.normal(size=60).round(1)[user], rnd.normal(size=25).round(1)[item], rnd.normal(size=n),
                         rnd.integers(0, 6, n)])
    y = (rnd.random(n) < 1 / (1 + np.exp(-3 * (x[:, 0] * x[:, 1] + np.sin(2 * x[:, 2]) - 0.2 * x[:, 3])))).astype(int)
    table = pd.DataFrame(x, columns=NAMES).assign(user_id=[f"u{u}" for u in user], item_id=[f"i{i}" for i in item], label=y)
    table["fold"] = np.arange(n) % 4
    return x, y, spark.createDataFrame(table).repartition(5).cache()


def grow(x, y, edges, trees, depth, rate):
    """Trees by the best leaf, all rows at hand: the scores after each tree."""
    bins = np.stack([np.searchsorted(np.asarray(e), x[:, j]) for j, e in enumerate(edges)])
    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)

        def best(at, g=g, h=h):
            own, found = g[at].sum() ** 2 / h[at].sum(), None
            for f, e in enumerate(edges):
                for cut in range(len(e)):
                    low, high = at[bins[f, at] <= cut], at[bins[f, at] > cut]
                    n = round(h[low].sum() * len(at) / h[at].sum())
                    if min(n, len(at) - n) < 20 or min(h[low].sum(), h[high].sum()) < 1e-3:
                        continue
                    gain = g[low].sum() ** 2 / h[low].sum() + g[high].sum() ** 2 / h[high].sum() - own
                    if gain > 1e-9 and (found is None or gain > found[0] * (1 + 1e-9)):
                        found = gain, low, high
            return found

        leaves = [(np.arange(len(y)), 0, best(np.arange(len(y))))]
        while len(leaves) < 31 and (able := [x for x in leaves if x[2]]):
            leaf = max(able, key=lambda x: x[2][0])
            leaves = [x for x in leaves if x is not leaf]
            leaves += [(side, leaf[1] + 1, best(side) if leaf[1] + 1 < depth else None) for side in leaf[2][1:]]
        for at, _, _ in leaves:
            score[at] -= rate * g[at].sum() / h[at].sum()
    return score


def test_trees_are_those_of_leafwise_newton_boosting(rows, monkeypatch):
    x, y, df = rows
    monkeypatch.setattr(bo, "CHUNK", 700)
    model = ml.train_ranker(df, NAMES, trees=3, folds=0)
    want = grow(x, y, model.edges, 3, 5, 0.1)
    assert np.allclose(model.margins(list(x.T)), want, atol=1e-6)
    assert all(20 < sum(f < 0 for f in t.feature) <= 31 for t in model.trees)
    scores = ml.score(model, df).agg(F.sum("score")).first()[0]
    assert scores == pytest.approx((1 / (1 + np.exp(-want))).sum(), abs=1e-3)


def test_folds_train_in_common_passes_like_alone(rows):
    x, y, df = rows
    few = ["a", "b", "d"]  # all of whose values are in every fold
    together = bo.fit(df, few, [0, 3, None], 4, 3, 0.1)
    alone = [bo.fit(df.where(f"fold <> {f}"), few, [None], 4, 3, 0.1)[0] for f in (0, 3)] + [bo.fit(df, few, [None], 4, 3, 0.1)[0]]
    values = [x[:, NAMES.index(f)] for f in few]
    for a, b in zip(together, alone, strict=True):
        assert np.allclose(a.margins(values), b.margins(values), atol=1e-6)


def test_training_reports_the_auc_of_five_folds(rows):
    _, y, df = rows
    model = ml.train_ranker(df, NAMES, trees=5, depth=3)
    assert len(model.aucs) == 5 and all(0.7 < a < 0.95 for a in model.aucs)
    folds, aucs = ml.cross_validate(df, 4, NAMES, trees=5, depth=3)
    scored = folds.select("score", "label", "fold").toPandas()
    assert len(scored) == len(y)
    for i, got in enumerate(aucs):
        part = scored[scored["fold"] == i]
        up, down = (part.score[part.label == v].to_numpy() for v in (1, 0))
        wins = (up[:, None] > down).mean() + 0.5 * (up[:, None] == down).mean()
        assert got == pytest.approx(wins)
    assert 0.7 < model.auc < 0.95 and model.auc != 1.0


def test_bins_come_from_all_rows(spark):
    df = spark.range(0, 5000, 1, 4).select(F.col("id").cast("double").alias("many"), (F.col("id") % 7).cast("double").alias("few"),
                                           F.when(F.col("id") == 4999, 1.0).otherwise(0.0).alias("rare"))
    many, few, rare = bo.bin_edges(df, ["many", "few", "rare"])
    assert few == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and rare == [0.5]
    sizes = np.bincount(np.searchsorted(many, np.arange(5000.0)))
    assert len(many) == 254 and sizes.max() <= 22


def test_one_label_or_one_value_gives_constant_scores(spark):
    df = spark.range(100).select(F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.lit("i").alias("item_id"), F.lit(2.0).alias("x"),
                                 (F.col("id") % 4 == 0).cast("int").alias("label"))
    flat = ml.train_ranker(df, ["x"], trees=2, folds=0)
    assert flat.trees == [] and ml.score(flat, df).select(F.round("score", 9)).distinct().collect() == [(0.25,)]
    ones = ml.train_ranker(df.where("label = 1"), ["x"], trees=2, folds=0)
    assert ml.score(ones, df).agg(F.min("score")).first()[0] > 0.999999
    with pytest.raises(ValueError):
        ml.train_ranker(df.where("false"), ["x"], folds=0)


def test_ranker_survives_storage(spark, rows):
    x, _, df = rows
    model = ml.train_ranker(df, NAMES, trees=2, depth=2, folds=0)
    path = scratch_dir(spark, "ranker")
    store.save_model(model, path)
    assert bo.Ranker.load(path) == model
    store.save_model(model, path)
    assert ml.feature_importance(model) == dict(zip(NAMES, model.importances(), strict=True))
