"""Recommendation models: factorisation, ranker, fold-in of new behaviour, comparison of versions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.columns import cosine, sha_int
from rillmark.operators import boosting
from rillmark.operators.boosting import Ranker
from rillmark.operators.evaluate import auc
from rillmark.operators.features import impute
from rillmark.operators.scale import dense_index
from rillmark.operators.topn import top_items
from rillmark.session import checkpointed, scratch_dir

# Feature columns of the ranker. Fixed values of the contract, with the suffixes of the joined training row.
RANK_FEATURES = [
    "total_interactions", "total_clicks_user", "total_views_user", "total_ratings", "avg_rating_given",
    "interaction_days", "total_views_item", "total_clicks_item", "click_through_rate", "avg_rating_received",
    "rating_count", "interaction_count", "time_since_last_interaction", "user_item_rating",
]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage in the shared checkpoint folder; one is named only where none is set."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoints"))


def index_pairs(pairs: DataFrame) -> DataFrame:
    """Add the integer ids a factorisation needs: a distributed numbering in place of a label list on the driver."""
    users = dense_index(pairs, "user_id", "user_index")
    items = dense_index(pairs, "item_id", "item_index")
    return pairs.join(users, "user_id").join(items, "item_id").withColumns(
        {c: F.col(c).cast("int") for c in ("user_index", "item_index")})


def train_als(
    indexed: DataFrame, rank: int = 64, iters: int = 15, reg: float = 0.1, seed: int = 42,
    rating: str = "interaction_count", blocks: int = 0,
) -> ALSModel:
    """Implicit-feedback factorisation of observed pairs with their count as confidence.

    Only pairs with a positive weight take part: a user whose rows are all zero makes the implicit system singular.
    """
    ensure_checkpoint_dir(indexed.sparkSession)
    blocks = blocks or max(1, indexed.sparkSession.sparkContext.defaultParallelism)  # one per core of the cluster
    als = ALS(
        rank=rank, maxIter=iters, regParam=reg, implicitPrefs=True, userCol="user_index", itemCol="item_index",
        ratingCol=rating, coldStartStrategy="drop", seed=seed, checkpointInterval=5, numUserBlocks=blocks,
        numItemBlocks=blocks,
    )
    rows = indexed.select("user_index", "item_index", F.col(rating).cast("float").alias(rating))
    return als.fit(rows.where(F.col(rating) > 0))


def ids_of(indexed: DataFrame, kind: str) -> DataFrame:
    return indexed.select(f"{kind}_id", f"{kind}_index").distinct()


def named_factors(model: ALSModel, indexed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Factor tables under the original ids: (user_id, features), (item_id, features)."""
    out = []
    for kind, factors in (("user", model.userFactors), ("item", model.itemFactors)):
        out.append(factors.join(ids_of(indexed, kind), F.col("id") == F.col(f"{kind}_index")).select(f"{kind}_id", "features"))
    return out[0], out[1]


def als_candidates(model: ALSModel, indexed: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` best items of every user: user_id, item_id, rank, score. Exact, and not by all pairs (see ``topn``)."""
    users, items = named_factors(model, indexed)
    return top_items(users, items, n).rows


def _out_of_fold(df: DataFrame, models: list[Ranker]) -> DataFrame:
    """Every row scored by the model that has not seen its ``fold``."""
    return df.withColumn("score", boosting.probability(dict(enumerate(models)), models[0].features, F.col("fold")))


def _fold_aucs(scored: DataFrame, k: int) -> list[float]:
    """The AUC of each fold; NaN where a fold lacks a label."""
    found = [auc(scored.where(F.col("fold") == i)).first()["auc"] for i in range(k)]
    return [float("nan") if a is None else a for a in found]


def train_ranker(
    df: DataFrame, features: list[str] | None = None, trees: int = 100, depth: int = 5, rate: float = 0.1, seed: int = 42,
    folds: int = 5,
) -> Ranker:
    """Gradient-boosted trees (see ``boosting``) on imputed features and ``label``, with the AUC of ``folds`` folds.

    The models of the folds grow beside the one on all rows, which is returned; its ``aucs`` and ``auc`` are of out-of-fold
    scores. Folds are drawn by hash of user, item and ``seed``. ``folds=0`` only fits.
    """
    ensure_checkpoint_dir(df.sparkSession)
    features = features or RANK_FEATURES
    keys = [c for c in ("user_id", "item_id") if c in df.columns] or features
    ready = impute(df, features, 0)
    if not folds:
        return boosting.fit(ready, features, [None], trees, depth, rate)[0]
    ready = ready.withColumn("fold", (sha_int(*keys, F.lit(str(seed)), F.lit("fold")) % folds).cast("int"))
    *parts, model = boosting.fit(ready, features, [*range(folds), None], trees, depth, rate)
    scored = checkpointed(_out_of_fold(ready, parts).select("fold", "label", "score"), "out-of-fold")
    model.aucs, model.auc = _fold_aucs(scored, folds), auc(scored).first()["auc"]
    return model


def score(model: Ranker, df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Add ``score``, the probability of label 1."""
    features = features or model.features
    return impute(df, features, 0).withColumn("score", boosting.probability({0: model}, features, F.lit(0)))


def feature_importance(model: Ranker, features: list[str] | None = None) -> dict[str, float]:
    """How many splits of the trees use each feature."""
    return dict(zip(features or model.features, model.importances()))


def cross_validate(
    df: DataFrame, k: int = 5, features: list[str] | None = None, trees: int = 100, depth: int = 5, rate: float = 0.1,
) -> tuple[DataFrame, list[float]]:
    """Out-of-fold scores and the AUC of each fold. ``df`` has a ``fold`` column 0..k-1."""
    ensure_checkpoint_dir(df.sparkSession)
    features = features or RANK_FEATURES
    ready = impute(df.where(F.col("fold").isNotNull()), features, 0)
    models = boosting.fit(ready, features, list(range(k)), trees, depth, rate)
    held = _out_of_fold(ready.where(F.col("fold").between(0, k - 1)), models)
    return held, _fold_aucs(held, k)


def gram_matrix(factors: DataFrame) -> DataFrame:
    """Sum over items of y yT, as (i, j, value) rows.

    Each task multiplies its own batches and emits one k x k partial; only those partials are shuffled, never the k*k
    products of single items.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                y = np.stack(pdf["features"].to_numpy()).astype("float64")
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    parts = factors.select(F.col("features").cast("array<double>").alias("features")).mapInPandas(
        partial, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def fold_in_rhs(interactions: DataFrame, factors: DataFrame) -> DataFrame:
    """Sum of rating * y per user, over the last rating of each known item; unknown items are ignored.

    ``interactions``: user_id, item_id, rating, timestamp. The vectors are summed by an aggregate with partial sums, one row
    per interaction.
    """
    last = interactions.groupBy("user_id", "item_id").agg(
        F.max_by("rating", F.struct("timestamp", "rating")).cast("double").alias("rating"))
    y = factors.select("item_id", F.col("features").cast("array<double>").alias("_y"))
    weighted = last.join(y, "item_id").select(
        "user_id", array_to_vector(F.transform("_y", lambda v: v * F.col("rating"))).alias("_v"))
    return weighted.groupBy("user_id").agg(Summarizer.sum(F.col("_v")).alias("_b")).select(
        "user_id", vector_to_array("_b").alias("rhs"))


def gram_inverse(factors: DataFrame, reg: float = 0.1, rank: int = 0) -> np.ndarray:
    """(YtY + reg I)^-1. Its k x k cells, k being the rank of the factors, are all that reaches the driver.

    ``rank`` is the k of a table without factors.
    """
    cells = gram_matrix(factors).collect()
    k = max((1 + c["i"] for c in cells), default=rank)
    gram = np.zeros((k, k))
    for c in cells:
        gram[c["i"], c["j"]] = c["value"]
    return np.linalg.inv(gram + reg * np.eye(k))


def fold_in(interactions: DataFrame, factors: DataFrame, reg: float = 0.1, inverse: np.ndarray | None = None,
            rank: int = 0) -> DataFrame:
    """New user factors with item factors held fixed: (YtY + reg I)^-1 Yt r per user.

    ``inverse`` may be passed in where many batches meet the same item factors. Users without a known item get a
    zero vector, of length ``rank`` if there are no factors at all.
    """
    inverse = gram_inverse(factors, reg, rank) if inverse is None else inverse

    @F.pandas_udf("array<double>")
    def solve(rhs: pd.Series) -> pd.Series:
        if not len(rhs):
            return rhs
        return pd.Series(list(np.stack(rhs.to_numpy()) @ inverse.T))

    solved = fold_in_rhs(interactions, factors).select("user_id", solve("rhs").alias("features"))
    users = interactions.select("user_id").distinct()
    zero = F.array_repeat(F.lit(0.0), len(inverse))
    return users.join(solved, "user_id", "left").select("user_id", F.coalesce("features", zero).alias("features"))


def embedding_shift(old: DataFrame, new: DataFrame, key: str = "user_id") -> DataFrame:
    """Cosine similarity of each key's old and new factors."""
    pair = old.select(key, F.col("features").alias("_o")).join(new.select(key, F.col("features").alias("_n")), key)
    return pair.select(key, cosine("_o", "_n").alias("cosine"))


def warm_retrain(pairs: DataFrame, old_items: DataFrame, rank: int = 64, iters: int = 15, reg: float = 0.1,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Refit, then give users without any positive weight in the fit a vector by fold-in on the old item factors.

    The library's factorisation takes no starting factors, so continuity comes from the fold-in.
    """
    indexed = checkpointed(index_pairs(pairs), "indexed")
    users, items = named_factors(train_als(indexed, rank, iters, reg, seed), indexed)
    rest = pairs.join(users.select("user_id"), "user_id", "left_anti")
    stamp = rest.select("user_id", "item_id", F.col("interaction_count").alias("rating"), F.lit(0).alias("timestamp"))
    folded = fold_in(stamp, old_items, reg)
    return users.select("user_id", F.col("features").cast("array<double>").alias("features")).unionByName(folded), items


def promotion_decision(current: DataFrame, candidate: DataFrame, metric: str, min_gain: float = 0.0) -> DataFrame:
    """Whether the candidate replaces the current version: tables of (model, metric_name, value)."""
    def of(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col("metric_name") == metric).select("model", F.col("value").alias(name))

    better = F.col("current_value").isNull() | (F.col("candidate_value") > F.col("current_value") + F.lit(min_gain))
    return of(candidate, "candidate_value").join(of(current, "current_value"), "model", "left").withColumn(
        "decision", F.when(better, "promote").otherwise("keep"))
