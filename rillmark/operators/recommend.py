"""All-user recommendation job: candidates, ranking features, scores, re-ranking and fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.operators import models as ml
from rillmark.operators.boosting import Ranker
from rillmark.operators.rerank import cold_start, rerank
from rillmark.operators.training import NO_PAIR, with_features


def candidate_features(candidates: DataFrame, pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Candidates with pair features (the values of unseen pairs where there are none), user and item features."""
    known = candidates.join(pairs, ["user_id", "item_id"], "left")
    types = {f.name: f.dataType for f in pairs.schema.fields}
    fills = {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in NO_PAIR.items() if v is not None}
    return with_features(known.withColumns(fills), users, items)


def recommend_all(
    candidates: DataFrame, ranker: Ranker, pairs: DataFrame, users: DataFrame, items: DataFrame,
    popularity: DataFrame, percentiles: DataFrame, categories: DataFrame, k: int = 10,
) -> DataFrame:
    """Final lists of every user: score the candidates, dampen by popularity, diversify, and fall back to the popular items."""
    rows = candidate_features(candidates.select("user_id", "item_id"), pairs, users, items)
    scored = ml.score(ranker, rows).select("user_id", "item_id", "score")
    described = scored.join(percentiles.select("item_id", "popularity_percentile"), "item_id", "left").join(
        categories, "item_id", "left")
    lists = rerank(described, k)
    fallback = cold_start(users, candidates, popularity, k)
    return lists.withColumn("source", F.lit("model")).unionByName(fallback.withColumn("source", F.lit("popular")))
