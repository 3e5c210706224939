"""Implicit factorisation that starts from given factors: confidence-weighted half-sweeps by joins and partial sums."""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import dot
from rillmark.operators import models as ml
from rillmark.session import checkpointed

ROWS = 1 << 14  # pairs that one task holds at once; a user or item with more is summed in parts


@dataclasses.dataclass
class WarmFit:
    """Factors (id, features) of both sides, the loss before and after every sweep, and how many users the first half-sweep solved."""

    users: DataFrame
    items: DataFrame
    losses: list[float]
    solved_first: int


def random_factors(ids: DataFrame, key: str, rank: int, seed: int = 42) -> DataFrame:
    """Starting factors drawn by hash: the same in every run."""
    draw = F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), lambda j: (F.pmod(F.xxhash64(F.col(key), j, F.lit(seed)), F.lit(2001)) - 1000)
                       / F.lit(1000.0 * rank ** 0.5))
    return ids.select(key).distinct().select(key, draw.alias("features"))


def _block_solver(gram: np.ndarray, reg: float, alpha: float):
    k = len(gram)
    base = gram + reg * np.eye(k)

    def run(block: pa.Table) -> pa.Table:
        ids = block.column("id")
        _, code = np.unique(ids.to_numpy(), return_inverse=True)
        order = np.argsort(code, kind="stable")
        y = np.stack(block.column("v").to_numpy())[order]
        w = alpha * block.column("w").to_numpy()[order]
        parts = block.column("parts").to_numpy()[order]
        ends = np.flatnonzero(np.diff(code[order], append=-1)) + 1
        solved, partial = [], []
        for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
            left, right = (y[a:b].T * w[a:b]) @ y[a:b], y[a:b].T @ (1 + w[a:b])
            one = parts[a] == 1
            solved.append(np.linalg.solve(base + left, right) if one else None)
            partial.append(None if one else np.concatenate([left.ravel(), right]))
        return pa.table({"id": ids.take(pa.array(order[ends - 1])), "features": pa.array(solved, pa.list_(pa.float64())),
                         "partial": pa.array(partial, pa.list_(pa.float64()))})

    return run


def half_sweep(pairs: DataFrame, key: str, other: str, factors: DataFrame, gram: np.ndarray, reg: float = 0.1,
               alpha: float = 1.0, weight: str = "interaction_count") -> DataFrame:
    """The best factors of one side with the other side's held fixed: (key, features) of every id that has a pair.

    x = (YᵀY + Yᵀ(C - I)Y + reg I)⁻¹ YᵀC1 with confidence 1 + alpha * weight over the pairs of the id. Ids are dealt in blocks of about
    ROWS pairs and solved there. An id with more pairs than that is spread over several blocks, which each give a partial
    matrix and vector; those are summed before the system is solved. Pairs whose other side has no factors do not count.
    """
    k = len(gram)
    y = factors.select(F.col(other).alias("_other"), F.col("features").cast("array<double>").alias("v"))
    rows = pairs.select(F.col(key).alias("id"), F.col(other).alias("_other"), F.col(weight).cast("double").alias("w"))
    counts = rows.groupBy("id").agg(F.ceil(F.count("*") / F.lit(ROWS)).cast("int").alias("parts"))
    blocks = max(1, -(-rows.count() // ROWS))
    part = F.pmod(F.xxhash64("id", "_other"), F.col("parts"))
    rows = rows.join(counts, "id").join(y, "_other").withColumn("block", F.pmod(F.xxhash64("id", part), F.lit(blocks)))
    kind = pairs.schema[key].dataType.simpleString()
    # written once: whole solutions and partial sums are read apart
    found = checkpointed(rows.select("block", "id", "v", "w", "parts").groupBy("block").applyInArrow(
        _block_solver(gram, reg, alpha), f"id {kind}, features array<double>, partial array<double>"), "half-sweep")
    base = gram + reg * np.eye(k)

    @F.pandas_udf("array<double>")
    def solve(total: pd.Series) -> pd.Series:
        return pd.Series([np.linalg.solve(base + t[:k * k].reshape(k, k), t[k * k:]) for t in map(np.asarray, total)])

    summed = found.where("partial IS NOT NULL").groupBy("id").agg(Summarizer.sum(array_to_vector("partial")).alias("t"))
    wide = summed.select("id", solve(vector_to_array("t")).alias("features"))
    whole = found.where("features IS NOT NULL").select("id", "features")
    return whole.unionByName(wide).withColumnRenamed("id", key)


def _gram(factors: DataFrame, rank: int) -> np.ndarray:
    out = np.zeros((rank, rank))
    for c in ml.gram_matrix(factors).collect():  # rank x rank numbers
        out[c["i"], c["j"]] = c["value"]
    return out


def loss(pairs: DataFrame, users: DataFrame, items: DataFrame, rank: int, reg: float = 0.1, alpha: float = 1.0,
         weight: str = "interaction_count") -> float:
    """Confidence-weighted squared error over all user-item pairs, seen or not, plus the penalty.

    The part of all pairs is tr(XᵀX YᵀY); only the observed pairs are joined.
    """
    x, y = _gram(users, rank), _gram(items, rank)
    joined = pairs.join(users.select("user_id", F.col("features").alias("_x")), "user_id", "left").join(
        items.select("item_id", F.col("features").alias("_y")), "item_id", "left")
    s = F.coalesce(dot("_x", "_y"), F.lit(0.0))
    c = 1 + alpha * F.col(weight).cast("double")
    seen = joined.agg(F.sum(c * (1 - s) * (1 - s) - s * s)).first()[0] or 0.0
    return float(seen + np.trace(x @ y) + reg * (np.trace(x) + np.trace(y)))


def changed_users(pairs: DataFrame, before: DataFrame, weight: str = "interaction_count") -> DataFrame:
    """Users with a pair that is new, gone or of another weight than before."""
    new = pairs.select("user_id", "item_id", F.col(weight).alias("w"))
    old = before.select("user_id", "item_id", F.col(weight).alias("o"))
    both = new.join(old, ["user_id", "item_id"], "full").where(~F.col("w").eqNullSafe(F.col("o")))
    return both.select("user_id").distinct()


def warm_fit(pairs: DataFrame, users: DataFrame | None, items: DataFrame, changed: DataFrame | None = None, reg: float = 0.1,
             alpha: float = 1.0, rank: int = 64, sweeps: int = 10, bound: float = 1e-3) -> WarmFit:
    """Fit positive ``pairs`` (user_id, item_id, interaction_count) from the given factors.

    The first half-sweep solves only the ``changed`` users (all, if none are named) and keeps the others' factors; then items and users are
    solved in turn. It ends when a sweep lowers the loss by less than ``bound`` of it, or after ``sweeps``. An item that is new
    starts without factors and gets them in the first half-sweep of items. Each side is written once per half-sweep.
    """
    pairs = checkpointed(pairs.where(F.col("interaction_count") > 0).select("user_id", "item_id", "interaction_count"), "pairs")
    ids = pairs.select("user_id").distinct()
    some = pairs
    if users is not None and changed is not None:
        some = pairs.join(changed.select("user_id").union(ids.join(users, "user_id", "left_anti")).distinct(), "user_id", "left_semi")
    items = checkpointed(items.select("item_id", F.col("features").cast("array<double>").alias("features")), "items")
    fresh = checkpointed(half_sweep(some, "user_id", "item_id", items, _gram(items, rank), reg, alpha), "users")
    solved = fresh.count()
    if users is not None:
        kept = users.select("user_id", F.col("features").cast("array<double>").alias("features"))
        kept = kept.join(ids, "user_id", "left_semi").join(some.select("user_id").distinct(), "user_id", "left_anti")
        fresh = checkpointed(fresh.unionByName(kept), "users")
    users = fresh
    losses = [loss(pairs, users, items, rank, reg, alpha)]
    for _ in range(sweeps):
        items = checkpointed(half_sweep(pairs, "item_id", "user_id", users, _gram(users, rank), reg, alpha), "items")
        users = checkpointed(half_sweep(pairs, "user_id", "item_id", items, _gram(items, rank), reg, alpha), "users")
        losses.append(loss(pairs, users, items, rank, reg, alpha))
        if losses[-2] - losses[-1] < bound * abs(losses[-2]):
            break
    return WarmFit(users, items, losses, solved)


def cold_fit(pairs: DataFrame, rank: int = 64, seed: int = 42, **options) -> WarmFit:
    """The same fit from random item factors."""
    return warm_fit(pairs, None, random_factors(pairs, "item_id", rank, seed), rank=rank, **options)


def fit_metrics(model: str, fit: WarmFit) -> DataFrame:
    """The fit as a metric table (model, metric_name, value) for the promotion decision; a higher value is better."""
    return fit.users.sparkSession.createDataFrame([(model, "negative_loss", -fit.losses[-1])], "model string, metric_name string, value double")
