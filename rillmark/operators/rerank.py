"""Re-ranking: popularity dampening, diversity, prefix rule, fallbacks and routing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.columns import dot, id_prefix
from rillmark.operators.scale import running_total, salted_join, top_per_group, value_pieces

# Fixed values of the dampening rule: percentile bounds (exclusive) and the percentile of unknown items.
POPULAR_ABOVE, RARE_BELOW, UNKNOWN_PERCENTILE = 0.90, 0.30, 0.5


def dampen(df: DataFrame, boost: float = 1.2, penalty: float = 0.8) -> DataFrame:
    """Lower the score of very popular items and raise that of rare ones."""
    p = F.coalesce("popularity_percentile", F.lit(UNKNOWN_PERCENTILE))
    factor = F.when(p > POPULAR_ABOVE, F.lit(penalty)).when(p < RARE_BELOW, F.lit(boost))
    return df.withColumn("score", F.when(factor.isNotNull(), F.col("score") * factor).otherwise(F.col("score")))


def top_items(df: DataFrame, k: int, out: str = "rank") -> DataFrame:
    """The ``k`` best items of every user, ties by item id."""
    return top_per_group(df, ["user_id"], [F.desc("score"), F.asc("item_id")], k, out)


def ranked_lists(df: DataFrame, rows: int = 0) -> DataFrame:
    """Every user's whole list numbered by score (ties by item id), with no bound on its length.

    Scores are cut into ranges of about ``rows`` rows, so that a long list is numbered in pieces.
    """
    placed = value_pieces(df.withColumn("_neg", -F.col("score")), "_neg", "_b", rows)
    numbered = running_total(placed, ["user_id"], "_b", ["_neg", "item_id"], F.lit(1), "rank")
    return numbered.drop("_neg", "_b")


def normalised(df: DataFrame) -> DataFrame:
    """Score divided by the user's best score (by 1 if that is not positive)."""
    best = df.groupBy("user_id").agg(F.max("score").alias("_m"))
    top = F.when(F.col("_m") > 0, F.col("_m")).otherwise(F.lit(1.0))
    return salted_join(df, best, "user_id").withColumn("relevance", F.col("score") / top).drop("_m")


def _whole_users(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole users (the first column), from batches that come sorted by user."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        if held and held[-1].column(0)[-1].as_py() != batch.column(0)[0].as_py():
            yield pa.Table.from_batches(held)
            held = []
        last = int(_starts(_codes(batch.column(0)))[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _codes(values: pa.Array) -> np.ndarray:
    """A number for every distinct value, null included."""
    return values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _starts(codes: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))


def _greedy(rows: pa.Table, k: int, lam: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The greedy choice of all users of a table at once (user_id, item_id, score, cats, in order): the first row of the user, the
    row picked (-1: none has a score) and the rank of every pick.

    The picked item leaves its user's rows by its id. Rows without a score are never picked; once only such rows are left, the list
    ends with an empty pick. A null id equals none and ends the list.
    """
    user, item, score, cats = (rows.column(c).combine_chunks() for c in range(4))
    starts = _starts(_codes(user))
    seg = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
    known = score.is_valid().to_numpy(zero_copy_only=False)
    points = score.fill_null(-np.inf).to_numpy(zero_copy_only=False)
    top = np.maximum.reduceat(points, starts)
    top = np.where((top > 0) | np.isnan(top), top, 1.0)
    with np.errstate(invalid="ignore", over="ignore"):
        relevance = lam * (points / top[seg])
    named, ids = item.is_valid().to_numpy(zero_copy_only=False), _codes(item)
    flat = cats.flatten()
    size = cats.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    row, first = np.repeat(np.arange(len(rows)), size), np.cumsum(size) - size
    key = seg[row] * (len(flat) + 1) + _codes(flat)

    sim, alive = np.zeros(len(rows)), np.ones(len(rows), bool)
    users, picks, ranks = [], [], []
    for rank in range(1, k + 1):
        left = np.unique(seg[alive])
        if not len(left):
            break
        open_ = np.flatnonzero(alive & known)
        best = np.full(len(starts), -1)
        if len(open_):
            with np.errstate(invalid="ignore"):
                value = relevance[open_] - (1.0 - lam) * sim[open_]
            begin = _starts(seg[open_])
            most = np.repeat(np.maximum.reduceat(value, begin), np.diff(np.append(begin, len(open_))))
            # The first row with the largest value: rows are sorted by score and id, which settles ties.
            hits = open_[(value == most) | (np.isnan(value) & np.isnan(most))]
            hits = hits[_starts(seg[hits])]
            best[seg[hits]] = hits
        users.append(starts[left])
        picks.append(best[left])
        ranks.append(np.full(len(left), rank))
        ends = (best < 0) | ~named[best]
        alive &= named & ~ends[seg] & (ids != ids[best][seg])
        chosen = best[best >= 0]
        held = np.sort(key[np.repeat(first[chosen] - np.cumsum(size[chosen]) + size[chosen], size[chosen])
                           + np.arange(int(size[chosen].sum()))])
        if len(held):
            at = np.minimum(np.searchsorted(held, key), len(held) - 1)
            shared = np.bincount(row[held[at] == key], minlength=len(rows))
            union = size + size[best][seg] - shared
            sim = np.maximum(sim, np.where(shared > 0, shared / np.maximum(union, 1), 0.0))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (users, picks, ranks))


def mmr(df: DataFrame, k: int = 10, lam: float = 0.7) -> DataFrame:
    """Maximal marginal relevance: pick ``k`` items per user, trading score against category overlap.

    Input: user_id, item_id, score, categories. Of items with equal category sets only the ``k`` best can ever be
    picked, so the others are dropped first (exact, and done before the shuffle). What is left per user is bounded by k
    times the number of distinct category sets. Spark brings each user's rows together in order; the greedy choice then runs
    over Arrow batches, for all users of a batch at once.
    """
    cats = F.array_sort(F.array_distinct(F.coalesce("categories", F.array().cast("array<string>"))))
    rows = df.select("user_id", "item_id", F.col("score").cast("double").alias("score"), cats.alias("cats"))
    kept = top_per_group(rows, ["user_id", "cats"], [F.desc("score"), F.asc("item_id")], k, "_r").drop("_r")
    lists = kept.repartition("user_id").sortWithinPartitions("user_id", (-F.col("score")).asc_nulls_first(), "item_id", "cats")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_users(batches):
            users, picks, ranks = _greedy(part, k, lam)
            picked = pa.array(picks, mask=picks < 0)
            yield from pa.table({"user_id": part.column("user_id").take(pa.array(users)),
                                 "item_id": part.column("item_id").take(picked), "score": part.column("score").take(picked),
                                 "rank": pa.array(ranks, pa.int32())}).combine_chunks().to_batches()

    out = T.StructType([lists.schema["user_id"], T.StructField("item_id", T.StringType()), T.StructField("score", T.DoubleType()),
                        T.StructField("rank", T.IntegerType())])
    return lists.withColumn("item_id", F.col("item_id").cast("string")).mapInArrow(choose, out)


def rerank(df: DataFrame, k: int = 10, lam: float = 0.7) -> DataFrame:
    """Dampening, then diversity."""
    return mmr(dampen(df), k, lam)


def prefix_rerank(df: DataFrame, n: int, penalty: float = 0.8) -> DataFrame:
    """Keep the best ``n`` per user, lower items whose id prefix appeared higher up, round and sort again."""
    kept = top_items(df, n, "_r")
    seen = Window.partitionBy("user_id", "_p").orderBy("_r")
    scored = kept.withColumn("_p", id_prefix("item_id")).withColumn("_k", F.row_number().over(seen)).withColumn(
        "score", F.round(F.when(F.col("_k") > 1, F.col("score") * penalty).otherwise(F.col("score")), 4))
    final = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("_r"))
    return scored.withColumn("rank", F.row_number().over(final)).select("user_id", "item_id", "score", "rank")


def dot_scores(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """Inner product of user and item factors for given pairs."""
    u = user_factors.select("user_id", F.col("features").alias("_u"))
    i = item_factors.select("item_id", F.col("features").alias("_i"))
    return pairs.join(u, "user_id").join(i, "item_id").withColumn("score", dot("_u", "_i")).drop("_u", "_i")


def popular_items(popularity: DataFrame, k: int) -> DataFrame:
    """The ``k`` most popular items with position 0..k-1, as one array row (k is the length of a list)."""
    top = popularity.orderBy(F.desc("popularity"), F.asc("item_id")).limit(k)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("popularity")).alias("neg"), "item_id")))
    return top.groupBy().agg(F.transform(listed, lambda s: s["item_id"]).alias("items"))


def cold_start(users: DataFrame, recs: DataFrame, popularity: DataFrame, k: int = 10) -> DataFrame:
    """The popular list, scores 1.00, 0.99, ..., for users without recommendations."""
    items = popular_items(popularity, k).scalar()
    missing = users.select("user_id").distinct().join(recs.select("user_id").distinct(), "user_id", "left_anti")
    return missing.select("user_id", F.posexplode(items).alias("pos", "item_id")).select(
        "user_id", "item_id", F.round(F.lit(1.0) - F.lit(0.01) * F.col("pos"), 4).alias("score"),
        (F.col("pos") + 1).alias("rank"))


def fresh_recs(snapshots: DataFrame, as_of, ttl_s: int = 300, num: int = 10) -> DataFrame:
    """Newest stored list per user and group if it is at most ``ttl_s`` seconds old, cut to ``num``.

    The age filter comes first and reaches the scan: if the newest list is fresh it is among the fresh ones.
    """
    at = F.lit(as_of).cast("timestamp")
    fresh = snapshots.where(
        (F.col("created_at") >= at - F.expr(f"INTERVAL {int(ttl_s)} SECONDS")) & (F.col("created_at") <= at))
    newest = fresh.groupBy("user_id", "group").agg(F.max("created_at").alias("created_at"))
    return fresh.where(F.col("rank") <= num).join(newest, ["user_id", "group", "created_at"], "left_semi")


def route_recs(routed: DataFrame, recs: DataFrame) -> DataFrame:
    """Recommendations of the model version each user is routed to. ``routed`` holds one row per user."""
    return recs.join(routed.select("user_id", "model_version", "served_group"), ["user_id", "model_version"])
