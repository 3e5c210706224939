"""Exact best items of every user by inner product, without comparing all pairs."""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from rillmark.operators.scale import top_per_group
from rillmark.session import checkpointed

BLOCK = 2048  # items of a block
TASK_BYTES = 32 << 20  # vectors of one side that meet in a task
PRODUCTS = 1 << 22  # inner products held at once
_STEPS = 16  # norm classes per factor of two
_SLACK = 1e-9  # relative rounding error allowed for in a bound


@dataclasses.dataclass
class TopItems:
    """``rows`` (user, item, rank, score), and for each round how many users were still open, pairs compared and vectors sent."""

    rows: DataFrame
    rounds: list[dict]

    @property
    def compared(self) -> int:
        return sum(r["pairs"] for r in self.rounds)


def _vectors(df: DataFrame, key: str) -> DataFrame:
    """(id, v, norm) of the rows that have both; of rows that share an id the least vector counts."""
    v = F.col("features").cast("array<double>")
    rows = df.where(F.col(key).isNotNull() & F.col("features").isNotNull()).groupBy(F.col(key).alias("id")).agg(F.min(v).alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def norm_blocks(items: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Items in blocks of about ``size`` of similar norm: (block, id, v) and (block, bound, items), block 0 having the longest.

    Norms are put in geometric classes and a class is dealt by hash, so nothing is sorted and equal norms fill no task. The
    second table has one row per ``size`` items.
    """
    level = F.when(F.col("norm") > 0, F.floor(F.log2("norm") * _STEPS)).otherwise(F.lit(-(1 << 20))).cast("int")
    placed = items.withColumn("level", level)
    counts = placed.groupBy("level").agg(F.ceil(F.count("*") / size).alias("parts"))
    placed = placed.join(F.broadcast(counts), "level")  # a class per _STEPS-th of a factor of two: some 35 000 at most
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    placed = checkpointed(placed.drop("parts"), "norm-classes")
    blocks = placed.groupBy("level", "part").agg(F.max("norm").alias("bound"), F.count("*").alias("items"))
    order = Window.orderBy(F.desc("bound"), "level", "part")
    blocks = checkpointed(blocks.withColumn("block", F.row_number().over(order) - 1), "norm-blocks")
    return placed.join(blocks.select("level", "part", "block"), ["level", "part"]).select("block", "id", "v"), blocks.select(
        "block", "bound", "items")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack(column.to_numpy())


def _best(candidates: list[tuple], floor: np.ndarray, margin: np.ndarray, n: int) -> tuple:
    """The candidates (row, column, score) that can still be among their row's ``n`` best; raises ``floor`` to the n-th found."""
    row, col, score = (np.concatenate(c) for c in zip(*candidates, strict=True))
    order = np.lexsort((-score, row))
    row, col, score = row[order], col[order], score[order]
    at = np.arange(len(row)) - np.searchsorted(row, row)
    nth = at == n - 1
    floor[row[nth]] = np.maximum(floor[row[nth]], score[nth] - margin[row[nth]])
    kept = score >= floor[row]
    return row[kept], col[kept], score[kept]


def _best_of(n: int):
    def run(key: tuple, users: pa.Table, items: pa.Table) -> pa.Table:
        ids, names = users.column("id"), items.column("id")

        def out(row: np.ndarray, col: np.ndarray, score: np.ndarray, pairs: int) -> pa.Table:
            """The rows found, and one without item that holds how many pairs were compared."""
            who, what = (c.take(pa.array(x)).combine_chunks() for c, x in ((ids, row), (names, col)))
            return pa.table({"user": pa.chunked_array([who, pa.nulls(1, who.type)]), "item": pa.chunked_array([what, pa.nulls(1, what.type)]),
                             "score": np.append(score, np.nan), "pairs": pa.array([0] * len(row) + [pairs], pa.int64())})

        none = np.array([], "int64")
        if not len(users) or not len(items):
            return out(none, none, np.array([]), 0)
        # blocks in order, users by falling number of blocks that their norm lets them reach: those of a block come first
        block = items.column("block").to_numpy()
        at = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.diff(block[at], prepend=-1))
        bounds = np.nan_to_num(items.column("bound").to_numpy().astype("float64"), nan=np.inf)[at][first] * (1 + _SLACK)
        norm = np.nan_to_num(users.column("norm").to_numpy().astype("float64"), nan=np.inf)
        last = np.nan_to_num(users.column("last").to_numpy().astype("float64"), nan=-np.inf, posinf=np.inf)
        reach = np.concatenate([(norm[i:i + 4096, None] * bounds >= last[i:i + 4096, None]).sum(1) for i in range(0, len(norm), 4096)])
        by = np.argsort(-reach, kind="stable")
        reach, x, y = reach[by], _matrix(users.column("v"))[by], _matrix(items.column("v"))[at]
        odd = not (np.isfinite(x).all() and np.isfinite(y).all())
        largest = [np.abs(np.where(np.isfinite(m), m, 0)) if odd else np.abs(m) for m in (x, y)]
        # entries within rounding of a user's n-th best are multiplied again one by one, so equal vectors score alike
        margin = _SLACK * (largest[0].max(1) * largest[1].max() * x.shape[1])
        floor, found, held, pairs = last[by] - margin, [], 0, 0
        for j, (start, end) in enumerate(zip(first, [*first[1:], len(at)], strict=True)):
            for i in range(0, int((reach > j).sum()), PRODUCTS // (end - start) or 1):
                k = min(int((reach > j).sum()), i + (PRODUCTS // (end - start) or 1))
                products = x[i:k] @ y[start:end].T
                pairs += products.size
                if odd:
                    products[np.isnan(products)] = -np.inf
                many = i + np.flatnonzero((products >= floor[i:k, None]).sum(1) > n)
                if len(many):
                    nth = np.partition(products[many - i], -n, axis=1)[:, -n]
                    floor[many] = np.maximum(floor[many], nth - margin[many])
                row, col = np.nonzero(products >= floor[i:k, None])
                found.append((row + i, col + start, products[row, col]))
                held += len(row)
                if held > 2 * n * len(x) + PRODUCTS // 8:
                    found = [_best(found, floor, margin, n)]
                    held = len(found[0][0])
        if not found:
            return out(none, none, np.array([]), 0)
        row, col, _ = _best(found, floor, margin, n)
        parts = [np.einsum("ij,ij->i", x[row[i:i + 65536]], y[col[i:i + 65536]]) for i in range(0, len(row), 65536)]
        score = np.concatenate(parts) if parts else np.array([])
        real = ~np.isnan(score)
        return out(by[row[real]], at[col[real]], score[real], pairs)

    return run


def top_items(users: DataFrame, items: DataFrame, n: int, user: str = "user_id", item: str = "item_id",
              size: int = BLOCK) -> TopItems:
    """The ``n`` items with the largest inner product for every user, ties by smaller item id; all items if there are fewer.

    ``users`` and ``items`` hold an id and ``features`` of one common length. Items are cut into blocks by falling norm. Rounds of 1, 2, 4, ...
    blocks follow each other; a user meets a block only if its norm times the block's largest norm reaches the user's n-th
    score so far (no item of the block can score higher, by Cauchy and Schwarz). A user that no later block can serve is closed.
    Nothing is dropped, so the result is that of all pairs. What is shuffled does not depend on ``size``: users are dealt to teams and
    a round's blocks to sections, as many as the cores ask for and TASK_BYTES of vectors to each at most. An item is sent once to each
    team, a user once to each section that it reaches; block by block they are compared in the task, which sends on the n best.

    Rows with a null id or vector take no part. Without users or items the result is empty.
    """
    who = checkpointed(_vectors(users, user), "users")
    sized = who.groupBy().agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("width")).first()
    most = max(size, TASK_BYTES // (8 * max(1, sized["width"])))
    listed, blocks = norm_blocks(_vectors(items, item), size)
    listed = checkpointed(listed.join(blocks.select("block", "bound"), "block"), "item-blocks")
    count = blocks.count()
    tasks = 2 * users.sparkSession.sparkContext.defaultParallelism
    schema = (f"user {who.schema['id'].dataType.simpleString()}, item {listed.schema['id'].dataType.simpleString()}, score double, "
              "pairs bigint")
    best, rounds, first = None, [], 0
    while first < count:
        in_round = (F.col("block") >= first) & (F.col("block") < 2 * first + 1)
        taken = min(count, 2 * first + 1) - first
        rows = blocks.where(in_round).agg(F.sum("items")).first()[0]
        # teams x sections tasks at least, and as little sent as that allows
        teams = max(-(-sized["n"] // most), min(-(-sized["n"] // size), math.isqrt(tasks * sized["n"] // rows) + 1))
        sections = min(taken, max(-(-rows // most), -(-tasks // max(1, teams))))
        section = F.floor((F.col("block") - first) * sections / taken).cast("int")
        bounds = blocks.where(in_round).groupBy(section.alias("section")).agg(F.max("bound").alias("bound")).groupBy().agg(
            F.collect_list(F.struct("section", "bound")).alias("b")).scalar()
        if best is not None:
            last = best.groupBy(F.col("user").alias("id")).agg(F.when(F.count("*") >= n, F.min("score")).alias("last"))
            open_ = who.join(last, "id", "left")
        else:
            open_ = who.withColumn("last", F.lit(None).cast("double"))
        reach = F.filter("bounds", lambda b: F.col("last").isNull() | (F.col("norm") * b["bound"] * (1 + _SLACK) >= F.col("last")))
        asked = open_.withColumn("bounds", bounds).withColumn("section", F.explode(F.transform(reach, lambda b: b["section"]))).withColumn(
            "team", F.pmod(F.xxhash64("id"), F.lit(max(1, teams))).cast("int")).drop("bounds")
        asking, seen = Observation(), Observation()
        asked = asked.observe(asking, F.approx_count_distinct("id").alias("users"), F.count("*").alias("rows"))
        here = listed.where(in_round).withColumn("section", section).withColumn(
            "team", F.explode(F.sequence(F.lit(0), F.lit(max(1, teams) - 1))))
        found = asked.groupBy("team", "section").cogroup(here.groupBy("team", "section")).applyInArrow(_best_of(n), schema)
        found = found.observe(seen, F.sum("pairs").alias("pairs")).where(F.col("item").isNotNull()).drop("pairs")
        merged = found if best is None else best.select("user", "item", "score").unionByName(found)
        best = checkpointed(top_per_group(merged, ["user"], [F.desc("score"), F.col("item")], n), "best-items")
        got = seen.get["pairs"] or 0
        met = asking.get
        rounds.append({"blocks": taken, "users": met["users"], "pairs": got, "sent": met["rows"] + rows * max(1, teams)})
        if not got:
            break
        first = 2 * first + 1
    if best is None:
        best = who.select(F.col("id").alias("user")).where(F.lit(False)).join(
            listed.select(F.col("id").alias("item")), F.lit(False)).select("user", "item", F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    return TopItems(best.select(F.col("user").alias(user), F.col("item").alias(item), F.col("rank").cast("int").alias("rank"), "score"),
                    rounds)
