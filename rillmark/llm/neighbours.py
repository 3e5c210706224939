"""Approximate nearest neighbours (operator 7): NN-descent builds a graph by Spark joins, queries walk it greedily."""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import mix, stored
from rillmark.operators.scale import top_per_group

BLOCK = 192  # nodes that are compared with each other at once while the graph is begun
_FLAT = pa.binary()


@dataclasses.dataclass(frozen=True)
class Index:
    """nodes (node, v, code): distinct vectors named by their smallest id; members (node, vec_id); lists (node, near, codes)."""

    nodes: DataFrame
    members: DataFrame
    lists: DataFrame


def _valid(vectors: DataFrame, key: str, column: str) -> DataFrame:
    v = F.col(column).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(key).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(key).cast("bigint").alias("vec_id"), v.alias("v"))


def _coded(nodes: DataFrame) -> DataFrame:
    """Add code: the vector's largest component (double), then the vector in parts of it (single precision).

    Each vector has its own scale, so a very long one takes nothing from the others, and no product leaves the range.
    """
    def code(batches):
        for batch in batches:
            x = []
            for v in batch.column("v"):
                v = np.asarray(v.values)
                top = np.abs(v).max()
                x.append(top.tobytes() + (v / top).astype(np.float32).tobytes())
            yield batch.append_column("code", pa.array(x, _FLAT))

    return nodes.mapInArrow(code, "node bigint, v array<double>, code binary")


def _matrix(codes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors in parts of their scales, and the scales."""
    raw = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(codes), -1)
    return np.ascontiguousarray(raw[:, 8:]).view(np.float32), np.ascontiguousarray(raw[:, :8]).view(np.float64).ravel()


def _products(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Inner products of all pairs of two sets of vectors, each as (parts, scales)."""
    return (a[0] @ b[0].T) * np.outer(a[1], b[1])


def _best(ids: np.ndarray, sims: np.ndarray, most: int):
    """Row and column of the ``most`` largest entries of each row, leaving out -inf."""
    most = min(most, sims.shape[1])
    cols = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    rows = np.repeat(np.arange(len(sims)), most)
    cols = cols.ravel()
    ok = np.isfinite(sims[rows, cols])
    return rows[ok], cols[ok]


def _first_lists(nodes: DataFrame, k: int, count: int, rounds: int, seed: int) -> DataFrame:
    """Neighbours (node, other, sim) within blocks of nodes on one side of random planes; the first round's blocks are drawn by hash.

    A block that equal signs would make too large is split by a hash, so no block grows with the data.
    """
    bits = max(0, int(np.ceil(np.log2(max(1, count) / BLOCK))))
    drawn = np.uint64(max(1, -(-count // BLOCK)))
    compact = nodes.select("node", "code")

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            (x, _), ids = _matrix(batch.column("code")), batch.column("node").to_numpy()
            for r in range(rounds):
                rng = np.random.default_rng((seed, r))
                if r and bits:
                    sign = (x @ rng.standard_normal((x.shape[1], bits)).astype(np.float32)) > 0
                    cell = sign @ (1 << np.arange(bits))
                else:
                    cell = mix(ids.astype(np.int64).view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * (seed + r + 1) & (1 << 64) - 1)) % drawn
                yield pa.record_batch({"round": pa.array(np.full(len(ids), r, np.int32)), "cell": pa.array(cell.astype(np.int64)),
                                       "node": batch.column("node"), "code": batch.column("code")})

    placed = compact.mapInArrow(place, "round int, cell bigint, node bigint, code binary")
    sizes = placed.groupBy("round", "cell").agg(F.count("*").alias("c"))
    part = F.pmod(F.xxhash64("node", "round"), F.ceil(F.col("c") / BLOCK))

    def compare(block: pa.Table) -> pa.Table:
        ids = block.column("node").to_numpy()
        x, scale = _matrix(block.column("code").combine_chunks())
        out = []
        for at in range(0, len(ids), 4 * BLOCK):
            sims = _products((x[at:at + 4 * BLOCK], scale[at:at + 4 * BLOCK]), (x, scale))
            sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -np.inf
            rows, cols = _best(ids, sims, k)
            out.append((ids[rows + at], ids[cols], sims[rows, cols]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["node", "other", "sim"])

    return placed.join(sizes, ["round", "cell"]).withColumn("part", part).groupBy("round", "cell", "part").applyInArrow(
        compare, "node bigint, other bigint, sim double")


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The k nearest others of each node; ``fresh`` stays true only for those that no earlier round has compared."""
    once = lists.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    return top_per_group(once, ["node"], [F.desc("sim"), F.col("other")], k, "place")


def _both_ways(lists: DataFrame, most: int, turn: int) -> DataFrame:
    """Lists with up to ``most`` of the nodes that name a node, drawn by hash, added to its own."""
    back = lists.select(F.col("other").alias("node"), F.col("node").alias("other"), "fresh")
    back = top_per_group(back, ["node"], [F.desc("fresh"), F.xxhash64("node", "other", F.lit(turn)), F.col("other")], most, "place")
    return lists.select("node", "other", "fresh").unionByName(back.drop("place")).groupBy("node", "other").agg(
        F.max("fresh").alias("fresh"))


def _descend(lists: DataFrame, nodes: DataFrame, k: int, back: int, emitted: int, turn: int, blocks: int) -> DataFrame:
    """One round: neighbours of a node are compared with each other, and each is offered the nearest it did not know."""
    edges = _both_ways(lists, back, turn)
    worst = lists.groupBy("node").agg(F.when(F.count("*") >= k, F.min("sim")).alias("worst"))
    known = nodes.select(F.col("node").alias("other"), "code").join(worst.withColumnRenamed("node", "other"), "other", "left")
    rows = edges.join(known, "other").withColumn("block", F.pmod(F.xxhash64("node"), F.lit(blocks)))

    def compare(block: pa.Table) -> pa.Table:
        order = np.argsort(block.column("node").to_numpy(), kind="stable")
        node, other = block.column("node").to_numpy()[order], block.column("other").to_numpy()[order]
        x, scale = (c[order] for c in _matrix(block.column("code").combine_chunks()))
        fresh = block.column("fresh").to_numpy()[order].astype(bool)
        worst = block.column("worst").to_pandas().fillna(-np.inf).to_numpy(np.float64)[order]
        cuts = np.flatnonzero(np.diff(node)) + 1
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for a, b in zip([0, *cuts], [*cuts, len(node)], strict=True):
            if b - a < 2 or not fresh[a:b].any():
                continue
            sims = _products((x[a:b], scale[a:b]), (x[a:b], scale[a:b]))
            sims[~(fresh[a:b, None] | fresh[None, a:b]) | (sims <= worst[a:b, None])] = -np.inf
            np.fill_diagonal(sims, -np.inf)
            r, c = _best(other[a:b], sims, emitted)
            out.append((other[a + r], other[a + c], sims[r, c]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["node", "other", "sim"])

    offers = rows.groupBy("block").applyInArrow(compare, "node bigint, other bigint, sim double")
    seen = lists.select("node", "other", "sim").withColumn("fresh", F.lit(False))
    return _merged(offers.withColumn("fresh", F.lit(True)).unionByName(seen), k)


def build(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 16, back: int = 14, rounds: int = 30,
          begin: int = 5, emitted: int = 3, seed: int = 7) -> Index:
    """Index of all vectors by inner product: a graph with ``k`` neighbours each, made by NN-descent.

    Equal vectors are one node, so a very common vector fills no list with its copies. The lists begin with neighbours from
    random blocks; each round joins every list (with at most ``back`` of the nodes that name it) to the
    vectors and compares the neighbours of each node, where one of the two is new. It ends when under one list entry in
    a hundred is new (after ``rounds`` at the latest, which a graph of any size stays well below). Work goes by blocks of nodes; a list is bounded by k + back, so no task holds a hub's followers.

    Vectors that are null, zero, or hold null or non-finite components are left out, as are those of another length than the
    commonest (of equally common lengths the smaller), which have no inner product with the others; queries alike.
    """
    own = _valid(vectors, key, column)
    size = own.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    own = own.where(F.size("v") == (size.d if size else 0))  # vectors of another length cannot be compared
    ids = stored(own.select("vec_id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v"), "vectors")
    nodes = ids.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"))
    members = stored(ids.select("vec_id", "h1", "h2").join(nodes, ["h1", "h2"]).select("node", "vec_id"), "members")
    rows = ids.join(nodes.select("h1", "h2", F.col("node").alias("vec_id")), ["h1", "h2", "vec_id"]).select(
        F.col("vec_id").alias("node"), "v").dropDuplicates(["node"])
    nodes = stored(_coded(rows), "nodes")
    count = nodes.count()
    lists = _first_lists(nodes, k, count, begin, seed).withColumn("fresh", F.lit(True))
    lists = stored(_merged(lists, k), "lists")
    for turn in range(rounds):
        lists = stored(_descend(lists, nodes, k, back, emitted, turn, max(1, count // 256)), "lists")
        if lists.where("fresh").count() * 100 < k * count:
            break
    edges = _both_ways(lists, back, rounds).select("node", "other").join(
        nodes.select(F.col("node").alias("other"), "code"), "other")
    near = edges.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("other", "code"))).alias("near"))
    return Index(nodes, members, stored(near, "graph"))


def _widened(pool: DataFrame, index: Index, wide: int, step: int) -> DataFrame:
    """Neighbours of the ``step`` nearest nodes not yet expanded of each query, as (query, node, sim) rows."""
    todo = top_per_group(pool.where("NOT done"), ["query"], [F.desc("sim"), F.col("node")], step, "turn")
    worst = pool.groupBy("query").agg(F.when(F.count("*") >= wide, F.min("sim")).alias("worst"))
    met = todo.select("query", "q", "node").join(index.lists, "node").join(worst, "query")

    def score(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q, scale = _matrix(batch.column("q"))
            near = batch.column("near")
            flat, ends = near.values, near.offsets.to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            flat = flat.slice(ends[0], ends[-1] - ends[0])
            x, own = _matrix(flat.field("code"))
            sims = np.einsum("ij,ij->i", x, q[row]) * (own * scale[row])
            worst = batch.column("worst").to_pandas().fillna(-np.inf).to_numpy(np.float64)
            ok = sims >= worst[row]
            yield pa.record_batch({"query": batch.column("query").take(pa.array(row[ok])), "q": batch.column("q").take(pa.array(row[ok])),
                                   "node": flat.field("other").filter(pa.array(ok)), "sim": pa.array(sims[ok])})

    found = met.mapInArrow(score, "query bigint, q binary, node bigint, sim double").withColumn("done", F.lit(False))
    opened = todo.select("query", "node").withColumn("_open", F.lit(True))
    old = pool.join(opened, ["query", "node"], "left").withColumn("done", F.col("done") | F.coalesce("_open", F.lit(False)))
    once = old.drop("_open").unionByName(found).groupBy("query", "node").agg(
        F.any_value("q").alias("q"), F.max("sim").alias("sim"), F.max("done").alias("done"))
    return top_per_group(once, ["query"], [F.desc("sim"), F.col("node")], wide, "turn").drop("turn")


def search(index: Index, queries: DataFrame, key: str = "vec_id", column: str = "embedding", k: int = 20, wide: int = 256,
           step: int = 64, entries: int = 32) -> DataFrame:
    """The ``k`` nearest found of each query by inner product: (query_id, rank, vec_id, score), nearest first, ties to the
    smaller vec_id; a query's own id is no candidate.

    A query starts at its own node, if it is one, and at ``entries`` nodes drawn by hash, so small tables are searched
    whole. Each hop expands its ``step`` nearest nodes not yet expanded among the ``wide`` nearest met, by a join of
    (query, node) with the neighbour lists, until all of those are expanded. The nearest 3k nodes are scored again in
    double precision on the original vectors and stand for all their equal vectors.
    """
    own = _valid(queries, key, column).groupBy("vec_id").agg(F.min("v").alias("v")).withColumnRenamed("vec_id", "node")
    shape = index.nodes.select(F.size("v").alias("d")).first()
    own = stored(_coded(own.where(F.size("v") == (shape.d if shape else -1))).select(
        F.col("node").alias("query"), "v", F.col("code").alias("q")), "queries")
    doors = index.nodes.orderBy(F.xxhash64("node"), "node").limit(entries).select("node", "code").toArrow()
    ids, codes = doors.column("node").to_pylist(), _matrix(doors.column("code").combine_chunks()) if len(doors) else None

    def enter(batches):
        for batch in batches:
            if not batch.num_rows or codes is None:
                continue
            n = batch.num_rows
            sims = _products(_matrix(batch.column("q")), codes)
            row = np.repeat(np.arange(n), len(ids))
            yield pa.record_batch({"query": batch.column("query").take(pa.array(row)), "q": batch.column("q").take(pa.array(row)),
                                   "node": pa.array(ids * n, pa.int64()), "sim": pa.array(sims.ravel())})

    first = own.select("query", "q").mapInArrow(enter, "query bigint, q binary, node bigint, sim double")
    home = own.join(index.members.withColumnRenamed("vec_id", "query"), "query").select(
        "query", "q", "node", F.lit(float("inf")).alias("sim"))  # its own node comes first
    pool = first.unionByName(home).groupBy("query", "node").agg(F.any_value("q").alias("q"), F.max("sim").alias("sim"))
    pool = stored(pool.withColumn("done", F.lit(False)), "pool")
    while pool.where("NOT done").limit(1).count():
        pool = stored(_widened(pool, index, wide, step), "pool")
    close = top_per_group(pool, ["query"], [F.desc("sim"), F.col("node")], 3 * k, "turn").select("query", "node")
    rated = close.join(index.nodes.select("node", "v"), "node").join(own.select("query", F.col("v").alias("w")), "query")

    def rate(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                v, w = (batch.column(c).flatten().to_numpy().reshape(n, -1) for c in ("v", "w"))
                yield pa.record_batch({"query": batch.column("query"), "node": batch.column("node"), "score": pa.array((v * w).sum(1))})

    rated = rated.mapInArrow(rate, "query bigint, node bigint, score double")
    copies = top_per_group(index.members, ["node"], [F.col("vec_id")], k + 1, "copy")
    full = rated.join(copies, "node").where(F.col("vec_id") != F.col("query"))
    ranked = top_per_group(full, ["query"], [F.desc("score"), F.col("vec_id")], k, "rank")
    return ranked.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
