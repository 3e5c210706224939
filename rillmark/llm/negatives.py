"""Hard-negative mining (operator 12): Strassen products of integer tiles, merged heaps of positives and of score windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import stored
from rillmark.operators.scale import top_per_group

LEAF = 16  # a side of a product at which halving ends
TILE = (256, 1024)  # anchors and candidates of one product
BLOCK = (2048, 8192)  # anchors and candidates that one task holds
_NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices by seven half-sized products, odd sides padded with a row or column of zeros.

    Sums wrap around at 64 bits, so every entry that fits 64 bits is exact whatever the sums between were.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    i, j, l = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((m, n), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """The ``k`` best (score, id) of every slot: higher scores first, ties by smaller id. Heaps of parts merge by pushing."""

    def __init__(self, k: int):
        self.k = k
        self.slot = self.score = self.id = np.zeros(0, np.int64)

    def push(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        slot, score, ident = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, ~score, slot))  # ~score falls as the score rises and cannot overflow
        slot = slot[order]
        first = np.flatnonzero(np.diff(slot, prepend=slot[:1] - 1))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[order][keep], ident[order][keep]

    def push_tile(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """Offer the wanted entries of a tile (slots × ids); ids rise along a row."""
        open_ = np.where(wanted, scores, _NONE)
        if open_.shape[1] > self.k:
            worst = np.partition(open_, -self.k, axis=1)[:, -self.k]
            above = open_ > worst[:, None]
            tied = wanted & (open_ == worst[:, None])  # of equal scores only as many as there is room for, smallest ids first
            room = self.k - above.sum(1)
            wanted = wanted & (above | (tied & (np.cumsum(tied, axis=1) <= room[:, None])))
        row, col = np.nonzero(wanted)
        self.push(slots[row], scores[row, col], ids[col])


def _rows(vectors: DataFrame, key: str, column: str, label: str, scale: int) -> DataFrame:
    """(id, label as text, c): the rows that take part, one per id, components floored to integers of 1/scale."""
    v = F.col(column).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint"))
    own = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(key).cast("bigint").alias("id"), F.struct(F.col(label).cast("string").alias("label"), whole.alias("c")).alias("s"))
    return own.groupBy("id").agg(F.min("s").alias("s")).select("id", "s.label", "s.c")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; shorter rows are filled with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _tiles(anchors: pa.Table, others: pa.Table):
    """Products tile by tile: (rows of anchors, rows of others sorted by id, scores, same label, same id)."""
    others = others.sort_by("id")
    width = max(max((len(x) for x in t.column("c")), default=0) for t in (anchors, others))
    a, b = _matrix(anchors.column("c"), width), np.ascontiguousarray(_matrix(others.column("c"), width).T)
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width >= 2.0 ** 63:
        raise ValueError("inner products of these vectors leave 64 bits")
    labels = np.unique(np.concatenate([t.column("label").to_numpy() for t in (anchors, others)]), return_inverse=True)[1]
    la, lb = labels[:len(a)], labels[len(a):]
    ids, mine = others.column("id").to_numpy(), anchors.column("id").to_numpy()
    for i in range(0, len(a), TILE[0]):
        for j in range(0, len(ids), TILE[1]):
            p, q = np.arange(i, min(i + TILE[0], len(a))), np.arange(j, min(j + TILE[1], len(ids)))
            yield (p, ids[q], strassen(np.ascontiguousarray(a[p]), np.ascontiguousarray(b[:, q])),
                   la[p][:, None] == lb[q][None, :], mine[p][:, None] == ids[q][None, :])


def _positives(k: int):
    def run(anchors: pa.Table, others: pa.Table) -> pa.Table:
        heaps = Heaps(k)
        for p, ids, scores, same, self_ in _tiles(anchors, others):
            heaps.push_tile(p, scores, ids, same & ~self_)
        return pa.table({"anchor_id": anchors.column("id").take(pa.array(heaps.slot)), "positive_id": heaps.id,
                         "positive_score": heaps.score})

    return run


def _windows(k: int, low: int, high: int):
    def run(anchors: pa.Table, others: pa.Table) -> pa.Table:
        lists = anchors.column("positives").combine_chunks()
        first, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten()
        pid, ps = (flat.field(f).to_numpy() for f in ("positive_id", "positive_score"))
        heaps = Heaps(k)
        for p, ids, scores, same, _ in _tiles(anchors, others):
            for turn in range(int(np.diff(first).max(initial=0))):
                on = first[p] + turn < first[p + 1]
                slot = first[p[on]] + turn  # one heap per anchor and positive
                # low * ps <= 100 * s <= high * ps in whole numbers: -(-x // 100) is the ceiling
                least, most = -(-low * ps[slot] // 100), high * ps[slot] // 100
                s = scores[on]
                heaps.push_tile(slot, s, ids, ~same[on] & (s >= least[:, None]) & (s <= most[:, None]))
        anchor = np.repeat(anchors.column("id").to_numpy(), np.diff(first))
        return pa.table({"anchor_id": anchor[heaps.slot], "positive_id": pid[heaps.slot], "positive_score": ps[heaps.slot],
                         "negative_id": heaps.id, "negative_score": heaps.score})

    return run


def _blocked(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], run, schema: str) -> DataFrame:
    """Every block of anchors with every block of rows, one task each, by an equal key (anchor block, row block)."""
    def dealt(df, own, other, n_own, n_other):
        fresh = df.select([F.col(c).alias(c) for c in df.columns])  # both sides may come of one table
        return fresh.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    left = dealt(anchors, "p", "q", *blocks).groupBy("p", "q")
    right = dealt(rows, "q", "p", *reversed(blocks)).groupBy("p", "q")
    return left.cogroup(right).applyInArrow(run, schema)


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", column: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256) -> DataFrame:
    """Hard negatives: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on ``key``. A score is the inner product of vectors whose components x are floor(scale * x).
    An anchor's positives are its first ``positives`` other rows of the same label; for each of them come the first ``negatives``
    rows of another label with low % <= negative / positive score <= high %. Higher scores come first, ties by smaller id.

    Blocks of anchors meet blocks of rows (see BLOCK) by an equal key. A task multiplies tile by tile and keeps only heaps
    (k entries for an anchor, or for an anchor and positive); heaps of all blocks are merged by a window that keeps k rows
    per map task. Rows are read by two passes, since a window is known only when the positives are. A label that
    a third of all rows share changes nothing, since no row is dealt by its label.

    Rows with a null key, label or vector, or a null or non-finite component take no part; of rows that share a key the least
    (label as text, components) does. A shorter vector counts as filled up with zeros. An empty vector scores 0. Other columns
    are ignored. Products that might leave 64 bits are an error. Empty input, or no anchors, gives an empty table.
    """
    rows = stored(_rows(vectors, key, column, label, scale), "whole-vectors")
    chosen = rows.withColumnRenamed("id", key).where(anchors).withColumnRenamed(key, "id")
    blocks = tuple(max(1, -(-df.count() // size)) for df, size in zip((chosen, rows), BLOCK, strict=True))
    order = [F.desc("positive_score"), F.col("positive_id")]
    found = _blocked(chosen, rows, blocks, _positives(positives), "anchor_id bigint, positive_id bigint, positive_score bigint")
    found = stored(top_per_group(found, ["anchor_id"], order, positives, "turn"), "positives")
    lists = found.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # ``positives`` entries at most
    within = _blocked(chosen.join(lists, "id"), rows, blocks, _windows(negatives, low, high),
                      "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    ranked = top_per_group(within, ["anchor_id", "positive_id"], [F.desc("negative_score"), F.col("negative_id")], negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                         "negative_score")


MINE_SQL = """
WITH sound AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::VARCHAR AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT * FROM sound QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, c) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.c, b.c), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id))::INTEGER AS "rank"
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY "rank" <= 10"""
