"""Gradient-boosted trees after LightGBM: binned features, Newton gains and leaf values, growth by the best leaf.

Rows are binned once and stored in chunks. Columns that go together (those of a user, those of an item) take few distinct tuples
in a chunk; they are stored as one code for each row and a table of tuples, and a histogram sums gradients by code first. What comes to
the driver is a histogram for each open leaf, whatever the number of rows. Several models (the folds of a cross-validation and the
one on all rows) grow in the same passes.
"""

from __future__ import annotations

import dataclasses
import functools
import heapq
import json
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.session import checkpointed

# Defaults of the library whose method this is.
BINS, LEAVES, MIN_ROWS, MIN_HESSIAN = 255, 31, 20, 1e-3
CHUNK = 1 << 18  # rows of a chunk
POINTS = 1 << 14  # values of a column that a task tells apart when bins are sought
SHARED = 8  # rows that a tuple of a chunk's table stands for, at least
CUT_EVERY = 50  # trees after which the lineage of the scores is cut
_ROUNDING = 1e-9  # a gain below this share of the leaf's own is rounding
_LARGEST = 1e300
_BALANCE = 1e-15  # share of a label at least, for the first score


@dataclasses.dataclass
class Tree:
    """Nodes by number, 0 being the root: a row goes to ``left`` if its bin of ``feature`` is not above ``cut``. Leaves have feature -1."""

    feature: list[int]
    cut: list[int]
    left: list[int]
    right: list[int]
    value: list[float]

    @classmethod
    def leaf(cls) -> Tree:
        return cls([-1], [0], [-1], [-1], [0.0])

    def split(self, node: int, feature: int, cut: int) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, left, left + 1
        for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            column.extend([empty, empty])
        return left, left + 1


@dataclasses.dataclass
class Ranker:
    """A fitted model: ``edges`` holds each feature's upper bounds of bins, ``start`` the score before the first tree.

    ``aucs`` are those of the folds and ``auc`` that of all out-of-fold scores, where folds were asked for.
    """

    features: list[str]
    edges: list[list[float]]
    start: float
    trees: list[Tree]
    aucs: list[float] = dataclasses.field(default_factory=list)
    auc: float | None = None

    @functools.cached_property
    def _tables(self) -> tuple[np.ndarray, list[tuple]]:
        """Trees that ask one feature, added up by (feature, bin), and the others: (depth, feature, cut, children, value) by node."""
        alike, others = np.zeros((len(self.features), BINS + 1)), []
        for tree in self.trees:
            feature, cut = np.asarray(tree.feature), np.asarray(tree.cut)
            nodes = np.arange(len(feature))
            children = np.stack([np.where(feature < 0, nodes, tree.left), np.where(feature < 0, nodes, tree.right)], 1).ravel()
            depth, level = 0, [0]
            while level := [c for x in level if feature[x] >= 0 for c in (tree.left[x], tree.right[x])]:
                depth += 1
            parts = depth, np.maximum(feature, 0), cut, children, np.asarray(tree.value)
            used = np.unique(feature[feature >= 0])
            if len(used) == 1:
                alike[used[0]] += _walked(np.broadcast_to(np.arange(BINS + 1), (len(self.features), BINS + 1)), parts)
            elif len(used):
                others.append(parts)
        return alike, others

    def margins(self, values: list[np.ndarray]) -> np.ndarray:
        """Log-odds of rows given as one array for each feature."""
        bins = np.stack([_bins(v, np.asarray(e)) for v, e in zip(values, self.edges, strict=True)])
        alike, others = self._tables
        out = np.full(bins.shape[1], self.start)
        for f in np.flatnonzero(alike.any(1)):
            out += alike[f][bins[f]]
        for parts in others:
            out += _walked(bins, parts)
        return out

    def importances(self) -> list[float]:
        """How many splits use each feature."""
        used = [f for t in self.trees for f in t.feature if f >= 0]
        return np.bincount(np.asarray(used, np.int64), minlength=len(self.features)).astype("float64").tolist()

    def write(self) -> _Writer:
        return _Writer(self)

    @staticmethod
    def load(path: str) -> Ranker:
        kept = json.loads(SparkSession.active().read.parquet(path).first()["model"])
        return Ranker(**kept | {"trees": [Tree(**t) for t in kept["trees"]]})


class _Writer:
    """Storage with the calls of the library's own models."""

    def __init__(self, model: Ranker, mode: str = "error"):
        self.model, self.mode = model, mode

    def overwrite(self) -> _Writer:
        return _Writer(self.model, "overwrite")

    def save(self, path: str) -> None:
        text = json.dumps(dataclasses.asdict(self.model))
        SparkSession.active().createDataFrame([(text,)], "model string").write.mode(self.mode).parquet(path)


def _walked(bins: np.ndarray, parts: tuple) -> np.ndarray:
    """What a tree adds to the score of every column of ``bins`` (feature, row)."""
    depth, feature, cut, children, value = parts
    rows = np.arange(bins.shape[1])
    node = np.zeros(bins.shape[1], np.int64)
    for _ in range(depth):
        node = children[2 * node + (bins[feature[node], rows] > cut[node])]
    return value[node]


def probability(models: dict[int, Ranker], features: list[str], which: Column) -> Column:
    """Probability of label 1 by the model that ``which`` names; null where there is none of that name."""
    @F.pandas_udf("double")
    def of(name: pd.Series, *columns: pd.Series) -> pd.Series:
        names, out = name.to_numpy(), np.full(len(name), np.nan)
        values = [c.to_numpy(dtype="float64") for c in columns]
        for n, model in models.items():
            if len(at := np.flatnonzero(names == n)):
                with np.errstate(over="ignore"):
                    out[at] = 1.0 / (1.0 + np.exp(-model.margins([v[at] for v in values])))
        return pd.Series(out).where(~np.isnan(out), None)

    return of(which, *[F.col(f).cast("double") for f in features])


def _bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="left").astype(np.uint8)


def _counted(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and the rows of each; beyond POINTS values, as many points of about equal numbers of rows."""
    if counts is None:
        values, counts = np.unique(values, return_counts=True)
    else:
        values, at = np.unique(values, return_inverse=True)
        counts = np.bincount(at, counts).astype(np.int64)
    if len(values) <= POINTS:
        return values, counts
    upto = np.cumsum(counts)
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, POINTS + 1) / POINTS))
    return values[at], np.diff(upto[at], prepend=0)


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return held[0] if len(held) == 1 else _counted(*(np.concatenate(x) for x in zip(*held, strict=True)))


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counted values of every column over a task's rows."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    waiting: list[pa.RecordBatch] = []

    def count() -> None:
        table = pa.Table.from_batches(waiting)
        for i in range(table.num_columns):
            values = table.column(i).to_numpy()
            held[i] = [_merged([*held.get(i, []), _counted(np.clip(values[~np.isnan(values)], -_LARGEST, _LARGEST))])]
        waiting.clear()

    for batch in batches:
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= 4 * CHUNK:
            count()
    if waiting:
        count()
    for i, [(values, counts)] in held.items():
        yield pa.record_batch({"feature": pa.array([i], pa.int32()), "value": pa.array([values], pa.list_(pa.float64())),
                               "n": pa.array([counts], pa.list_(pa.int64()))})


def _edges(key: tuple, parts: pa.Table) -> pa.Table:
    """A feature's edges from the counted values of all tasks."""
    values, counts = (parts.column(c).combine_chunks().flatten().to_numpy() for c in ("value", "n"))
    values, at = np.unique(values, return_inverse=True)
    upto = np.cumsum(np.bincount(at, counts))
    if len(values) <= BINS:
        edges = values[:-1] / 2 + values[1:] / 2
    else:
        edges = np.unique(values[np.searchsorted(upto, upto[-1] * np.arange(1, BINS) / BINS)])
    return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "edges": pa.array([edges], pa.list_(pa.float64()))})


def bin_edges(df: DataFrame, features: list[str]) -> list[list[float]]:
    """Upper bounds of each feature's bins, from all rows: a bin for each value of a column with at most BINS values, else bins of
    about equal numbers of rows."""
    points = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]).mapInArrow(
        _points, "feature int, value array<double>, n array<bigint>")
    found = points.groupBy("feature").applyInArrow(_edges, "feature int, edges array<double>").collect()  # one row per feature
    edges = {r["feature"]: r["edges"] for r in found}
    return [list(edges.get(i, [])) for i in range(len(features))]


@dataclasses.dataclass
class _Chunk:
    """Rows of one fold. ``groups`` holds for columns that go together each row's code and the table of bins by (column, code);
    ``place`` a column's group and its place there."""

    fold: int
    label: np.ndarray
    groups: list[tuple[list[int], np.ndarray, np.ndarray]]
    place: dict[int, tuple[int, int]]

    @classmethod
    def of(cls, bins: np.ndarray, label: np.ndarray, fold: int) -> _Chunk:
        most, groups, members, code = max(BINS + 1, bins.shape[1] // SHARED), [], [], None

        def close() -> None:
            first = np.empty(code.max() + 1, np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            groups.append((members, code.astype(np.uint16 if len(first) <= 1 << 16 else np.uint32), bins[members][:, first]))

        for f in range(len(bins)):
            if code is not None:
                joint, tuples = pd.factorize(code * np.int64(BINS + 1) + bins[f])
                if len(tuples) <= most:
                    members, code = [*members, f], joint
                    continue
                close()
            members, code = [f], pd.factorize(bins[f].astype(np.int64))[0]
        close()
        return cls(fold, label, groups, {f: (g, j) for g, (columns, _, _) in enumerate(groups) for j, f in enumerate(columns)})

    def leaves(self, tree: Tree) -> Iterator[tuple[int, np.ndarray | slice]]:
        """The leaves of a tree and the rows of each."""
        todo: list[tuple[int, np.ndarray | slice]] = [(0, slice(None))]
        while todo:
            node, rows = todo.pop()
            if tree.feature[node] < 0:
                yield node, rows
                continue
            g, j = self.place[tree.feature[node]]
            _, codes, table = self.groups[g]
            above = (table[j] > tree.cut[node])[codes[rows]]
            for child, hit in ((tree.left[node], ~above), (tree.right[node], above)):
                at = np.flatnonzero(hit)
                todo.append((child, at if isinstance(rows, slice) else rows[at]))

    def histogram(self, scores: np.ndarray, rows: np.ndarray | slice, into: np.ndarray) -> int:
        """Add the gradients and hessians of the rows to ``into`` (2, column, bin); the number of rows."""
        s, y = scores[rows], self.label[rows]
        e = np.exp(-np.abs(s))
        likely = 1 / (1 + e)
        unlikely = e * likely
        error = np.where((s > 0) == y, unlikely, likely)
        weights = np.where(y, -error, error).astype("float64"), (likely * unlikely).astype("float64")
        for columns, codes, table in self.groups:
            code = codes[rows]
            for kind, weight in enumerate(weights):
                if len(code) < table.shape[1]:
                    for j, f in enumerate(columns):
                        into[kind, f] += np.bincount(table[j][code], weight, into.shape[2])
                    continue
                sums = np.bincount(code, weight, table.shape[1])
                for j, f in enumerate(columns):
                    into[kind, f] += np.bincount(table[j], sums, into.shape[2])
        return len(s)


def _chunks(edges: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Binned rows, packed by fold. Columns: the features, label, fold."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def pack(fold: int) -> pa.RecordBatch:
        bins, labels = zip(*held.pop(fold), strict=True)
        chunk = _Chunk.of(np.concatenate(bins, 1), np.concatenate(labels), fold)
        return pa.record_batch({"chunk": pa.array([pickle.dumps(chunk, 5)], pa.binary())})

    for batch in batches:
        bins = np.stack([_bins(batch.column(i).to_numpy(zero_copy_only=False), e) for i, e in enumerate(edges)])
        label, folds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (len(edges), len(edges) + 1))
        for fold in np.unique(folds).tolist():
            at = folds == fold
            held.setdefault(fold, []).append((bins[:, at], label[at] > 0))
            if sum(len(y) for _, y in held[fold]) >= CHUNK:
                yield pack(fold)
    for fold in list(held):
        yield pack(fold)


def _start(held: list[int | None], first: list[float], row) -> tuple[_Chunk, dict[int, np.ndarray]]:
    """A chunk and the scores of its rows in every model that it trains."""
    chunk = pickle.loads(bytes(row["chunk"]))
    return chunk, {m: np.full(len(chunk.label), first[m], "float32") for m, fold in enumerate(held) if fold != chunk.fold}


def _grown(trees: dict[int, Tree], part: tuple[_Chunk, dict[int, np.ndarray]]) -> tuple[_Chunk, dict[int, np.ndarray]]:
    """The scores with one more tree of every model."""
    chunk, scores = part
    for m, tree in trees.items():
        if m in scores:
            for node, rows in chunk.leaves(tree):
                scores[m][rows] += np.float32(tree.value[node])
    return chunk, scores


def _histograms(trees: dict[int, Tree], wanted: set[tuple[int, int]], shape: tuple[int, int, int], parts: Iterator) -> Iterator:
    """The histograms of the wanted (model, leaf) over the chunks of a task."""
    sums: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
    for chunk, scores in parts:
        for m in {m for m, _ in wanted} & scores.keys():
            for node, rows in chunk.leaves(trees[m]):
                if (m, node) in wanted:
                    into, n = sums.get((m, node)) or (np.zeros(shape), 0)
                    sums[m, node] = into, n + chunk.histogram(scores[m], rows, into)
    yield from sums.items()


def _added(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> tuple[np.ndarray, int]:
    return a[0] + b[0], a[1] + b[1]


@dataclasses.dataclass
class _Split:
    gain: float
    feature: int
    cut: int
    few_left: bool  # whether the left side seems to hold fewer rows
    values: tuple[float, float]


def _best_split(sums: np.ndarray, rows: int) -> _Split | None:
    """The split of a leaf with the largest gain, ties by the first feature and bin; None if there is none. The rows of a side
    are estimated by its share of the hessian."""
    g, h = sums[:, 0].sum(1)
    if h <= 0:
        return None
    left = np.cumsum(sums, 2)[:, :, :-1]
    (gl, hl), (gr, hr) = left, (g - left[0], h - left[1])
    count = np.rint(hl * (rows / h))
    able = (count >= MIN_ROWS) & (rows - count >= MIN_ROWS) & (hl >= MIN_HESSIAN) & (hr >= MIN_HESSIAN)
    if not able.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(able, gl * gl / hl + gr * gr / hr, -np.inf)
    own = g * g / h
    best = gain.max()
    if best <= own * (1 + _ROUNDING):
        return None
    feature, cut = np.unravel_index(np.flatnonzero(gain.ravel() >= best * (1 - _ROUNDING))[0], gain.shape)
    at = feature, cut
    return _Split(float(best - own), int(feature), int(cut), bool(2 * count[at] <= rows), (float(-gl[at] / hl[at]), float(-gr[at] / hr[at])))


def _pruned(tree: Tree, splits: dict[int, _Split], rate: float) -> Tree:
    """The tree that growth by the largest gain reaches with LEAVES leaves, with its leaf values."""
    out, open_ = Tree.leaf(), [(-splits[0].gain, 0, 0)]  # gain, node of the full tree, node here
    for _ in range(LEAVES - 1):
        if not open_:
            break
        _, node, here = heapq.heappop(open_)
        split = splits[node]
        sides = out.split(here, split.feature, split.cut)
        for child, new, value in zip((tree.left[node], tree.right[node]), sides, split.values, strict=True):
            out.value[new] = rate * value
            if child in splits:
                heapq.heappush(open_, (-splits[child].gain, child, new))
    return out


def _one_tree(scored: RDD, models: list[int], shape: tuple[int, int, int], depth: int, rate: float) -> dict[int, Tree]:
    """The next tree of every model, level by level; models without a split are left out. Of two sisters the one with fewer rows is
    summed, the other is the difference to their parent."""
    trees, splits = {m: Tree.leaf() for m in models}, {m: {} for m in models}
    wanted, parents = {(m, 0) for m in models}, {}
    tasks = scored.ctx.defaultParallelism
    for level in range(depth):
        found = scored.mapPartitions(functools.partial(_histograms, trees, wanted, shape)).reduceByKey(
            _added, min(len(wanted), tasks)).collectAsMap()
        for key, (sister, whole) in parents.items():
            sums, rows = found.get(key) or (np.zeros(shape), 0)
            found[key[0], sister] = whole[0] - sums, whole[1] - rows
        wanted, parents = set(), {}
        for (m, node), whole in sorted(found.items(), key=lambda x: x[0]):
            split = _best_split(*whole)
            if split is None:
                continue
            splits[m][node] = split
            sides = trees[m].split(node, split.feature, split.cut)
            if level + 1 < depth:
                few, many = sides if split.few_left else sides[::-1]
                wanted.add((m, few))
                parents[m, few] = many, whole
        if not wanted:
            break
    return {m: _pruned(trees[m], splits[m], rate) for m in models if splits[m]}


def fit(df: DataFrame, features: list[str], held: list[int | None], trees: int, depth: int, rate: float, key: str = "user_id") -> list[Ranker]:
    """One model for each entry of ``held``, trained on all rows but those of that ``fold`` (None: on all rows), in common passes.

    ``df``: the features without nulls, ``label`` and, unless ``held`` is [None], ``fold``. Rows that share ``key`` are brought together,
    if there is such a column, since they have columns in common.
    """
    fold = F.col("fold") if any(f is not None for f in held) else F.lit(-1)
    rows = df.withColumn("fold", fold.cast("int"))
    counts = {r["fold"]: r for r in rows.groupBy("fold").agg(
        F.count("*").alias("n"), F.count_if(F.col("label") > 0).alias("ones"),
        F.count_if(F.col("label").isNull() | F.isnan(F.col("label").cast("double"))).alias("bad")).collect()}  # one row per fold
    if any(r["bad"] for r in counts.values()):
        raise ValueError("rows without a label cannot train a ranker")
    if not counts:
        raise ValueError("there are no rows to train a ranker on")
    totals = [(sum(r["n"] for f, r in counts.items() if f != h), sum(r["ones"] for f, r in counts.items() if f != h)) for h in held]
    shares = [min(max(ones / n if n else 0.5, _BALANCE), 1 - _BALANCE) for n, ones in totals]  # all rows may be in one fold
    first = [float(np.log(p / (1 - p))) for p in shares]
    edges = bin_edges(df, features)
    shape = 2, len(features), 1 + max(map(len, edges))

    packed = rows.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
                         F.col("label").cast("double").alias("label"), F.coalesce("fold", F.lit(-1)).alias("fold"),
                         *[F.col(c).alias("_key") for c in [key] if c in df.columns])
    dealt = packed.hint("rebalance", "_key").drop("_key") if key in df.columns else packed.hint("rebalance")
    bounds = [np.asarray(e, "float64") for e in edges]
    chunks = checkpointed(dealt.mapInArrow(functools.partial(_chunks, bounds), "chunk binary"), "binned-rows")
    scored = chunks.rdd.map(functools.partial(_start, held, first)).persist(StorageLevel.MEMORY_AND_DISK)
    out = [Ranker(features, edges, s, []) for s in first]
    open_, before = [m for m, (n, ones) in enumerate(totals) if 0 < ones < n], None
    for t in range(trees):
        grown = _one_tree(scored, open_, shape, depth, rate) if open_ else {}
        if before is not None:
            before.unpersist()
        for m, tree in grown.items():
            out[m].trees.append(tree)
        open_ = list(grown)
        if not open_ or t + 1 == trees:
            break
        before, scored = scored, scored.map(functools.partial(_grown, grown)).persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % CUT_EVERY == 0:
            scored.checkpoint()
    scored.unpersist()
    return out
