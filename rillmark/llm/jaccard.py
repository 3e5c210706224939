"""N-gram Jaccard join (operator 5): rare-first prefixes with length, positional and suffix filters, verified once per pair."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import shingle_hashes, stored, text_slices, word_hashes
from rillmark.llm.components import components

CELLS = 1024  # cells of the suffix filter


def _sets(batch: pa.RecordBatch, n: int, distinct: bool = True):
    """(row, hashes of its shingles) for every text of a batch."""
    for first, data, offsets in text_slices(batch.column("text")):
        hashes, bounds = word_hashes(data, offsets)
        for k, runs in enumerate(shingle_hashes(hashes, bounds, n)):
            yield first + k, np.unique(runs) if distinct else runs


def _frequencies(docs: DataFrame, n: int, bits: int) -> np.ndarray:
    """How often shingles occur in all documents, by the top ``bits`` of their hash: at most 2^bits numbers."""
    shift = np.uint64(64 - bits)

    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for first, data, offsets in text_slices(batch.column("text")):
                runs = shingle_hashes(*word_hashes(data, offsets), n)
                total += np.bincount((np.concatenate(runs) >> shift).astype(np.int64), minlength=1 << bits)
        for at in range(0, 1 << bits, 1 << 16):
            part = total[at:at + (1 << 16)]
            full = np.flatnonzero(part)
            yield pa.record_batch({"cell": pa.array(full + at, pa.int32()), "n": pa.array(part[full], pa.int64())})

    counted = docs.select("text").mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    out = np.zeros(1 << bits, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def _described(docs: DataFrame, n: int, percent: int, seen, bits: int) -> DataFrame:
    """One row per document: size and fingerprint of its set, its rare-first prefix, and the cells of the suffix filter."""
    schema = "doc_id bigint, n int, f1 bigint, f2 bigint, prefix array<bigint>, cells array<bigint>"
    shift = np.uint64(64 - bits)

    def describe(batches):
        df = seen.value
        for batch in batches:
            ids, size, marks, prefixes, cells = [], [], [], [], []
            names = batch.column("doc_id").to_pylist()
            for row, u in _sets(batch, n):
                order = np.lexsort((u, df[(u >> shift).astype(np.int64)]))
                keep = len(u) - -(-percent * len(u) // 100) + 1 if len(u) else 0
                ids.append(names[row])
                size.append(len(u))
                marks.append(np.frombuffer(hashlib.blake2b(u.tobytes(), digest_size=16).digest(), np.int64))
                prefixes.append(u[order[:keep]].view(np.int64))
                # parity of the number of shingles in each cell
                odd = np.bincount((u >> np.uint64(20)).astype(np.int64) & (CELLS - 1), minlength=CELLS) & 1
                cells.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            f = np.stack(marks) if marks else np.zeros((0, 2), np.int64)
            yield pa.record_batch({
                "doc_id": pa.array(ids, pa.int64()), "n": pa.array(size, pa.int32()), "f1": pa.array(f[:, 0]),
                "f2": pa.array(f[:, 1]), "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                "cells": pa.array(cells, pa.list_(pa.int64()))})

    return docs.mapInArrow(describe, schema)


def _full_sets(docs: DataFrame, n: int) -> DataFrame:
    def whole(batches):
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            got = [(names[row], u.view(np.int64)) for row, u in _sets(batch, n)]
            yield pa.record_batch({"doc_id": pa.array([g[0] for g in got], pa.int64()),
                                   "grams": pa.array([g[1] for g in got], pa.list_(pa.int64()))})

    return docs.mapInArrow(whole, "doc_id bigint, grams array<bigint>")


def _long_enough(x: str, y: str, percent: int) -> Column:
    """Length and positional filter of a pair that shares a prefix shingle."""
    n, m, i, j = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.at"), F.col(f"{y}.at")
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & (1 + F.least(n - i - 1, m - j - 1) >= _least_overlap(n, m, percent)))


def _least_overlap(n: Column, m: Column, percent: int) -> Column:
    return F.floor((percent * (n + m) + (100 + percent - 1)) / F.lit(100 + percent))


def _may_link(x: str, y: str, percent: int) -> Column:
    """All filters. The suffix filter bounds the symmetric difference from below: the order of shingles is split at fixed pivots into
    cells, and a cell whose two counts differ in parity holds at least one shingle of one side only.
    """
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = sum((F.bit_count(F.get(f"{x}.cells", F.lit(k)).bitwiseXOR(F.get(f"{y}.cells", F.lit(k))))
                  for k in range(CELLS // 64)), F.lit(0))
    return _long_enough(x, y, percent) & (differ <= n + m - 2 * _least_overlap(n, m, percent))


def _with_partner(rows: DataFrame, filters, percent: int) -> DataFrame:
    """Rows for which another document's row with the same shingle passes the filters; each at most once."""
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.doc_id") != F.col("y.doc_id"))
                  & filters("x", "y", percent), "left_semi")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that truly link, by the size of the intersection of their whole sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    return pairs.join(left, "a").join(right, "b").where(
        100 * both >= percent * (F.size("ga") + F.size("gb") - both)).select("a", "b").distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, bits: int = 20, rounds: int = 2) -> DataFrame:
    """Component of near copies of every document: (doc_id, n_shingles, component_id), one row per row of ``docs``.

    Two documents link when their sets of distinct ``n``-word shingles (A-Z lower-cased; fewer words: the whole sequence
    as one) have a Jaccard similarity of at least ``percent`` / 100. component_id is the smallest doc_id reachable.

    1. Occurrences of all shingles are counted in 2^bits cells (a bounded array, broadcast); they order shingles
       rare-first. Any order gives the same links; a finer one only gives fewer candidates.
    2. Equal sets become one representative by their fingerprint, so groups of exact copies cost no pairs.
    3. A link must share a shingle of both prefixes. Prefix shingles of one document only are dropped; rows whose
       shingle has no partner that passes the filters are dropped by a semi-join, which never emits a pair twice.
    4. Whole sets are fetched for the documents left. In ``rounds`` first rounds each document is verified against
       one partner drawn from the rows that share its shingles; this joins large groups with few pairs.
    5. All other pairs that pass the filters and whose ends are still in different components are verified, once each.
       No pair is left out: pairs within a component cannot change it.

    Null and empty texts have the empty set and link with nothing; a null doc_id has no component (null); rows that
    repeat a doc_id are one node with all their sets; other columns are ignored. Empty input gives an empty table.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    seen = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, n, bits))
    each = stored(_described(docs, n, percent, seen, bits), "shingle-prefixes")
    named = each.where("n > 0 AND doc_id IS NOT NULL")
    reps = stored(named.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "representatives")
    ones = named.join(reps.withColumnRenamed("rep", "doc_id"), ["f1", "f2", "doc_id"], "left_semi")
    ones = stored(ones.dropDuplicates(["f1", "f2"]), "distinct-sets")
    rows = ones.select("doc_id", "n", F.posexplode("prefix").alias("at", "gram"))
    shared = rows.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    kept = stored(rows.join(shared, "gram"), "shared-prefixes")
    alive = stored(_with_partner(kept, _long_enough, percent), "rows-with-partner")
    alive = alive.join(ones.select("doc_id", "n", "cells"), ["doc_id", "n"])
    alive = stored(_with_partner(stored(alive, "rows-with-cells"), _may_link, percent), "rows-with-near-partner")
    needed = stored(alive.select("doc_id").distinct(), "documents-with-partner")
    whole = _full_sets(docs.join(needed, "doc_id", "left_semi"), n)
    whole = stored(whole.where(F.size("grams") > 0).distinct(), "whole-sets")
    # a repeated doc_id may stand for several sets: it links with the representative of each
    links = stored(named.join(reps, ["f1", "f2"]).where("rep <> doc_id").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")).join(
            ones.select(F.col("doc_id").alias("b")), "b", "left_semi"), "repeated-ids")
    for k in range(rounds):
        lot = F.xxhash64("doc_id", F.lit(k))
        near = Window.partitionBy("gram", (lot % (F.floor(F.col("df") / 2048) + 1))).orderBy(lot, "doc_id")
        drawn = alive.select("doc_id", F.lead("doc_id").over(near).alias("to")).where("to <> doc_id")
        drawn = drawn.groupBy("doc_id", "to").agg(F.count("*").alias("c")).groupBy("doc_id").agg(
            F.max_by("to", F.struct("c", "to")).alias("to"))
        pairs = drawn.select(F.least("doc_id", "to").alias("a"), F.greatest("doc_id", "to").alias("b")).distinct()
        links = links.unionByName(stored(_verify(pairs, whole, percent), "links"))
    joined = components(links)
    alive = alive.join(joined, F.col("doc_id") == F.col("node"), "left").withColumn(
        "group", F.coalesce("component", "doc_id")).drop("node", "component")
    x, y = alive.alias("x"), alive.alias("y")
    rest = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.doc_id") < F.col("y.doc_id"))
                  & (F.col("x.group") != F.col("y.group")) & _may_link("x", "y", percent))
    rest = rest.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    # the components of the first rounds stand for their links
    linked = components(_verify(rest, whole, percent).unionByName(
        joined.select(F.col("component").alias("a"), F.col("node").alias("b"))))
    member = each.join(reps, ["f1", "f2"], "left").select("doc_id", "n", F.when(F.col("n") > 0, F.col("rep")).alias("rep"))
    out = member.join(linked, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"),
                      F.coalesce("component", "rep", "doc_id").alias("component_id"))
