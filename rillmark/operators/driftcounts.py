"""Drift from counts alone: a reference is binned once, batches add counts, any trailing window is read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.operators.quality import SHARE_FLOOR, long_form
from rillmark.operators.scale import exact_percentiles, piece_of


def drift_reference(ref: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """(column_name, edges, bin, r): the reference's quantile edges and its count in every bin; -1 is the bin of nulls.

    One row per column and bin, with all bins in it, so that a batch may have none of a bin's values. Stored once, it is all that later
    batches need of the reference.
    """
    values = long_form(ref, columns)
    cuts = exact_percentiles(values, ["column_name"], "value", {f"e{i}": i / bins for i in range(1, bins)})
    edges = cuts.select("column_name", F.array(*[F.col(f"e{i}") for i in range(1, bins)]).alias("edges"))
    listed = ref.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    edges = listed.join(edges, "column_name", "left").select("column_name", F.coalesce("edges", F.array().cast("array<double>")).alias("edges"))
    every = edges.select("column_name", "edges", F.explode(F.sequence(F.lit(-1), F.size("edges"))).alias("bin"))
    counts = drift_counts(ref, every, columns).withColumnRenamed("c", "r")
    return every.join(counts, ["column_name", "bin"], "left").select(
        "column_name", "edges", "bin", F.coalesce("r", F.lit(0)).cast("bigint").alias("r"))


def drift_counts(batch: DataFrame, reference: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, bin, c): how many of a batch's values fall in each bin of the reference. Counts of batches add up."""
    edges = reference.groupBy("column_name").agg(F.any_value("edges").alias("edges"))  # one row per column
    placed = long_form(batch, columns).join(F.broadcast(edges), "column_name").withColumn(
        "bin", F.when(F.col("value").isNull(), -1).otherwise(piece_of("edges", F.col("value"))))
    return placed.groupBy("column_name", "bin").agg(F.count("*").alias("c"))


def psi(counts: DataFrame, reference: DataFrame, threshold: float = 0.2) -> DataFrame:
    """(column_name, psi, rows_ref, rows_cur, drifted) of added-up counts against the reference.

    Without rows on either side psi is null, and the column counts as drifted if only one side has some.
    """
    total = counts.groupBy("column_name", "bin").agg(F.sum("c").alias("c"))
    both = reference.join(total, ["column_name", "bin"], "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = both.groupBy("column_name").agg(F.sum("r").alias("rows_ref"), F.sum("c").alias("rows_cur"))
    rs, cs = (F.greatest(F.try_divide(n, s), F.lit(SHARE_FLOOR)) for n, s in (("r", "rows_ref"), ("c", "rows_cur")))
    # an empty bin on both sides adds nothing, as it has no share on either
    term = F.when((F.col("r") > 0) | (F.col("c") > 0), (cs - rs) * F.log(cs / rs)).otherwise(0.0)
    index = both.join(sums, "column_name").groupBy("column_name", "rows_ref", "rows_cur").agg(F.sum(term).alias("p"))
    full = (F.col("rows_ref") > 0) & (F.col("rows_cur") > 0)
    return index.select("column_name", F.when(full, F.col("p")).alias("psi"), "rows_ref", "rows_cur",
                        F.when(full, F.col("p") >= threshold).otherwise(F.col("rows_ref") != F.col("rows_cur")).alias("drifted"))


def trailing(counts: DataFrame, upto: int, batches: int) -> DataFrame:
    """Counts of the last ``batches`` batches up to number ``upto``; their folders are found by name."""
    return counts.where((F.col("batch_id") > upto - batches) & (F.col("batch_id") <= upto))


def drift_score(index: DataFrame) -> DataFrame:
    """One row: the largest index over all columns, the figure that a retrain rule compares; 0 if there is none."""
    return index.groupBy().agg(F.coalesce(F.max("psi"), F.lit(0.0)).alias("drift_score"))
