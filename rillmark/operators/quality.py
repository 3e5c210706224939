"""Data quality checks, column profiles and drift."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.operators import scale
from rillmark.session import checkpointed

# Smallest share a bin is given in the population stability index. Fixed value.
SHARE_FLOOR = 1e-6


def check_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column, all counted in one scan: (column_name, nulls)."""
    counted = df.groupBy().agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def duplicate_keys(df: DataFrame, unique: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*unique).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def check_no_duplicates(df: DataFrame, unique: Sequence[str]) -> DataFrame:
    """One row: surplus rows beyond the first of each key."""
    return duplicate_keys(df, unique).groupBy().agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"))


def check_time_range(df: DataFrame, time_col: str, as_of) -> DataFrame:
    """One row: first and last time, and rows after the as-of time."""
    at = F.lit(as_of).cast(df.schema[time_col].dataType)
    return df.groupBy().agg(F.min(time_col).alias("first"), F.max(time_col).alias("last"),
                            F.count_if(F.col(time_col) > at).alias("in_future"))


def schema_differences(df: DataFrame, expected) -> list[str]:
    """Missing columns and columns of another type, from the schema alone."""
    have = {f.name: f.dataType for f in df.schema.fields}
    found = []
    for f in expected.fields:
        if f.name not in have:
            found.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            found.append(f"type of {f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}")
    return found


def dq_report(
    df: DataFrame, critical: Sequence[str], min_rows: int, unique: Sequence[str] | None = None,
    time_col: str | None = None, as_of=None,
) -> DataFrame:
    """All checks in order: step, check_name, failures, passed, and whether it is the first that failed."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in critical]
    aggs.append(F.greatest(F.lit(min_rows) - F.count("*"), F.lit(0)).cast("bigint").alias("row_count"))
    if time_col:
        at = F.lit(as_of).cast(df.schema[time_col].dataType)
        aggs.append(F.count_if(F.col(time_col) > at).alias("future_time"))
    names = [f"nulls:{c}" for c in critical] + ["row_count"] + (["duplicates"] if unique else []) + (
        ["future_time"] if time_col else [])
    one = df.groupBy().agg(*aggs)
    if unique:
        one = one.withColumn("duplicates", check_no_duplicates(df, unique).scalar())
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("check_name"),
                               F.col(f"`{n}`").cast("bigint").alias("failures")) for i, n in enumerate(names)])
    rows = one.select(F.inline(steps)).withColumn("passed", F.col("failures") == 0)
    # The report has one row per check.
    first = F.min(F.when(~F.col("passed"), F.col("step"))).over(Window.partitionBy())
    return rows.withColumn("first_failure", F.coalesce(F.col("step") == first, F.lit(False)))


def long_form(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """(column_name, value) rows of the chosen columns."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, missing, distinct values, share missing and constancy per column, in one pass of (column, value) counts.

    A value stands in by 128 bits of hash and a column by its number, so that what is grouped and shuffled has a fixed, small size.
    """
    columns = list(columns or df.columns)

    def value(i: int, name: str):
        v = F.col(f"`{name}`")
        return F.struct(F.lit(i).alias("i"), F.when(v.isNotNull(), F.xxhash64(v)).alias("h"),
                        F.when(v.isNotNull(), F.xxhash64(F.lit(1), v)).alias("g"))

    each = F.explode(F.array(*[value(i, c) for i, c in enumerate(columns)]))
    counts = df.select(each.alias("s")).groupBy("s.i", "s.h", "s.g").agg(F.count("*").alias("n"))
    per = counts.groupBy("i").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("h").alias("distinct_values"))
    names = F.array(*[F.lit(c) for c in columns])
    return per.select(F.element_at(names, F.col("i") + 1).alias("column_name"), "row_count", "missing", "distinct_values",
                      (F.col("missing") / F.col("row_count")).alias("missing_share"),
                      (F.col("distinct_values") <= 1).alias("constant"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows that repeat an earlier row in every column."""
    return check_no_duplicates(df, df.columns)


def drift(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str], bins: int = 10, threshold: float = 0.2,
) -> DataFrame:
    """Population stability index, Kolmogorov-Smirnov distance and null shares per column; every column is reported.

    Both tables are counted together by (column, value); running totals of these counts give the reference's quantile
    edges and the exact distance between the two distributions. Nulls are a bin of their own in the index and no part of the
    distance. If one table has no rows, psi is null and the column counts as drifted; ks is null where a side has no value.
    """
    mark = long_form(ref, columns).withColumn("_r", F.lit(1)).unionByName(long_form(cur, columns).withColumn("_r", F.lit(0)))
    counts = mark.groupBy("column_name", "value").agg(F.sum("_r").alias("r"), F.sum(1 - F.col("_r")).alias("c"))
    counts = checkpointed(counts, "drift-counts")  # read for the cuts, both running totals and the bins
    filled = counts.where(F.col("value").isNotNull())
    # Value ranges of about ROWS distinct values, whose running totals are taken apart. A value is placed once, by Spark's range
    # partitioning, and its range is stored; no row is compared with the cuts one by one.
    pieces = max(1, min(scale.MOST_PIECES, -(-filled.count() // scale.ROWS)))
    placed = checkpointed(filled.repartitionByRange(pieces, "column_name", "value").withColumn("_b", F.spark_partition_id()), "drift-ranges")
    upto = Window.partitionBy("column_name", "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("column_name").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    whole = Window.partitionBy("column_name")
    sums = placed.groupBy("column_name", "_b").agg(F.sum("r").alias("_r"), F.sum("c").alias("_c")).select(
        "column_name", "_b", F.sum("_r").over(whole).alias("rn"), F.sum("_c").over(whole).alias("cn"),
        F.coalesce(F.sum("_r").over(before), F.lit(0)).alias("_r"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_c"))
    placed = placed.join(sums, ["column_name", "_b"]).withColumns({
        "ru": F.sum("r").over(upto) + F.col("_r"), "cu": F.sum("c").over(upto) + F.col("_c")})
    firsts = []
    for i in range(1, bins):
        at = F.lit(i / bins) * (F.col("rn") - 1)
        firsts += [F.min(F.when(F.col("ru") > F.floor(at), F.col("value"))).alias(f"_lo{i}"),
                   F.min(F.when(F.col("ru") > F.ceil(at), F.col("value"))).alias(f"_hi{i}")]
    gap = F.abs(F.try_divide("ru", "rn") - F.try_divide("cu", "cn"))
    found = placed.groupBy("column_name").agg(F.max(gap).alias("ks"), F.any_value("rn").alias("rn"), *firsts)
    edges = [F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (at - F.floor(at))
             for i in range(1, bins) for at in [F.lit(i / bins) * (F.col("rn") - 1)]]
    found = found.select("column_name", "ks", F.filter(F.array(*edges), lambda e: e.isNotNull()).alias("edges"))
    binned = counts.join(F.broadcast(found.select("column_name", "edges")), "column_name", "left").withColumn(
        "bin", F.when(F.col("value").isNull(), -1).otherwise(F.size(F.filter("edges", lambda e: e < F.col("value")))))
    binned = binned.groupBy("column_name", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    per_column = Window.partitionBy("column_name")  # at most bins + 1 rows per column
    rs, cs = (F.greatest(F.try_divide(n, F.sum(n).over(per_column)), F.lit(SHARE_FLOOR)) for n in "rc")
    shares = binned.select("column_name", "bin", "r", "c", rs.alias("rs"), cs.alias("cs"))
    index = shares.groupBy("column_name").agg(
        F.sum((F.col("cs") - F.col("rs")) * F.log(F.col("cs") / F.col("rs"))).alias("psi"),
        F.sum("r").alias("rows_ref"), F.sum("c").alias("rows_cur"),
        *[F.try_divide(F.coalesce(F.sum(F.when(F.col("bin") == -1, F.col(n))), F.lit(0)), F.sum(n)).alias(f"{name}_null_share")
          for n, name in (("r", "ref"), ("c", "cur"))])
    both = (F.col("rows_ref") > 0) & (F.col("rows_cur") > 0)
    listed = ref.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column_name"))
    out = listed.join(index, "column_name", "left").join(found.select("column_name", "ks"), "column_name", "left")
    return out.select("column_name", F.when(both, F.col("psi")).alias("psi"), "ks", "ref_null_share", "cur_null_share",
                      F.coalesce(F.when(both, F.col("psi") >= F.lit(threshold)).otherwise(
                          F.col("rows_ref") != F.col("rows_cur")), F.lit(False)).alias("drifted"))


def dataset_drift(per_column: DataFrame, share: float = 0.5) -> DataFrame:
    """One row: drifted columns, their share and the data-set flag."""
    return per_column.groupBy().agg(
        F.count_if("drifted").alias("drifted_columns"), F.count("*").alias("columns"),
    ).withColumn("drift_share", F.col("drifted_columns") / F.col("columns")).withColumn(
        "dataset_drift", F.col("drift_share") >= F.lit(share))


def target_drift(ref: DataFrame, cur: DataFrame, label: str = "label", threshold: float = 0.1) -> DataFrame:
    """Change of the label's distribution over its values; without the column in both tables there is no drift.

    Labels are classes, so every value, null included, is a bin of its own. If one side has no rows, psi is null and the
    label counts as drifted.
    """
    if label not in ref.columns or label not in cur.columns:
        spark = ref.sparkSession
        return spark.range(1).select(F.lit(label).alias("column_name"), F.lit(None).cast("double").alias("psi"),
                                     F.lit(False).alias("drifted"))

    def marked(df: DataFrame, mine: int) -> DataFrame:
        return df.select(F.col(label).cast("string").alias("v"), F.lit(mine).alias("_r"))

    counts = marked(ref, 1).unionByName(marked(cur, 0)).groupBy("v").agg(F.sum("_r").alias("r"), F.sum(1 - F.col("_r")).alias("c"))
    total = counts.groupBy().agg(F.struct(F.coalesce(F.sum("r"), F.lit(0)).alias("r"), F.coalesce(F.sum("c"), F.lit(0)).alias("c"))).scalar()
    rs, cs = (F.greatest(F.try_divide(n, total[n]), F.lit(SHARE_FLOOR)) for n in "rc")
    one = counts.select(((cs - rs) * F.log(cs / rs)).alias("p"), "r", "c").groupBy().agg(
        F.sum("p").alias("p"), F.coalesce(F.sum("r"), F.lit(0)).alias("r"), F.coalesce(F.sum("c"), F.lit(0)).alias("c"))
    both = (F.col("r") > 0) & (F.col("c") > 0)
    return one.select(F.lit(label).alias("column_name"), F.when(both, F.col("p")).alias("psi"),
                      F.when(both, F.col("p") >= threshold).otherwise(F.col("r") != F.col("c")).alias("drifted"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
