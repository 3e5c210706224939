"""Building blocks that keep one hot key from becoming one hot task.

A window partitioned by a user, item or series sends the whole group to one task. The functions here cut each group into
buckets (of time, rank or hash), solve each bucket on its own and carry a small per-bucket summary across. Results
are exact; only the partitioning changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import col, sha_hex
from rillmark.session import checkpointed

_FIRST = Window.unboundedPreceding
_LARGEST = 1.7976931348623157e308
ROWS = 200_000  # rows of a group that one task may order
CUTS = 256  # parts a value range is cut into at a time
MOST_PIECES = 10_000  # value ranges of a column that is ordered whole


def running_total(
    df: DataFrame, keys: Sequence[str], bucket: str, order_by: Sequence[Column | str], value: Column, out: str,
    peers: bool = False,
) -> DataFrame:
    """Add ``out``, the sum of ``value`` over the group's rows up to this one, in (bucket, order_by) order.

    ``bucket`` must rise with ``order_by``. Rows are shuffled by (keys, bucket); what crosses buckets is one partial
    sum per bucket. ``peers`` counts rows with equal order values together (RANGE instead of ROWS).
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, bucket).orderBy(*order_by)
    inside = inside.rangeBetween(_FIRST, 0) if peers else inside.rowsBetween(_FIRST, 0)
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(_FIRST, -1)
    marked = df.withColumn("_v", value)
    offsets = (
        marked.groupBy(*keys, bucket).agg(F.sum("_v").alias("_t"))
        .select(*keys, bucket, F.sum("_t").over(earlier).alias("_base"))
    )
    return (
        marked.join(offsets, [*keys, bucket], "left")
        .withColumn(out, F.sum("_v").over(inside) + F.coalesce(F.col("_base"), F.lit(0)))
        .drop("_v", "_base")
    )


def previous_value(
    df: DataFrame, keys: Sequence[str], bucket: str, order_by: Sequence[str], value: Column, out: str
) -> DataFrame:
    """Add ``out``, ``value`` of the row before this one in its group (null for the first).

    The last value of each bucket is carried to the next non-empty bucket, so a group is never sorted in one task.
    """
    keys = list(keys)
    marked = df.withColumn("_s", F.struct(value.alias("v")))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order_by)
    across = Window.partitionBy(*keys).orderBy(bucket)
    carried = (
        marked.groupBy(*keys, bucket).agg(F.max_by("_s", F.struct(*[col(c) for c in order_by])).alias("_last"))
        .select(*keys, bucket, F.lag("_last").over(across).alias("_carry"))
    )
    return (
        marked.join(carried, [*keys, bucket], "left")
        .withColumn(out, F.coalesce(F.lag("_s").over(inside), F.col("_carry"))["v"])
        .drop("_s", "_carry")
    )


def dense_index(df: DataFrame, key: str, out: str) -> DataFrame:
    """Number the distinct values of ``key`` 0..n-1 in the order of their SHA-256.

    The hash spreads the values evenly over 65 536 buckets, so the numbering is a distributed prefix sum; no label list
    passes through the driver.
    """
    ids = df.select(key).where(col(key).isNotNull()).distinct()
    ids = ids.withColumn("_h", sha_hex(key)).withColumn("_b", F.substring("_h", 1, 4))
    numbered = running_total(ids, [], "_b", ["_h"], F.lit(1), "_n")
    return numbered.select(key, (F.col("_n") - 1).cast("bigint").alias(out))


def smallest_by_hash(df: DataFrame, hashed: str, n: Column, ties: Sequence[str]) -> DataFrame:
    """The ``n`` rows (a scalar column) with the smallest values of a uniform 32-bit hash, ties by further columns.

    A histogram over the hash's leading 20 bits finds the slice in which the n-th row lies. Rows below it are kept by a
    filter; only the rows of that one slice are ordered. ``df`` is read several times, so it should be stored.
    """
    placed = df.withColumn("_b", F.shiftright(hashed, 12))
    hist = placed.groupBy("_b").agg(F.count("*").alias("_c"))
    earlier = Window.orderBy("_b").rowsBetween(_FIRST, -1)  # at most 2^20 rows
    starts = hist.select("_b", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_start"))
    edge = starts.where(F.col("_start") < n).groupBy().agg(F.max(F.struct("_b", "_start")).alias("e")).scalar()
    below = placed.where(F.col("_b") < edge["_b"])
    inside = placed.where(F.col("_b") == edge["_b"]).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_b").orderBy(hashed, *ties)))
    return below.unionByName(inside.where(F.col("_rn") <= n - edge["_start"]).drop("_rn")).drop("_b")


def narrowed(counts: DataFrame, places: DataFrame, rows: int) -> DataFrame:
    """Cut the slices of ``places`` (_k, n, lo, hi, d, base, pos) until none holds more than ``rows`` distinct values of ``counts``
    (_k, _v, _c); base counts the group's rows before a slice, d its distinct values."""
    def finite(c: Column | str) -> Column:
        """Half of a value, so that differences stay in range; infinite ones and NaN count as the largest."""
        return F.greatest(F.least(F.col(c) if isinstance(c, str) else c, F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2

    width = finite("hi") - finite("lo")
    open_ = (F.col("d") > rows) & (width > 0)
    inside = (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))
    while places.where(open_).limit(1).count():
        wide = places.where(open_)
        slices = wide.select(F.col("_k").alias("_s"), "lo", "hi").distinct()
        part = F.least(F.floor((finite("_v") - finite("lo")) / width * CUTS), F.lit(CUTS - 1))
        parts = counts.join(slices, (F.col("_k") == F.col("_s")) & inside).groupBy("_s", "lo", part.alias("part")).agg(
            F.sum("_c").alias("c"), F.count("*").alias("pd"), F.min("_v").alias("plo"), F.max("_v").alias("phi"))
        upto = Window.partitionBy("_s", "lo").orderBy("part")  # CUTS rows at most
        parts = parts.withColumn("before", F.sum("c").over(upto) - F.col("c")).withColumnRenamed("lo", "_lo")
        left = F.col("pos") - F.col("base")
        found = wide.join(parts, (F.col("_k") == F.col("_s")) & (F.col("lo") == F.col("_lo"))
                          & (left >= F.col("before")) & (left < F.col("before") + F.col("c")))
        found = found.select("_k", "n", F.col("plo").alias("lo"), F.col("phi").alias("hi"), F.col("pd").alias("d"),
                             (F.col("base") + F.col("before")).alias("base"), "pos")
        places = checkpointed(places.where(~open_).unionByName(found), "places")
    return places


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float], rows: int = 0) -> DataFrame:
    """Exact interpolated percentiles per group by repeated narrowing; no task orders more than ``rows`` (ROWS) values.

    Equal values are counted first. A slice of a group's value range that holds a wanted position and more than ``rows`` distinct
    values is cut into CUTS equal parts, whose counts say in which part the position lies; that part is cut again, and so on.
    Wherever the values crowd, the slices follow them. Only the values of the last slices are put in order. Null values are left out;
    groups with a null key are groups; NaN counts as the largest value.
    """
    rows = rows or ROWS
    name_key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_all"))
    counts = df.where(col(value).isNotNull()).groupBy(name_key.alias("_k"), F.col(value).cast("double").alias("_v")).agg(
        F.count("*").alias("_c"))
    counts = checkpointed(counts, "value-counts")
    stats = counts.groupBy("_k").agg(F.sum("_c").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"),
                                     F.count("*").alias("d"))
    at = {name: F.lit(float(p)) * (F.col("n") - 1) for name, p in probabilities.items()}
    wanted = F.array_distinct(F.array(*[f(x).cast("bigint") for x in at.values() for f in (F.floor, F.ceil)]))
    places = checkpointed(stats.select("_k", "n", "lo", "hi", "d", F.lit(0).cast("bigint").alias("base"),
                                       F.explode(wanted).alias("pos")), "places")

    places = narrowed(counts, places, rows)
    inside = (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))
    slices = places.select(F.col("_k").alias("_s"), "lo", "hi").distinct()
    ordered = counts.join(slices, (F.col("_k") == F.col("_s")) & inside).select("_s", F.col("lo").alias("_lo"), "_v", "_c")
    ordered = ordered.withColumn("cum", F.sum("_c").over(Window.partitionBy("_s", "_lo").orderBy("_v")))
    left = F.col("pos") - F.col("base")
    values = places.join(ordered, (F.col("_k") == F.col("_s")) & (F.col("lo") == F.col("_lo"))
                         & (F.col("cum") > left) & (F.col("cum") - F.col("_c") <= left))
    per = values.groupBy("_k", "n").agg(F.map_from_entries(F.collect_list(F.struct("pos", "_v"))).alias("m"))  # two per probability
    outs = []
    for name, x in at.items():
        lo, hi = (F.element_at("m", f(x).cast("bigint")) for f in (F.floor, F.ceil))
        outs.append((lo + F.when(hi == lo, 0.0).otherwise((hi - lo) * (x - F.floor(x)))).alias(name))
    return per.select(*[F.col(f"_k.{k}").alias(k) for k in keys], "n", *outs)


def value_pieces(df: DataFrame, value: str, out: str, rows: int = 0) -> DataFrame:
    """Add ``out``, the number of the value range a row falls in, ranges holding about ``rows`` (ROWS) rows each.

    The ranges come from approximate quantiles; their number follows from the number of rows, up to MOST_PIECES. The edges are computed
    once and become constants of the plan, so that every use places a row alike.
    """
    pieces = min(MOST_PIECES, -(-df.count() // (rows or ROWS)))
    if pieces <= 1:  # not a literal: a join on a constant would lose its key
        return df.withColumn(out, F.pmod(F.xxhash64(value), F.lit(1)).cast("int"))
    return df.withColumn(out, piece_of(F.array(*[F.lit(float(e)) for e in _edges(df, value, pieces)]), F.col(value).cast("double")))


def piece_of(edges: Column | str, value: Column) -> Column:
    """How many of the edges lie below the value."""
    return F.size(F.filter(edges, lambda e: e < value))


def _edges(df: DataFrame, value: str, pieces: int) -> list[float]:
    cuts = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    return df.groupBy().agg(F.percentile_approx(col(value), cuts, F.lit(max(2000, 8 * pieces))).alias("e")).first().e or []


def _hot_counts(df: DataFrame, key: str, share: float) -> DataFrame:
    counts = df.groupBy(key).agg(F.count("*").alias("_c"))
    total = counts.agg(F.sum("_c")).scalar()
    return counts.where(F.col("_c") > F.lit(float(share)) * total)


def hot_keys(df: DataFrame, key: str, share: float = 1 / 256) -> DataFrame:
    """Keys that hold more than ``share`` of all rows; by that definition there are fewer than 1/share of them."""
    return _hot_counts(df, key, share).select(key)


def salted_join(
    big: DataFrame, small: DataFrame, key: str, how: str = "inner", rows: int = 0, share: float = 1 / 256
) -> DataFrame:
    """Equi-join that spreads the rows of hot keys over as many tasks as their number asks for: about ``rows`` (ROWS) to each.

    Only the small side's rows of hot keys are repeated. The salt is a hash of the row, so a recomputed task draws the
    same one. The list of hot keys is broadcast: it cannot hold more than 1/share rows.
    """
    salts = F.ceil(F.col("_c") / F.lit(rows or ROWS)).cast("int")
    hot = F.broadcast(_hot_counts(big, key, share).select(key, salts.alias("_salts")))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.col("_salts")).cast("int")
    left = big.join(hot, key, "left").withColumn("_salt", F.coalesce(spread, F.lit(0))).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0)))
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def top_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """The first ``n`` rows of every group with their rank.

    Spark keeps only ``n`` rows per group and map task before the shuffle (window group limit), so a group of any size
    arrives as at most n rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)
