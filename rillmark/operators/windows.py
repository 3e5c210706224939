"""Per-row history: latest rows, rolling counts, sequences, rate limits and percentile ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import col, micros, time_bucket
from rillmark.operators.features import item_popularity
from rillmark.operators.scale import previous_value, running_total, top_per_group

_US = 1_000_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("timestamp", "event_id")) -> DataFrame:
    """The newest full row per key, ties broken by the later order columns."""
    return top_per_group(df, keys, [F.desc(c) for c in order], 1, "_rn").drop("_rn")


def user_history(df: DataFrame, n: int = 50) -> DataFrame:
    """The newest ``n`` interactions of every user with their position."""
    return top_per_group(df, ["user_id"], [F.desc("timestamp"), F.desc("event_id")], n, "position")


def popularity_percentile(df: DataFrame) -> DataFrame:
    """Share of the other items that are less popular, per item (0 for the least popular).

    Items are first counted by popularity. D distinct counts need at least D*(D-1)/2 events, so the histogram has at
    most sqrt(2 * events) rows and the only unpartitioned window runs over those.
    """
    counts = item_popularity(df)
    hist = counts.groupBy("popularity").agg(F.count("*").alias("items"))
    before = Window.orderBy("popularity").rowsBetween(Window.unboundedPreceding, -1)
    ranked = hist.select("popularity", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("_below"),
                         F.sum("items").over(Window.partitionBy()).alias("_all"))
    rest = F.col("_all") - F.lit(1)
    share = F.when(rest > 0, F.col("_below") / rest).otherwise(F.lit(0.0))
    return counts.join(ranked, "popularity").select("item_id", "popularity", share.alias("popularity_percentile"))


def rolling_counts(
    df: DataFrame, windows: dict[str, dict[str, int]], event_id: str = "event_id", ts: str = "timestamp",
    bucket_seconds: int = 300,
) -> DataFrame:
    """Events of each key in [t - window, t] at every event; returns the event id, the keys and the counts.

    ``windows`` maps key column -> {output name: seconds}. Each event enters its key's history with +1 and leaves with -1 just
    after the window; a count is the running total of these marks. Marks are summed inside short time buckets
    and carried across as one partial sum per bucket, so a busy key is spread over its buckets and the window
    length does not change the work. All keys and windows share one scan and one shuffle of narrow rows.
    """
    names = [n for per_key in windows.values() for n in per_key]
    t = micros(ts)

    def mark(key: str, at: Column, own: bool, changed: dict[str, int]) -> Column:
        return F.struct(
            F.lit(key).alias("_kind"), F.col(key).cast("string").alias("_key"), at.alias("_t"),
            (F.col(event_id) if own else F.lit(None)).alias("_id"),
            *[F.lit(changed.get(n, 0)).alias(f"_d_{n}") for n in names],
        )

    marks = []
    for key, per_key in windows.items():
        marks.append(mark(key, t, True, dict.fromkeys(per_key, 1)))
        for name, seconds in per_key.items():
            marks.append(mark(key, t + F.lit(int(seconds) * _US + 1), False, {name: -1}))
    width = F.lit(int(bucket_seconds) * _US)
    rows = df.select(F.inline(F.array(*marks))).withColumn("_b", F.floor(F.col("_t") / width).cast("bigint"))
    group = ["_kind", "_key"]
    inside = Window.partitionBy(*group, "_b").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*group, "_b").agg(*[F.sum(f"_d_{n}").alias(f"_s_{n}") for n in names])
    offsets = sums.select(*group, "_b", *[F.sum(f"_s_{n}").over(earlier).alias(f"_o_{n}") for n in names])
    counted = rows.join(offsets, [*group, "_b"]).select(
        *group, "_id",
        *[(F.sum(f"_d_{n}").over(inside) + F.coalesce(F.col(f"_o_{n}"), F.lit(0))).alias(n) for n in names],
    ).where(F.col("_id").isNotNull())
    return counted.groupBy(F.col("_id").alias(event_id)).agg(
        *[F.max(F.when(F.col("_kind") == key, F.col("_key"))).alias(key) for key in windows],
        *[F.max(F.when(F.col("_kind") == key, F.col(n))).alias(n) for key, per_key in windows.items() for n in per_key],
    )


def interaction_sequence(df: DataFrame, bucket_seconds: int = 86_400) -> DataFrame:
    """Position, previous item and gap in seconds of every interaction in its user's sequence.

    The sequence stays one row per event; it is not folded into one array per user.
    """
    b = df.withColumn("_b", time_bucket("timestamp", bucket_seconds))
    order = ["timestamp", "event_id"]
    with_prev = previous_value(b, ["user_id"], "_b", order, F.struct("item_id", "timestamp"), "_p")
    numbered = running_total(with_prev, ["user_id"], "_b", order, F.lit(1), "position")
    return numbered.withColumn("previous_item", F.col("_p.item_id")).withColumn(
        "gap_seconds", (micros("timestamp") - F.unix_micros("_p.timestamp")) / F.lit(float(_US))
    ).drop("_b", "_p")


def rate_limited(
    df: DataFrame, key: str, limit: int = 100, window_s: int = 60, ts: str = "timestamp",
    order: Sequence[str] = ("timestamp", "event_id"), slices: int = 60,
) -> DataFrame:
    """Number every request in its client's fixed window and flag those over the limit.

    A client that floods one window is numbered in ``slices`` pieces of the window.
    """
    marked = df.withColumn("window_id", time_bucket(ts, window_s)).withColumn(
        "_b", time_bucket(ts, window_s / slices))
    numbered = running_total(marked, [key, "window_id"], "_b", list(order), F.lit(1), "request_no")
    return numbered.withColumn("rejected", F.col("request_no") > F.lit(int(limit))).drop("_b")


def alert_runs(df: DataFrame, series: str, at: str, condition: Column, step_s: int, min_windows: int) -> DataFrame:
    """Runs of at least ``min_windows`` adjacent windows in which the condition held.

    ``df`` has one row per series and window of ``step_s`` seconds; a missing window ends a run.
    """
    number = time_bucket(at, step_s)
    held = df.where(condition).select(col(series).alias("series"), col(at).alias("_at"), number.alias("_n"))
    w = Window.partitionBy("series").orderBy("_n")
    runs = held.withColumn("_island", F.col("_n") - F.row_number().over(w))
    return runs.groupBy("series", "_island").agg(
        F.min("_at").alias("started"), F.max("_at").alias("last_window"), F.count("*").alias("windows")
    ).where(F.col("windows") >= min_windows).drop("_island")
