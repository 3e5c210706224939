"""Stream transformations: each takes a streaming DataFrame of events and returns one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators.events import decode, normalise_events, rejection_reasons

# How late an event may be. Fixed value of the contract.
LATENESS = "10 minutes"


def parse(messages: DataFrame) -> DataFrame:
    """Topic messages to normalised events."""
    return normalise_events(decode(messages))


def hourly_pair_stream(df: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """One-hour pair aggregates; the same expression as the batch twin, under a watermark."""
    return ft.hourly_pairs(df.withWatermark("timestamp", lateness))


def _length(interval: str) -> Column:
    """Microseconds of an interval of fixed length, such as ``1 hour``."""
    zero = F.timestamp_micros(F.lit(0))
    return F.unix_micros(zero + F.expr(f"INTERVAL {interval}")) - F.unix_micros(zero)


def sliding_user_stream(df: DataFrame, lateness: str = LATENESS, window: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    """Event count, ratings and last event per user and slide, in one stateful aggregation; :func:`sliding_windows` makes the
    sliding windows of them on reading.

    An event is kept once, in the last window that holds it, and not once for each of its windows; ``windows`` says how many hold it.
    Late events still count only for those windows that are open. To tell these, each batch also leaves one row (``windows`` 0)
    for every window its events fall into, of which the watermark lets only the open ones through. For update mode.
    """
    width = _length(slide)
    placed = df.withWatermark("timestamp", lateness).select(
        "user_id", "rating", "timestamp", F.window("timestamp", window, slide).alias("w"))
    own = F.unix_micros("timestamp") - F.unix_micros("w.start") < width
    held = -F.floor((F.unix_micros("timestamp") - F.unix_micros("w.end")) / width)
    rows = placed.withColumn("windows", F.when(own, held).otherwise(F.lit(0)).cast("int")).withColumn(
        "user_id", F.when(F.col("windows") > 0, F.col("user_id")))
    return rows.groupBy("user_id", "windows", "w").agg(
        F.count("*").alias("event_count"), F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n"),
        F.max("timestamp").alias("last_event_time"),
    ).select("user_id", "windows", "event_count", "rating_sum", "rating_n", "last_event_time",
             F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def sliding_windows(slide: str = "1 hour") -> Callable[[DataFrame], DataFrame]:
    """How the stored batches of :func:`sliding_user_stream` are read: sliding event count, mean rating and last event per user.

    A row adds to those of its windows that were open in its batch, up to the next batch that holds the same user and slide anew
    and in which they were open too. Rows of a user meet by user, before they are repeated for their windows. A compaction must
    keep all rows.
    """
    width = _length(slide)

    def merge(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({c: F.unix_micros(c) for c in ("window_start", "window_end")})
        opened = rows.groupBy("batch_id").agg(F.min("window_end").alias("_open"))  # one row per batch
        own = rows.where(F.col("windows") > 0).join(F.broadcast(opened), "batch_id").repartition("user_id")
        later = Window.partitionBy("user_id", "windows", "window_start").orderBy("batch_id")
        each = own.withColumn("_until", F.lead("_open").over(later)).withColumn("_len", F.col("window_end") - F.col("window_start"))
        first = F.col("window_start") - (F.col("windows") - 1) * width
        each = each.withColumn("_at", F.explode(F.sequence(first, F.col("window_start"), width)))
        end = F.col("_at") + F.col("_len")
        each = each.where((end >= F.col("_open")) & (F.col("_until").isNull() | (end < F.col("_until"))))
        return each.groupBy("user_id", "_at").agg(
            F.sum("event_count").alias("event_count"),
            (F.sum("rating_sum") / F.nullif(F.sum("rating_n"), F.lit(0))).alias("avg_rating"),
            F.max("last_event_time").alias("last_event_time"), F.max("_len").alias("_len"),
        ).select("user_id", "event_count", "avg_rating", "last_event_time", F.timestamp_micros("_at").alias("window_start"),
                 F.timestamp_micros(F.col("_at") + F.col("_len")).alias("window_end"))
    return merge


def item_hourly_stream(df: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return ft.item_hourly(df.withWatermark("timestamp", lateness))


def running_state_stream(df: DataFrame, key: str, rating_default: float | None = None) -> DataFrame:
    """Running count, rating sum, views, clicks and last time per key; in update mode only changed keys come out.

    Map-side partial aggregation runs in every micro-batch, so a hot key reaches its state as one row per task.
    """
    return ft.entity_state(df, key, rating_default)


def dedup_stream(df: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Drop repeated event ids that arrive within the lateness; the state is dropped after that."""
    return df.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["event_id"])


def checked_stream(df: DataFrame) -> DataFrame:
    """Add ``reasons`` and ``valid``; the sink separates valid events and dead letters."""
    return df.withColumn("reasons", rejection_reasons()).withColumn("valid", F.size("reasons") == 0)


def served_clicks_stream(served: DataFrame, clicks: DataFrame, hours: int = 24, lateness: str = LATENESS,
                         how: str = "inner") -> DataFrame:
    """Served items with the clicks that follow within ``hours``; both states are bounded by watermarks.

    ``how='leftOuter'`` also returns served items without a click, once the watermark has passed their window.
    """
    s = served.withColumnRenamed("timestamp", "served_at").withWatermark("served_at", lateness).alias("s")
    c = clicks.select(
        F.col("user_id").alias("c_user"), F.col("item_id").alias("c_item"), F.col("timestamp").alias("clicked_at")
    ).withWatermark("clicked_at", lateness).alias("c")
    return s.join(c, F.expr(f"""
        user_id = c_user AND item_id = c_item AND clicked_at >= served_at
        AND clicked_at <= served_at + INTERVAL {int(hours)} HOURS"""), how).drop("c_user", "c_item")
