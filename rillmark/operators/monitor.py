"""Service and model metrics over time-series tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.columns import col, micros, safe_ratio, time_bucket
from rillmark.operators.scale import exact_percentiles, previous_value

_US = 1_000_000


def window_start(ts, seconds: int) -> Column:
    return F.timestamp_micros(time_bucket(ts, seconds) * F.lit(seconds * _US))


def counter_rate(df: DataFrame, seconds: int = 300, series: str = "series", ts: str = "timestamp",
                 value: str = "value") -> DataFrame:
    """Increase per second of a counter in fixed windows; a drop is a reset, after which the value is the increase."""
    b = df.select(series, ts, value).withColumn("_b", time_bucket(ts, 12 * seconds))
    prev = previous_value(b, [series], "_b", [ts, value], col(value), "_p")
    delta = F.when(F.col("_p").isNull(), F.lit(0)).when(F.col(value) >= F.col("_p"), F.col(value) - F.col("_p")).otherwise(
        F.col(value))
    return prev.groupBy(series, window_start(ts, seconds).alias("window_start")).agg(
        (F.sum(delta) / F.lit(float(seconds))).alias("rate"))


def histogram(df: DataFrame, key: str, value: str, bounds: list[float]) -> DataFrame:
    """Cumulative bucket counts (key, le, cumulative) of a value; the last bound is open."""
    edges = F.array(*[F.lit(float(b)) for b in bounds])
    # Rows are counted per bucket first; the running sum is over at most len(bounds) + 1 buckets per key.
    bucket = F.size(F.filter(edges, lambda e: e < F.col(value)))
    counts = df.where(F.col(value).isNotNull()).groupBy(key, bucket.alias("b")).agg(F.count("*").alias("c"))
    filled = counts.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("b", "c"))).alias("m"))
    per = filled.select(key, F.posexplode(F.array(*[
        F.coalesce(F.element_at("m", F.lit(i)), F.lit(0)) for i in range(len(bounds) + 1)])).alias("b", "c"))
    upto = Window.partitionBy(key).orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    le = F.coalesce(F.get(edges, F.col("b")), F.lit(float("inf")))
    return per.select(key, le.alias("le"), F.sum("c").over(upto).alias("cumulative"))


def histogram_quantile(hist: DataFrame, q: float, key: str) -> DataFrame:
    """Quantile from cumulative buckets by linear interpolation; in the open bucket it is the highest bound."""
    w = Window.partitionBy(key).orderBy("le")
    rows = hist.select(
        key, "le", "cumulative", F.lag("cumulative", 1, 0).over(w).alias("prev"),
        F.lag("le", 1, 0.0).over(w).alias("lower"), F.max("cumulative").over(Window.partitionBy(key)).alias("total"))
    want = F.lit(q) * F.col("total")
    inside = F.col("lower") + (F.col("le") - F.col("lower")) * (want - F.col("prev")) / (
        F.nullif(F.col("cumulative") - F.col("prev"), F.lit(0)))
    answer = F.when(F.col("le") == F.lit(float("inf")), F.col("lower")).otherwise(inside)
    hit = rows.where((F.col("cumulative") >= want) & (F.col("total") > 0))
    return hit.groupBy(key).agg(F.min_by(answer, "le").alias("quantile"))


def ratio_by_window(df: DataFrame, hit: Column, key: str, seconds: int, ts: str = "timestamp") -> DataFrame:
    """Requests, hits and their ratio per key and window."""
    return df.groupBy(key, window_start(ts, seconds).alias("window_start")).agg(
        F.count("*").alias("requests"), F.count_if(hit).alias("hits")).withColumn("ratio", safe_ratio("hits", "requests"))


def error_ratio(df: DataFrame, key: str = "service", seconds: int = 300, status: str = "status") -> DataFrame:
    """Share of responses with a 5xx status per service and window."""
    return ratio_by_window(df, (F.col(status) >= 500) & (F.col(status) < 600), key, seconds)


def slowest(df: DataFrame, n: int, key: str = "endpoint", value: str = "latency_ms") -> DataFrame:
    """The ``n`` endpoints with the highest 95th percentile latency."""
    return exact_percentiles(df, [key], value, {"p95": 0.95}).orderBy(F.desc("p95"), F.asc(key)).limit(n)


def status_distribution(df: DataFrame, status: str = "status") -> DataFrame:
    """Requests and share per status."""
    counts = df.groupBy(status).agg(F.count("*").alias("requests"))
    total = counts.groupBy().agg(F.sum("requests").cast("double")).scalar()
    return counts.withColumn("share", F.col("requests") / total)


def throughput(df: DataFrame, by: str = "service", seconds: int = 3600, ts: str = "timestamp") -> DataFrame:
    """Requests per second of each series and, under a null name, of all together, by tumbling window.

    The total is added from the series' counts, so the requests are read and grouped once.
    """
    counts = df.groupBy(by, window_start(ts, seconds).alias("window_start")).agg(F.count("*").alias("requests"))
    each = F.explode(F.array(F.struct(F.col(by).alias("k")), F.struct(F.lit(None).cast(df.schema[by].dataType).alias("k"))))
    both = counts.select(each.alias("_s"), "window_start", "requests").groupBy(F.col("_s.k").alias(by), "window_start").agg(
        F.sum("requests").alias("requests"))
    return both.withColumn("per_second", F.col("requests") / F.lit(float(seconds)))


def stage_latency(df: DataFrame, stage: str = "stage", value: str = "latency_ms") -> DataFrame:
    """Median, 95th and 99th percentile time per stage, exact."""
    return exact_percentiles(df, [stage], value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def staleness(df: DataFrame, as_of, key: str = "user_id", ts: str = "timestamp") -> DataFrame:
    """Seconds since the last update of every key."""
    at = F.unix_micros(F.lit(as_of).cast("timestamp"))
    return df.groupBy(key).agg(F.max(ts).alias("updated_at")).withColumn(
        "staleness_seconds", (at - micros("updated_at")) / F.lit(float(_US)))


@dataclass(frozen=True)
class RetrainRule:
    """Thresholds of the retrain decision. Fixed values of the contract."""

    new_events: int = 10_000
    drift_score: float = 0.3
    max_hours: float = 48.0


def retrain_decision(stats: DataFrame, rule: RetrainRule = RetrainRule()) -> DataFrame:
    """Whether to retrain and why; the first condition that holds gives the reason.

    ``stats``: new_events, drift_score, hours_since and any key columns.
    """
    events = F.col("new_events") >= rule.new_events
    drifted = F.col("drift_score") >= rule.drift_score
    late = F.col("hours_since") >= rule.max_hours
    reason = F.when(events, "events").when(drifted, "drift").when(late, "hours").otherwise("Conditions not met")
    return stats.withColumn("retrain", events | drifted | late).withColumn("reason", reason)


def advance_retrain_state(state: DataFrame, batch: DataFrame, rule: RetrainRule = RetrainRule()) -> DataFrame:
    """Carry the trigger's state over one batch: count events, decide, and reset count and clock after firing.

    ``state``: model, events_since, last_retrain. ``batch``: model, events, drift_score, at.
    """
    joined = state.join(batch, "model", "left")
    stats = joined.select(
        "model", "last_retrain", "at",
        (F.col("events_since") + F.coalesce("events", F.lit(0))).alias("new_events"),
        F.coalesce("drift_score", F.lit(0.0)).alias("drift_score"),
        (F.coalesce((micros("at") - micros("last_retrain")), F.lit(0)) / F.lit(3600.0 * _US)).alias("hours_since"))
    decided = retrain_decision(stats, rule)
    return decided.select(
        "model", F.when(F.col("retrain"), F.lit(0)).otherwise(F.col("new_events")).cast("bigint").alias("events_since"),
        F.when(F.col("retrain"), F.col("at")).otherwise(F.col("last_retrain")).alias("last_retrain"), "retrain", "reason")
