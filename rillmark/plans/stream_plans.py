"""Streaming queries run over the event log as a finite stream; their stored result is returned."""

from pyspark.sql import functions as F

from rillmark.operators import driftcounts as dc
from rillmark.operators import sketches as sk
from rillmark.operators.events import validate_events
from rillmark.operators.monitor import window_start
from rillmark.plans.event_plans import served_records
from rillmark.plans.registry import ORACLES, query, with_views
from rillmark.session import checkpointed, scratch_dir
from rillmark.sources import adapters
from rillmark.sources.snapshots import read_batches
from rillmark.sources.store import is_directory
from rillmark.streaming import flows, sinks
from rillmark.streaming.activity import activity_stream, state_session, stream_session
from rillmark.streaming.progress import lag_alerts as alerts
from rillmark.streaming.progress import lag_by_window


class _StreamReads:
    """Lets the adapters read the same tables as streams."""

    def __init__(self, spark):
        self.spark = spark
        self.read = self

    def parquet(self, path):
        reader = self.spark.readStream.schema(self.spark.read.parquet(path).schema)
        if is_directory(self.spark, path):
            return reader.parquet(path)
        # A file stream reads folders: take the one file's folder and its name.
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)


def event_stream(spark, root):
    return adapters.raw_events(_StreamReads(spark), root)


def valid_stream(spark, root):
    return validate_events(event_stream(spark, root))[0]


def _finish(start, spark, name, build, session=stream_session, **kwargs):
    """Run a finite stream, built in a session of its own, to its end and return the folder of its result."""
    path, checkpoint = scratch_dir(spark, name), scratch_dir(spark, f"{name}-checkpoint")
    start(build(session(spark)), path, checkpoint, once=True, **kwargs).awaitTermination()
    return path


@query("stream_hourly_pairs", ORACLES["hourly_pair_features"])
def stream_hourly_pairs(spark, root):
    path = _finish(sinks.start_feature_query, spark, "hourly", lambda s: flows.hourly_pair_stream(valid_stream(s, root)))
    return sinks.read_latest(spark, path, ["user_id", "item_id", "window_start"]).select(
        "user_id", "item_id", "interaction_count_1h", "last_event_time", F.round("avg_rating", 6).alias("avg_rating"),
        "window_start", "window_end")


@query("stream_user_sliding_24h", ORACLES["user_sliding_24h"])
def stream_user_sliding_24h(spark, root):
    path = _finish(sinks.start_feature_query, spark, "sliding", lambda s: flows.sliding_user_stream(valid_stream(s, root)))
    return read_batches(spark, path, flows.sliding_windows()).withColumn("avg_rating", F.round("avg_rating", 6))


@query("stream_item_hourly", ORACLES["item_hourly"])
def stream_item_hourly(spark, root):
    path = _finish(sinks.start_feature_query, spark, "item-hourly", lambda s: flows.item_hourly_stream(valid_stream(s, root)))
    return sinks.read_latest(spark, path, ["item_id", "window_start"])


@query("stream_user_state", with_views("ev", """
    SELECT user_id, count(*) AS interaction_count, round(avg(rating), 6) AS running_avg_rating,
           count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
           max(ts) AS last_active_timestamp FROM ev GROUP BY 1"""))
def stream_user_state(spark, root):
    path = _finish(sinks.start_feature_query, spark, "user-state",
                   lambda s: flows.running_state_stream(valid_stream(s, root), "user_id"))
    df = sinks.read_latest(spark, path, ["user_id"])
    mean = F.round(F.col("rating_sum") / F.nullif(F.col("rating_n"), F.lit(0)), 6)
    return df.select("user_id", "interaction_count", mean.alias("running_avg_rating"), "views", "clicks",
                     "last_active_timestamp")


# Every event arrives twice, the second time five minutes later.
@query("stream_dedup", with_views("raw", """
    SELECT event_id, user_id, item_id, event_type FROM raw"""))
def stream_dedup(spark, root):
    def twice(session):
        first = event_stream(session, root)
        again = event_stream(session, root).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 5 MINUTES"))
        return flows.dedup_stream(first.unionByName(again))

    path = _finish(sinks.start_feature_query, spark, "dedup", twice, mode="append")
    return spark.read.parquet(path).select("event_id", "user_id", "item_id", "event_type")


@query("stream_dead_letters", with_views("raw", """
    SELECT event_id, user_id, event_type, event_type IN ('view', 'click', 'rating') AS valid,
           CASE WHEN event_type IN ('view', 'click', 'rating') THEN '' ELSE 'event_type_unknown' END AS reasons FROM raw"""))
def stream_dead_letters(spark, root):
    path = _finish(sinks.start_ingest, spark, "ingest", lambda s: flows.checked_stream(event_stream(s, root)))
    return spark.read.parquet(path).select(
        "event_id", "user_id", "event_type", F.col("valid").cast("boolean").alias("valid"), F.array_join("reasons", ",").alias("reasons"))


@query("stream_served_clicks", with_views("ev", """
    WITH s AS (SELECT CAST(event_id AS VARCHAR) AS event_id, 'user_' || user_id AS user_id,
                 'item_' || ((CAST(json_extract_string(props, '$.k') AS BIGINT) + j) % 100) AS item_id,
                 date_trunc('second', ts) AS ts
               FROM events, range(5) t(j) WHERE event_type IN ('view', 'signup'))
    SELECT s.event_id, s.user_id, s.item_id, c.ts AS clicked_at
    FROM s JOIN ev c ON c.event_type = 'click' AND c.user_id = s.user_id AND c.item_id = s.item_id
         AND c.ts >= s.ts AND c.ts <= s.ts + INTERVAL 24 HOURS"""))
def stream_served_clicks(spark, root):
    def both(session):
        served = served_records(_StreamReads(session), root).select(
            "event_id", "user_id", F.explode("recommended_items").alias("item_id"),
            F.try_to_timestamp("timestamp").alias("timestamp"))
        return flows.served_clicks_stream(served, valid_stream(session, root).where("event_type = 'click'"))

    path = _finish(sinks.start_feature_query, spark, "served-clicks", both, mode="append")
    return spark.read.parquet(path).select("event_id", "user_id", "item_id", "clicked_at")


# Spells of activity: a gap of more than a day between two events of a user ends one; the watermark stands ten minutes behind.
@query("stream_user_activity", with_views("ev", """
    WITH g AS (SELECT *, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 24 HOURS THEN 1 ELSE 0 END AS cut FROM ev),
    s AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS spell_start, count(*) AS event_count, round(avg(rating), 6) AS avg_rating,
           count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
           max(ts) AS last_active_timestamp,
           max(ts) + INTERVAL 24 HOURS < (SELECT max(ts) FROM ev) - INTERVAL 10 MINUTES AS inactive
    FROM s GROUP BY user_id, k"""))
def stream_user_activity(spark, root):
    path = _finish(sinks.start_feature_query, spark, "user-activity", lambda s: activity_stream(valid_stream(s, root)), state_session)
    mean = F.round(F.col("rating_sum") / F.nullif(F.col("rating_n"), F.lit(0)), 6)
    return sinks.read_latest(spark, path, ["user_id", "spell_start"]).select(
        "user_id", "spell_start", "event_count", mean.alias("avg_rating"), "views", "clicks", "last_active_timestamp", "inactive")


@query("stream_event_report", ORACLES["daily_event_report"])
def stream_event_report(spark, root):
    path = _finish(sinks.start_report, spark, "report", lambda s: flows.checked_stream(event_stream(s, root)))
    out = sk.report_of(read_batches(spark, path, sinks.merged_report), ["day"])
    return out.select(*[F.round(c, 6).alias(c) if c.startswith("share") else F.col(c) for c in out.columns])


# The reference is the first half of the log, the stream the second; the index over all batches comes from their counts.
@query("stream_drift", with_views("raw", """
    WITH v AS (SELECT ts < TIMESTAMP '2024-01-16' AS old, unnest(['value', 'hour']) AS column_name,
                      unnest([value, CAST(hour(ts) AS DOUBLE)]) AS value FROM events),
    e AS (SELECT column_name, list(quantile_cont) AS edges FROM (
            SELECT column_name, unnest(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS quantile_cont FROM v WHERE old GROUP BY 1)
          GROUP BY 1),
    b AS (SELECT column_name, len(list_filter(edges, lambda x: x < value)) AS bin, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c
          FROM v JOIN e USING (column_name) GROUP BY 1, 2),
    s AS (SELECT column_name, greatest(r / CAST(sum(r) OVER w AS DOUBLE), 1e-6) AS rs, greatest(c / CAST(sum(c) OVER w AS DOUBLE), 1e-6) AS cs
          FROM b WINDOW w AS (PARTITION BY column_name))
    SELECT column_name, round(sum((cs - rs) * ln(cs / rs)), 6) AS psi, sum((cs - rs) * ln(cs / rs)) >= 0.2 AS drifted,
           (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16') AS rows_cur FROM s GROUP BY 1"""))
def stream_drift(spark, root):
    half = F.lit("2024-01-16").cast("timestamp")

    def numbers(source):
        return adapters.table(source, root, "events").select(
            F.col("ts").cast("timestamp").alias("timestamp"), "value", F.hour("ts").cast("double").alias("hour"))

    reference = checkpointed(dc.drift_reference(numbers(spark).where(F.col("timestamp") < half), ["value", "hour"]), "drift-reference")
    monitor = sinks.DriftMonitor(reference, ("value", "hour"), scratch_dir(spark, "drift-counts"), 1 << 40)
    _finish(sinks.start_drift, spark, "drift", lambda s: numbers(_StreamReads(s)).where(F.col("timestamp") >= half), monitor=monitor)
    return monitor.index(spark, 1 << 30).select("column_name", F.round("psi", 6).alias("psi"), "drifted", "rows_cur")


# A consumer's lag stands in by the running surplus of a topic's arrivals over a fixed capacity an hour.
@query("lag_alerts", """
    WITH a AS (SELECT event_type AS "query", date_trunc('hour', ts) AS w, sum(value) AS v FROM events GROUP BY 1, 2),
    h AS (SELECT "query", w, CAST(floor(v) AS BIGINT) AS behind FROM a),
    i AS (SELECT *, epoch_us(w) // 3600000000 - row_number() OVER (PARTITION BY "query" ORDER BY w) AS g FROM h
          WHERE behind > (SELECT CAST(floor(avg(behind)) AS BIGINT) FROM h))
    SELECT "query" AS series, min(w) AS started, max(w) AS last_window, count(*) AS windows FROM i GROUP BY "query", g HAVING count(*) >= 3""")
def lag_alerts(spark, root):
    events = adapters.table(spark, root, "events").select("event_type", "value", F.col("ts").cast("timestamp").alias("timestamp"))
    hourly = events.groupBy("event_type", window_start("timestamp", 3600).alias("timestamp")).agg(
        F.floor(F.sum("value")).cast("bigint").alias("offsets_behind"))
    lag = checkpointed(lag_by_window(hourly.withColumnRenamed("event_type", "query"), 3600), "lag")
    limit = lag.groupBy().agg(F.floor(F.avg("offsets_behind")).cast("bigint")).scalar()
    return alerts(lag, limit, 180, 3600)
