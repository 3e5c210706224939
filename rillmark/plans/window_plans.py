"""Queries over per-row history."""

from pyspark.sql import functions as F

from rillmark.functions.columns import jaccard
from rillmark.operators import windows as wn
from rillmark.plans.event_plans import valid_events
from rillmark.plans.registry import query, with_views
from rillmark.sources.adapters import item_categories, raw_events


@query("latest_interaction", with_views("ev", """
    SELECT user_id, item_id, event_id, event_type, ts AS "timestamp" FROM ev
    QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) = 1"""))
def latest_interaction(spark, root):
    return wn.latest_per_key(valid_events(spark, root), ["user_id", "item_id"]).select(
        "user_id", "item_id", "event_id", "event_type", "timestamp")


@query("user_history", with_views("ev", """
    SELECT user_id, event_id, item_id, event_type,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS position
    FROM ev QUALIFY position <= 20"""))
def user_history(spark, root):
    return wn.user_history(valid_events(spark, root), 20).select(
        "user_id", "event_id", "item_id", "event_type", F.col("position").cast("bigint").alias("position"))


@query("popularity_percentile", with_views("ev", """
    WITH c AS (SELECT item_id, count(*) AS popularity FROM ev GROUP BY 1)
    SELECT item_id, popularity, round(percent_rank() OVER (ORDER BY popularity), 6) AS popularity_percentile FROM c"""))
def popularity_percentile(spark, root):
    return wn.popularity_percentile(valid_events(spark, root)).withColumn(
        "popularity_percentile", F.round("popularity_percentile", 6))


@query("rolling_counts", with_views("ev", """
    SELECT event_id, user_id, item_id,
      count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
        AS user_event_count_1h,
      count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
        AS user_event_count_24h,
      count(*) OVER (PARTITION BY item_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)
        AS item_popularity_1h
    FROM ev"""))
def rolling_counts(spark, root):
    return wn.rolling_counts(valid_events(spark, root), {
        "user_id": {"user_event_count_1h": 3600, "user_event_count_24h": 86_400},
        "item_id": {"item_popularity_1h": 3600},
    })


_SEQ_SQL = """
    SELECT event_id, user_id, item_id, row_number() OVER w AS position, lag(item_id) OVER w AS previous_item,
           round((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / CAST(1000000 AS DOUBLE), 6) AS gap_seconds
    FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query("interaction_sequence", with_views("ev", _SEQ_SQL))
def interaction_sequence(spark, root):
    df = wn.interaction_sequence(valid_events(spark, root).select("event_id", "user_id", "item_id", "timestamp"))
    return df.select("event_id", "user_id", "item_id", "position", "previous_item",
                     F.round("gap_seconds", 6).alias("gap_seconds"))


# Category overlap between each interaction's item and the one before it.
@query("item_jaccard", with_views("ev", f"""
    WITH s AS ({_SEQ_SQL}),
    c AS (SELECT 'item_' || p_partkey AS item_id, p_type, p_brand FROM part)
    SELECT s.event_id, s.item_id, s.previous_item,
           round(((a.p_type = b.p_type)::INT + (a.p_brand = b.p_brand)::INT) /
                 CAST(4 - (a.p_type = b.p_type)::INT - (a.p_brand = b.p_brand)::INT AS DOUBLE), 6) AS jaccard
    FROM s JOIN c a ON s.item_id = a.item_id JOIN c b ON s.previous_item = b.item_id"""))
def item_jaccard(spark, root):
    seq = wn.interaction_sequence(valid_events(spark, root).select("event_id", "user_id", "item_id", "timestamp"))
    cats = item_categories(spark, root)
    before = cats.select(F.col("item_id").alias("previous_item"), F.col("categories").alias("_pc"))
    return seq.join(cats, "item_id").join(before, "previous_item").select(
        "event_id", "item_id", "previous_item", F.round(jaccard("categories", "_pc"), 6).alias("jaccard"))


@query("rate_limited", with_views("raw", """
    SELECT event_id, user_id, CAST(floor(epoch_us(ts) / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS window_id,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS request_no,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) > 3 AS rejected
    FROM raw"""))
def rate_limited(spark, root):
    df = raw_events(spark, root).select("event_id", "user_id", "timestamp")
    return wn.rate_limited(df, "user_id", limit=3, window_s=86_400).drop("timestamp")
