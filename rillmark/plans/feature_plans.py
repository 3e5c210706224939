"""Queries over batch features."""

from pyspark.sql import functions as F

from rillmark.operators import features as ft
from rillmark.operators import sketches as sk
from rillmark.plans.event_plans import AS_OF, order_interactions, valid_events
from rillmark.plans.registry import query, with_views
from rillmark.sources.adapters import raw_events
from rillmark.streaming.flows import checked_stream


def _r(*names):
    return [F.round(n, 6).alias(n) for n in names]


_USER_SQL = """
    WITH c AS (SELECT user_id, category, count(*) AS n FROM {v} GROUP BY 1, 2),
    t AS (SELECT user_id, category, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) AS rn FROM c),
    f AS (SELECT user_id, string_agg(category, ',' ORDER BY rn) AS favorite_categories FROM t WHERE rn <= 3 GROUP BY 1),
    u AS (SELECT user_id, count(*) AS total_interactions, count(*) FILTER (event_type = 'click') AS total_clicks,
                 count(*) FILTER (event_type = 'view') AS total_views,
                 count(*) FILTER (event_type = 'rating') AS total_ratings,
                 round(avg(rating), 6) AS avg_rating_given, count(DISTINCT CAST(ts AS DATE)) AS interaction_days,
                 max(ts) AS last_active_timestamp
          FROM {v} GROUP BY 1)
    SELECT u.*, f.favorite_categories FROM u LEFT JOIN f USING (user_id)"""


def _user_out(df):
    return df.select(
        "user_id", "total_interactions", "total_clicks", "total_views", "total_ratings", *_r("avg_rating_given"),
        "interaction_days", "last_active_timestamp",
        F.array_join("favorite_categories", ",").alias("favorite_categories"),
    )


@query("user_features", with_views("ev", _USER_SQL.format(v="ev")))
def user_features(spark, root):
    return _user_out(ft.user_features(valid_events(spark, root)))


@query("user_features_orders", with_views("li", _USER_SQL.format(v="li")))
def user_features_orders(spark, root):
    return _user_out(ft.user_features(order_interactions(spark, root)))


@query("favorite_categories", with_views("ev", """
    WITH c AS (SELECT user_id, category, count(*) AS n FROM ev GROUP BY 1, 2),
    t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) AS rn FROM c)
    SELECT user_id, string_agg(category, ',' ORDER BY rn) AS favorite_categories FROM t WHERE rn <= 3 GROUP BY 1"""))
def favorite_categories(spark, root):
    df = ft.favorite_categories(valid_events(spark, root))
    return df.select("user_id", F.array_join("favorite_categories", ",").alias("favorite_categories"))


_ITEM_SQL = """
    WITH c AS (SELECT item_id, category, count(*) AS n FROM {v} GROUP BY 1, 2),
    m AS (SELECT item_id, category FROM c QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY n DESC, category) = 1),
    i AS (SELECT item_id, count(*) FILTER (event_type = 'view') AS total_views,
                 count(*) FILTER (event_type = 'click') AS total_clicks, round(avg(rating), 6) AS avg_rating_received,
                 count(rating) AS rating_count, min(ts) AS created_timestamp
          FROM {v} GROUP BY 1)
    SELECT i.item_id, total_views, total_clicks,
           round(CASE WHEN total_views > 0 THEN CAST(total_clicks AS DOUBLE) / total_views ELSE 0.0 END, 6)
             AS click_through_rate,
           avg_rating_received, rating_count, m.category, created_timestamp
    FROM i JOIN m USING (item_id)"""


def _item_out(df):
    return df.select("item_id", "total_views", "total_clicks", *_r("click_through_rate", "avg_rating_received"),
                     "rating_count", "category", "created_timestamp")


@query("item_features", with_views("ev", _ITEM_SQL.format(v="ev")))
def item_features(spark, root):
    return _item_out(ft.item_features(valid_events(spark, root)))


@query("item_features_orders", with_views("li", _ITEM_SQL.format(v="li")))
def item_features_orders(spark, root):
    return _item_out(ft.item_features(order_interactions(spark, root)))


_PAIR_SQL = """
    WITH o AS (SELECT *, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS sig FROM {v}),
    l AS (SELECT user_id, item_id, event_type, ts FROM o
          QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, sig DESC) = 1),
    p AS (SELECT user_id, item_id, count(*) AS interaction_count, round(avg(rating), 6) AS user_item_rating
          FROM o GROUP BY 1, 2)
    SELECT p.*, l.event_type AS last_interaction_type,
           round((epoch_us(TIMESTAMP '{at}') - epoch_us(l.ts)) / CAST(3600000000 AS DOUBLE), 6)
             AS time_since_last_interaction
    FROM p JOIN l USING (user_id, item_id)"""


def _pair_out(df):
    return df.select("user_id", "item_id", "interaction_count", "last_interaction_type",
                     *_r("time_since_last_interaction", "user_item_rating"))


@query("pair_features", with_views("ev", _PAIR_SQL.format(v="ev", at=AS_OF)))
def pair_features(spark, root):
    return _pair_out(ft.pair_features(valid_events(spark, root), AS_OF))


@query("pair_features_orders", with_views("li", _PAIR_SQL.format(v="li", at=AS_OF)))
def pair_features_orders(spark, root):
    return _pair_out(ft.pair_features(order_interactions(spark, root), AS_OF))


@query("hourly_pair_features", with_views("ev", """
    SELECT user_id, item_id, count(*) AS interaction_count_1h, max(ts) AS last_event_time,
           round(avg(rating), 6) AS avg_rating, date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
    FROM ev GROUP BY user_id, item_id, date_trunc('hour', ts)"""))
def hourly_pair_features(spark, root):
    return ft.hourly_pairs(valid_events(spark, root)).select(
        "user_id", "item_id", "interaction_count_1h", "last_event_time", *_r("avg_rating"), "window_start", "window_end")


@query("rollup_hourly", with_views("ev", """
    WITH i AS (SELECT item_id, count(*) AS total_item_interactions FROM ev GROUP BY 1)
    SELECT user_id, item_id, count(*) AS total_user_interactions, max(ts) AS last_interaction_time,
           round(avg(rating), 6) AS avg_rating, any_value(total_item_interactions) AS total_item_interactions
    FROM ev JOIN i USING (item_id) GROUP BY 1, 2"""))
def rollup_hourly(spark, root):
    df = ft.rollup_hourly(ft.hourly_pairs(valid_events(spark, root)))
    return df.select("user_id", "item_id", "total_user_interactions", "last_interaction_time", *_r("avg_rating"),
                     "total_item_interactions")


@query("user_sliding_24h", with_views("ev", """
    WITH w AS (SELECT user_id, ts, rating, date_trunc('hour', ts) - CAST(h || ' hours' AS INTERVAL) AS window_start
               FROM ev, range(24) t(h))
    SELECT user_id, count(*) AS event_count, round(avg(rating), 6) AS avg_rating, max(ts) AS last_event_time,
           window_start, window_start + INTERVAL 24 HOURS AS window_end
    FROM w GROUP BY user_id, window_start"""))
def user_sliding_24h(spark, root):
    return ft.user_sliding(valid_events(spark, root)).select(
        "user_id", "event_count", *_r("avg_rating"), "last_event_time", "window_start", "window_end")


@query("item_hourly", with_views("ev", """
    SELECT item_id, count(*) AS item_popularity_1h, date_trunc('hour', ts) AS window_start,
           date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
    FROM ev GROUP BY item_id, date_trunc('hour', ts)"""))
def item_hourly(spark, root):
    return ft.item_hourly(valid_events(spark, root))


@query("item_popularity", with_views("ev", "SELECT item_id, count(*) AS popularity FROM ev GROUP BY 1"))
def item_popularity(spark, root):
    return ft.item_popularity(valid_events(spark, root))


@query("user_frequency", with_views("ev", """
    SELECT user_id, count(*) AS events, count(DISTINCT CAST(ts AS DATE)) AS active_days,
           round(CAST(count(*) AS DOUBLE) / count(DISTINCT CAST(ts AS DATE)), 6) AS events_per_day
    FROM ev GROUP BY 1"""))
def user_frequency(spark, root):
    return ft.user_frequency(valid_events(spark, root)).select("user_id", "events", "active_days", *_r("events_per_day"))


@query("daily_summary", with_views("ev", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS events, count(DISTINCT user_id) AS active_users,
           count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
           count(*) FILTER (event_type = 'rating') AS ratings
    FROM ev GROUP BY CAST(ts AS DATE)"""))
def daily_summary(spark, root):
    return ft.daily_summary(valid_events(spark, root)).withColumn("day", F.col("day").cast("string"))


@query("event_report", with_views("ev", """
    WITH n AS (SELECT CAST(count(*) AS DOUBLE) AS r FROM raw),
    k AS (SELECT event_type, CAST(count(*) AS DOUBLE) AS c FROM ev GROUP BY 1)
    SELECT 'received' AS metric, r AS value FROM n
    UNION ALL SELECT 'valid', CAST(count(*) AS DOUBLE) FROM ev
    UNION ALL SELECT 'invalid', CAST(count(*) AS DOUBLE) FROM raw WHERE event_type NOT IN ('view', 'click', 'rating')
    UNION ALL SELECT 'unique_user_id', CAST(count(DISTINCT user_id) AS DOUBLE) FROM ev
    UNION ALL SELECT 'unique_item_id', CAST(count(DISTINCT item_id) AS DOUBLE) FROM ev
    UNION ALL SELECT 'count_' || event_type, c FROM k
    UNION ALL SELECT 'share_' || event_type, round(c * 100.0 / r, 6) FROM k, n"""))
def event_report(spark, root):
    return ft.event_report(checked_stream(raw_events(spark, root))).select("metric", *_r("value"))


# The report of every day from parts that merge: one part per day and type of day's half, as batches would bring them.
@query("daily_event_report", with_views("ev", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS received,
           count(*) FILTER (event_type IN ('view', 'click', 'rating')) AS valid,
           count(*) FILTER (event_type NOT IN ('view', 'click', 'rating')) AS invalid,
           count(*) FILTER (event_type = 'view') AS "view", count(*) FILTER (event_type = 'click') AS click,
           count(*) FILTER (event_type = 'rating') AS rating,
           count(DISTINCT CASE WHEN event_type IN ('view', 'click', 'rating') THEN user_id END) AS unique_users,
           count(DISTINCT CASE WHEN event_type IN ('view', 'click', 'rating') THEN item_id END) AS unique_items,
           round(100.0 * count(*) FILTER (event_type = 'view') / count(*), 6) AS share_view,
           round(100.0 * count(*) FILTER (event_type = 'click') / count(*), 6) AS share_click,
           round(100.0 * count(*) FILTER (event_type = 'rating') / count(*), 6) AS share_rating
    FROM raw GROUP BY 1"""))
def daily_event_report(spark, root):
    rows = checked_stream(raw_events(spark, root)).withColumns({
        "day": F.to_date("timestamp").cast("string"), "half": F.hour("timestamp") < 12})
    parts = sk.report_parts(rows, ["day", "half"])
    out = sk.report_of(parts, ["day"])
    return out.select(*[F.round(c, 6).alias(c) if c.startswith("share") else F.col(c) for c in out.columns])


def _state_sql(key):
    return with_views("ev", f"""
        SELECT {key}, count(*) AS interaction_count, round(avg(coalesce(rating, 3.0)), 6) AS running_avg_rating,
               count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
               round(CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN
                 CAST(count(*) FILTER (event_type = 'click') AS DOUBLE) / count(*) FILTER (event_type = 'view')
                 ELSE 0.0 END, 6) AS click_through_rate, max(ts) AS last_active_timestamp
        FROM ev GROUP BY 1""")


def _merged(spark, root, key):
    df = valid_events(spark, root)
    split = F.lit("2024-01-16").cast("timestamp")
    old = ft.entity_state(df.where(F.col("timestamp") < split), key, 3.0)
    merged = ft.merge_state(old, df.where(F.col("timestamp") >= split), key, 3.0)
    return ft.state_view(merged, key).select(
        key, "interaction_count", *_r("running_avg_rating"), "views", "clicks", *_r("click_through_rate"),
        "last_active_timestamp")


@query("merge_user_state", _state_sql("user_id"))
def merge_user_state(spark, root):
    return _merged(spark, root, "user_id")


@query("merge_item_state", _state_sql("item_id"))
def merge_item_state(spark, root):
    return _merged(spark, root, "item_id")
