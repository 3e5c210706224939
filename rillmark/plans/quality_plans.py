"""Queries over data quality, drift and service metrics."""

from pyspark.sql import functions as F

from rillmark.operators import monitor as mo
from rillmark.operators import quality as dq
from rillmark.operators import windows as wn
from rillmark.operators.scale import exact_percentiles
from rillmark.plans.event_plans import AS_OF
from rillmark.plans.registry import VIEWS, query, with_views
from rillmark.sources.adapters import raw_events, table

# Service metrics from the event log: one request per event.
VIEWS["http"] = """
    SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS latency_ms,
           'svc_' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 5) AS service,
           '/e/' || json_extract_string(props, '$.k') AS endpoint,
           CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 ELSE 200 END AS status,
           CASE event_type WHEN 'view' THEN 'candidates' WHEN 'click' THEN 'ranking' ELSE 'reranking' END AS stage,
           event_type
    FROM events"""


def http(spark, root):
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    return table(spark, root, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), k.alias("k"), F.col("value").alias("latency_ms"),
        F.concat(F.lit("svc_"), (k % 5).cast("string")).alias("service"),
        F.concat(F.lit("/e/"), k.cast("string")).alias("endpoint"),
        F.when(kind == "error", 500).when(kind == "signup", 201).otherwise(200).alias("status"),
        F.when(kind == "view", "candidates").when(kind == "click", "ranking").otherwise("reranking").alias("stage"),
        "event_type",
    )


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("dq_nulls", with_views("raw", """
    SELECT 'event_id' AS column_name, count(*) FILTER (event_id IS NULL) AS nulls FROM raw
    UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL) FROM raw
    UNION ALL SELECT 'item_id', count(*) FILTER (item_id IS NULL) FROM raw
    UNION ALL SELECT 'rating', count(*) FILTER (rating IS NULL) FROM raw"""))
def dq_nulls(spark, root):
    return dq.check_nulls(raw_events(spark, root), ["event_id", "user_id", "item_id", "rating"])


@query("dq_duplicates", """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_duplicates(spark, root):
    return dq.duplicate_keys(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_time_range", """
    SELECT min(ts) AS first, max(ts) AS last, count(*) FILTER (ts > TIMESTAMP '2024-01-25') AS in_future FROM events""")
def dq_time_range(spark, root):
    return dq.check_time_range(table(spark, root, "events"), "ts", "2024-01-25 00:00:00")


@query("dq_report", """
    WITH d AS (SELECT coalesce(sum(c - 1), 0) AS s FROM (SELECT count(*) AS c FROM lineitem
               GROUP BY l_orderkey, l_linenumber) WHERE c > 1),
    r AS (
      SELECT 1 AS step, 'nulls:l_orderkey' AS check_name, count(*) FILTER (l_orderkey IS NULL) AS failures FROM lineitem
      UNION ALL SELECT 2, 'nulls:l_shipdate', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
      UNION ALL SELECT 3, 'row_count', greatest(100 - count(*), 0) FROM lineitem
      UNION ALL SELECT 4, 'duplicates', s FROM d
      UNION ALL SELECT 5, 'future_time', count(*) FILTER (l_shipdate > TIMESTAMP '2001-01-01') FROM lineitem)
    SELECT step, check_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed,
           coalesce(step = min(CASE WHEN failures > 0 THEN step END) OVER (), false) AS first_failure FROM r""")
def dq_report(spark, root):
    return dq.dq_report(table(spark, root, "lineitem"), ["l_orderkey", "l_shipdate"], 100,
                        ["l_orderkey", "l_linenumber"], "l_shipdate", "2001-01-01 00:00:00")


_PROFILED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus", "l_shipdate"]


@query("column_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS missing,
           count(DISTINCT {c}) AS distinct_values, (count(*) - count({c})) / CAST(count(*) AS DOUBLE) AS missing_share,
           count(DISTINCT {c}) <= 1 AS constant FROM lineitem""" for c in _PROFILED))
def column_profile(spark, root):
    return dq.column_profile(table(spark, root, "lineitem"))


@query("duplicate_rows", """
    SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus FROM (
      SELECT count(*) AS c FROM lineitem GROUP BY """ + ", ".join(_PROFILED) + ") WHERE c > 1")
def duplicate_rows(spark, root):
    return dq.duplicate_rows(table(spark, root, "lineitem"))


# Reference: orders shipped before 2000; current: the rest.
_SHIP = "2000-01-01"


def _halves(df, ts):
    at = F.lit(_SHIP).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) < at), df.where(F.col(ts) >= at)


def lines(spark, root):
    return table(spark, root, "lineitem")


_DRIFT_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_DRIFT = f"""
    WITH l AS (SELECT l_shipdate < TIMESTAMP '{_SHIP}' AS old, unnest({_DRIFT_COLS}) AS column_name,
                      unnest([{', '.join(_DRIFT_COLS)}]) AS value FROM lineitem),
    e AS (SELECT column_name, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM l WHERE old
          GROUP BY 1),
    b AS (SELECT l.column_name, old, len(list_filter(q, lambda x: x < value)) AS bin FROM l JOIN e
          ON l.column_name = e.column_name),
    g AS (SELECT column_name, bin, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c FROM b GROUP BY 1, 2),
    s AS (SELECT column_name, bin, r / CAST(sum(r) OVER w AS DOUBLE) AS rs, c / CAST(sum(c) OVER w AS DOUBLE) AS cs
          FROM g WINDOW w AS (PARTITION BY column_name)),
    f AS (SELECT column_name, greatest(rs, 1e-6) AS rs, greatest(cs, 1e-6) AS cs,
                 abs(sum(rs) OVER o - sum(cs) OVER o) AS gap FROM s
          WINDOW o AS (PARTITION BY column_name ORDER BY bin))"""


@query("drift_psi", _DRIFT + """
    SELECT column_name, round(sum((cs - rs) * ln(cs / rs)), 6) AS psi, sum((cs - rs) * ln(cs / rs)) >= 0.2 AS drifted
    FROM f GROUP BY 1""")
def drift_psi(spark, root):
    ref, cur = _halves(lines(spark, root), "l_shipdate")
    return _round(dq.drift(ref, cur, _DRIFT_COLS).select("column_name", "psi", "drifted"), "psi")


@query("drift_ks", f"""
    WITH l AS (SELECT l_shipdate < TIMESTAMP '{_SHIP}' AS old, unnest({_DRIFT_COLS}) AS column_name,
                      unnest([{', '.join(_DRIFT_COLS)}]) AS value FROM lineitem),
    v AS (SELECT column_name, value, count(*) FILTER (old) AS r, count(*) FILTER (NOT old) AS c FROM l GROUP BY 1, 2),
    g AS (SELECT column_name, abs(sum(r) OVER o / CAST(sum(r) OVER w AS DOUBLE) - sum(c) OVER o / CAST(sum(c) OVER w AS DOUBLE)) AS gap
          FROM v WINDOW w AS (PARTITION BY column_name), o AS (PARTITION BY column_name ORDER BY value))
    SELECT column_name, round(max(gap), 6) AS ks FROM g GROUP BY 1""")
def drift_ks(spark, root):
    ref, cur = _halves(lines(spark, root), "l_shipdate")
    return _round(dq.drift(ref, cur, _DRIFT_COLS).select("column_name", "ks"), "ks")


@query("dataset_drift", _DRIFT + """
    , p AS (SELECT column_name, sum((cs - rs) * ln(cs / rs)) >= 0.2 AS d FROM f GROUP BY 1)
    SELECT count(*) FILTER (d) AS drifted_columns, count(*) AS columns,
           round(count(*) FILTER (d) / CAST(count(*) AS DOUBLE), 6) AS drift_share,
           count(*) FILTER (d) / CAST(count(*) AS DOUBLE) >= 0.5 AS dataset_drift FROM p""")
def dataset_drift(spark, root):
    ref, cur = _halves(lines(spark, root), "l_shipdate")
    return _round(dq.dataset_drift(dq.drift(ref, cur, _DRIFT_COLS)), "drift_share")


@query("target_drift", """
    WITH g AS (SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS r,
                      count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS c FROM events GROUP BY 1),
    s AS (SELECT greatest(r / CAST((SELECT sum(r) FROM g) AS DOUBLE), 1e-6) AS rs,
                 greatest(c / CAST((SELECT sum(c) FROM g) AS DOUBLE), 1e-6) AS cs FROM g)
    SELECT 'event_type' AS column_name, round(sum((cs - rs) * ln(cs / rs)), 9) AS psi,
           sum((cs - rs) * ln(cs / rs)) >= 0.1 AS drifted FROM s""")
def target_drift(spark, root):
    df = table(spark, root, "events")
    at = F.lit("2024-01-16").cast("timestamp_ntz")
    out = dq.target_drift(df.where(F.col("ts") < at), df.where(F.col("ts") >= at), "event_type")
    return out.withColumn("psi", F.round("psi", 9))


# Scores of two model versions: the price of a line, and the price after discount and tax.
@query("prediction_drift", """
    WITH e AS (SELECT quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM lineitem),
    b AS (SELECT len(list_filter(q, lambda x: x < l_extendedprice)) AS rb,
                 len(list_filter(q, lambda x: x < l_extendedprice * (1 - l_discount) * (1 + l_tax))) AS cb FROM lineitem, e),
    r AS (SELECT rb AS bin, count(*) AS r FROM b GROUP BY 1), c AS (SELECT cb AS bin, count(*) AS c FROM b GROUP BY 1),
    g AS (SELECT coalesce(r.bin, c.bin) AS bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM r FULL JOIN c ON r.bin = c.bin),
    s AS (SELECT bin, r / CAST(sum(r) OVER () AS DOUBLE) AS rs, c / CAST(sum(c) OVER () AS DOUBLE) AS cs FROM g),
    f AS (SELECT greatest(rs, 1e-6) AS rs, greatest(cs, 1e-6) AS cs FROM s),
    v AS (SELECT l_extendedprice AS x, 1 AS o FROM lineitem
          UNION ALL SELECT l_extendedprice * (1 - l_discount) * (1 + l_tax), 0 FROM lineitem),
    k AS (SELECT max(abs(a - b)) AS ks FROM (
            SELECT sum(sum(o)) OVER (ORDER BY x) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS a,
                   sum(sum(1 - o)) OVER (ORDER BY x) / CAST((SELECT count(*) FROM lineitem) AS DOUBLE) AS b FROM v GROUP BY x))
    SELECT 'score' AS column_name, round(sum((cs - rs) * ln(cs / rs)), 6) AS psi, (SELECT round(ks, 6) FROM k) AS ks,
           sum((cs - rs) * ln(cs / rs)) >= 0.2 AS drifted FROM f""")
def prediction_drift(spark, root):
    lines = table(spark, root, "lineitem")
    old = lines.select(F.col("l_extendedprice").alias("score"))
    new = lines.select((F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("score"))
    return _round(dq.drift(old, new, ["score"]).select("column_name", "psi", "ks", "drifted"), "psi", "ks")


@query("stage_latency", with_views("http", """
    SELECT stage, count(*) AS n, round(quantile_cont(latency_ms, 0.5), 6) AS p50,
           round(quantile_cont(latency_ms, 0.95), 6) AS p95, round(quantile_cont(latency_ms, 0.99), 6) AS p99
    FROM http GROUP BY 1"""))
def stage_latency(spark, root):
    return _round(mo.stage_latency(http(spark, root)), "p50", "p95", "p99")


@query("price_percentiles", """
    SELECT count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
           round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem""")
def price_percentiles(spark, root):
    df = exact_percentiles(table(spark, root, "lineitem"), [], "l_extendedprice", {"p50": 0.5, "p95": 0.95})
    return _round(df, "p50", "p95")


# The event number, wrapped at 1000, is a counter that is reset now and then.
@query("counter_rate", with_views("http", """
    WITH c AS (SELECT service AS series, ts, event_id % 1000 AS v FROM http),
    d AS (SELECT series, ts, v, lag(v) OVER (PARTITION BY series ORDER BY ts, v) AS p FROM c),
    i AS (SELECT series, to_timestamp(floor(epoch_us(ts) / CAST(300000000 AS DOUBLE)) * 300)::TIMESTAMP AS window_start,
                 CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END AS d FROM d)
    SELECT series, window_start, round(sum(d) / CAST(300 AS DOUBLE), 6) AS rate FROM i GROUP BY 1, 2"""))
def counter_rate(spark, root):
    df = http(spark, root).select(F.col("service").alias("series"), "timestamp", (F.col("event_id") % 1000).alias("value"))
    return _round(mo.counter_rate(df, 300), "rate")


BOUNDS = [5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0]


@query("histogram_quantile", with_views("http", f"""
    WITH b AS (SELECT i, CAST({BOUNDS}[i] AS DOUBLE) AS le, CAST(CASE WHEN i = 1 THEN 0 ELSE {BOUNDS}[i - 1] END AS DOUBLE) AS lower
               FROM range(1, 9) x(i)),
    c AS (SELECT service, i, le, lower, count(*) FILTER (le IS NULL OR latency_ms <= le) AS cum,
                 count(*) FILTER (latency_ms <= lower AND i > 1) AS prev, count(*) AS total
          FROM http, b GROUP BY 1, 2, 3, 4),
    h AS (SELECT * FROM c WHERE cum >= 0.95 * total
          QUALIFY row_number() OVER (PARTITION BY service ORDER BY i) = 1)
    SELECT service, round(CASE WHEN le IS NULL THEN lower
           ELSE lower + (le - lower) * (0.95 * total - prev) / (cum - prev) END, 6) AS quantile FROM h"""))
def histogram_quantile(spark, root):
    hist = mo.histogram(http(spark, root), "service", "latency_ms", BOUNDS)
    return _round(mo.histogram_quantile(hist, 0.95, "service"), "quantile")


@query("error_ratio", with_views("http", """
    SELECT service, date_trunc('hour', ts) AS window_start, count(*) AS requests,
           count(*) FILTER (status >= 500) AS hits, round(count(*) FILTER (status >= 500) / CAST(count(*) AS DOUBLE), 6) AS ratio
    FROM http GROUP BY 1, 2"""))
def error_ratio(spark, root):
    return _round(mo.error_ratio(http(spark, root), "service", 3600), "ratio")


@query("alert_runs", with_views("http", """
    WITH e AS (SELECT service, date_trunc('hour', ts) AS w, count(*) FILTER (status >= 500) / CAST(count(*) AS DOUBLE) AS r
               FROM http GROUP BY 1, 2),
    h AS (SELECT *, epoch_us(w) // 3600000000 - row_number() OVER (PARTITION BY service ORDER BY w) AS g FROM e WHERE r > 0.25)
    SELECT service AS series, min(w) AS started, max(w) AS last_window, count(*) AS windows
    FROM h GROUP BY service, g HAVING count(*) >= 2"""))
def alert_runs(spark, root):
    ratios = mo.error_ratio(http(spark, root), "service", 3600)
    return wn.alert_runs(ratios, "service", "window_start", F.col("ratio") > 0.25, 3600, 2)


@query("slowest_endpoints", with_views("http", """
    SELECT endpoint, count(*) AS n, round(quantile_cont(latency_ms, 0.95), 6) AS p95 FROM http GROUP BY 1
    ORDER BY quantile_cont(latency_ms, 0.95) DESC, endpoint LIMIT 10"""))
def slowest_endpoints(spark, root):
    return _round(mo.slowest(http(spark, root), 10), "p95")


@query("status_distribution", with_views("http", """
    SELECT status, count(*) AS requests, round(count(*) / CAST((SELECT count(*) FROM http) AS DOUBLE), 6) AS share
    FROM http GROUP BY 1"""))
def status_distribution(spark, root):
    return _round(mo.status_distribution(http(spark, root)), "share")


@query("throughput", with_views("http", """
    WITH c AS (SELECT service, date_trunc('hour', ts) AS window_start FROM http)
    SELECT service, window_start, CAST(count(*) AS BIGINT) AS requests, round(count(*) / CAST(3600 AS DOUBLE), 6) AS per_second
    FROM c GROUP BY GROUPING SETS ((service, window_start), (window_start))"""))
def throughput(spark, root):
    return _round(mo.throughput(http(spark, root)), "per_second")


@query("hit_ratio", with_views("http", """
    SELECT service, date_trunc('day', ts) AS window_start, count(*) AS requests, count(*) FILTER (event_type = 'view') AS hits,
           round(count(*) FILTER (event_type = 'view') / CAST(count(*) AS DOUBLE), 6) AS ratio FROM http GROUP BY 1, 2"""))
def hit_ratio(spark, root):
    return _round(mo.ratio_by_window(http(spark, root), F.col("event_type") == "view", "service", 86_400), "ratio")


@query("embedding_staleness", with_views("raw", f"""
    SELECT user_id, max(ts) AS updated_at, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ts))) / CAST(1000000 AS DOUBLE), 6)
      AS staleness_seconds FROM raw GROUP BY 1"""))
def embedding_staleness(spark, root):
    df = mo.staleness(raw_events(spark, root), AS_OF)
    return _round(df, "staleness_seconds")


# Per day of the log: events, share of errors as drift score, hours since the log began modulo three days.
@query("retrain_decision", """
    WITH s AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS new_events,
                      round(count(*) FILTER (event_type = 'error') / CAST(count(*) AS DOUBLE), 6) AS drift_score,
                      CAST((day(any_value(ts)) % 3) * 24 AS DOUBLE) AS hours_since FROM events GROUP BY CAST(ts AS DATE))
    SELECT *, new_events >= 340 OR drift_score >= 0.21 OR hours_since >= 48 AS retrain,
           CASE WHEN new_events >= 340 THEN 'events' WHEN drift_score >= 0.21 THEN 'drift' WHEN hours_since >= 48 THEN 'hours'
                ELSE 'Conditions not met' END AS reason FROM s""")
def retrain_decision(spark, root):
    day = F.to_date("ts")
    stats = table(spark, root, "events").groupBy(day.alias("d")).agg(
        F.count("*").alias("new_events"),
        F.round(F.count_if(F.col("event_type") == "error") / F.count("*"), 6).alias("drift_score"))
    stats = stats.select(F.col("d").cast("string").alias("day"), "new_events", "drift_score",
                         ((F.dayofmonth("d") % 3) * 24).cast("double").alias("hours_since"))
    return mo.retrain_decision(stats, mo.RetrainRule(340, 0.21, 48.0))
