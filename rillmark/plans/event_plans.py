"""Queries over event records: scanning, decoding, validating, de-duplicating, retaining."""

from pyspark.sql import functions as F

from rillmark.functions.columns import event_time
from rillmark.operators import events as ev
from rillmark.plans.registry import query, with_views
from rillmark.sources.adapters import item_categories, order_events, raw_events, table
from rillmark.sources.store import scan_events

# Fixed time every "as of" query refers to; just after the event log ends.
AS_OF = "2024-02-01 00:00:00"


def valid_events(spark, root):
    return ev.validate_events(raw_events(spark, root))[0]


@query("scan_events", """
    SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'""")
def scan_events_query(spark, root):
    df = scan_events(spark, f"{root}/events.parquet", "2024-01-10", "2024-01-20", ts="ts")
    return df.select("event_id", "ts", "user_id", "event_type", "value")


@query("json_roundtrip", with_views("raw", """
    SELECT event_id, user_id, item_id, event_type, rating, ts AS "timestamp", category FROM raw"""))
def json_roundtrip(spark, root):
    back = ev.normalise_events(ev.decode(ev.encode(raw_events(spark, root))))
    return back.select("event_id", "user_id", "item_id", "event_type", "rating", "timestamp",
                       F.get_json_object("metadata", "$.category").alias("category"))


@query("parse_ts", """
    SELECT event_id, TRY_CAST(CASE event_type WHEN 'error' THEN 'not a time' ELSE
        strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS TIMESTAMP) AS parsed FROM events""")
def parse_ts(spark, root):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, root, "events").select("event_id", event_time(text).alias("parsed"))


@query("normalise_events", """
    SELECT sha256(concat_ws(':', 'user_' || user_id, 'item_' || json_extract_string(props, '$.k'), event_type, '',
                            strftime(ts, '%Y-%m-%dT%H:%M:%S'), props)) AS event_id,
           'user_' || user_id AS user_id, 'item_' || json_extract_string(props, '$.k') AS item_id, event_type,
           date_trunc('second', ts) AS "timestamp", props AS metadata
    FROM events""")
def normalise_events(spark, root):
    sent = table(spark, root, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("item_"), F.get_json_object("props", "$.k")).alias("item_id"),
        "event_type", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("received_at"),
        F.col("props").alias("context"),
    )
    return ev.normalise_events(sent).select("event_id", "user_id", "item_id", "event_type", "timestamp", "metadata")


@query("validate_events", with_views("ev", """
    SELECT event_id, user_id, item_id, event_type, rating, ts AS "timestamp" FROM ev"""))
def validate_events(spark, root):
    return valid_events(spark, root).select("event_id", "user_id", "item_id", "event_type", "rating", "timestamp")


# Order lines with values broken on purpose: the quantity stands in for a rating on every kind of event.
@query("rejected_events", """
    WITH b AS (
      SELECT l_orderkey, l_linenumber, l_extendedprice,
             CASE WHEN l_linenumber = 7 THEN '' ELSE 'user_' || l_suppkey END AS user_id,
             CASE l_returnflag WHEN 'N' THEN 'view' WHEN 'A' THEN 'share' ELSE 'rating' END AS event_type,
             CASE WHEN l_linestatus = 'O' THEN l_quantity / 10 END AS rating
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_extendedprice, reasons FROM (
      SELECT *, concat_ws(',',
        CASE WHEN user_id = '' THEN 'user_id_empty' END,
        CASE WHEN event_type = 'share' THEN 'event_type_unknown' END,
        CASE WHEN event_type = 'rating' AND rating IS NULL THEN 'rating_missing' END,
        CASE WHEN event_type <> 'rating' AND rating IS NOT NULL THEN 'rating_unexpected' END,
        CASE WHEN rating < 1 OR rating > 5 THEN 'rating_out_of_range' END) AS reasons
      FROM b) WHERE reasons <> ''""")
def rejected_events(spark, root):
    broken = table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_linenumber") == 7, "").otherwise(
            F.concat(F.lit("user_"), F.col("l_suppkey").cast("string"))).alias("user_id"),
        F.concat(F.lit("item_"), F.col("l_partkey").cast("string")).alias("item_id"),
        F.when(F.col("l_returnflag") == "N", "view").when(F.col("l_returnflag") == "A", "share")
        .otherwise("rating").alias("event_type"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity") / 10).alias("rating"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
    rejected = ev.validate_events(broken)[1]
    return rejected.select("l_orderkey", "l_linenumber", "l_extendedprice", F.array_join("reasons", ",").alias("reasons"))


@query("dedup_events", with_views("raw", """
    SELECT event_id, user_id, item_id, event_type, ts AS "timestamp" FROM raw"""))
def dedup_events(spark, root):
    first = raw_events(spark, root)
    # At-least-once delivery: every event arrives a second time, later.
    again = first.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 5 MINUTES"))
    return ev.dedup_events(first.unionByName(again)).select("event_id", "user_id", "item_id", "event_type", "timestamp")


@query("retained_events", """
    SELECT event_id, ts AS "timestamp" FROM events
    WHERE ts > TIMESTAMP '2024-02-01' - INTERVAL 7 DAYS AND ts <= TIMESTAMP '2024-02-01'""")
def retained_events(spark, root):
    df = table(spark, root, "events").select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    return ev.retain(df, AS_OF, 7)


def served_records(spark, root):
    """Served lists from the event log: every view or signup was answered with five consecutive items."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    items = F.transform(F.sequence(F.lit(0), F.lit(4)),
                        lambda j: F.concat(F.lit("item_"), ((k + j) % 100).cast("string")))
    return table(spark, root, "events").where(F.col("event_type").isin("view", "signup")).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        items.alias("recommended_items"),
        F.lit("v1").alias("model_version"),
        F.when(F.col("user_id") % 2 == 0, "control").otherwise("treatment").alias("experiment_group"),
        F.lit("exp_1").alias("experiment_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("value").alias("latency_ms"),
    )


@query("explode_served", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, 'user_' || user_id AS user_id,
           'item_' || ((CAST(json_extract_string(props, '$.k') AS BIGINT) + j) % 100) AS item_id,
           CAST(j + 1 AS BIGINT) AS rank, CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'treatment' END AS experiment_group,
           date_trunc('second', ts) AS "timestamp", value AS latency_ms
    FROM events, range(5) t(j) WHERE event_type IN ('view', 'signup')""")
def explode_served(spark, root):
    out = ev.explode_served(ev.encode(served_records(spark, root)))
    return out.select("event_id", "user_id", "item_id", F.col("rank").cast("bigint").alias("rank"), "experiment_group",
                      "timestamp", "latency_ms")


def catalogue(spark, root):
    return item_categories(spark, root)


def order_interactions(spark, root):
    return ev.validate_events(order_events(spark, root))[0]
