"""Interaction events from plain tables (an event log, or order lines), so the operators can run on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def raw_events(spark: SparkSession, root: str) -> DataFrame:
    """The event log in the event layout; types outside the contract are kept for validation to reject."""
    k = F.get_json_object("props", "$.k")
    kind = F.when(F.col("event_type") == "purchase", "rating").otherwise(F.col("event_type"))
    rating = F.when(F.col("event_type") == "purchase", F.lit(1.0) + F.lit(0.5) * (F.col("event_id") % 9))
    return table(spark, root, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("item_"), k).alias("item_id"),
        kind.alias("event_type"),
        rating.alias("rating"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(F.struct(F.concat(F.lit("cat_"), (k.cast("bigint") % 10).cast("string")).alias("category")))
        .alias("metadata"),
    )


def order_events(spark: SparkSession, root: str) -> DataFrame:
    """Order lines in the event layout: customer = user, part = item, return flag = kind of event."""
    lines = table(spark, root, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, root, "part").select("p_partkey", "p_type", "p_brand")
    kind = F.when(F.col("l_returnflag") == "N", "view").when(F.col("l_returnflag") == "A", "click").otherwise("rating")
    rating = F.when(F.col("l_returnflag") == "R", F.lit(1.0) + F.lit(0.5) * (F.col("l_quantity").cast("int") % 9))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.hex(F.xxhash64(*lines.columns)).alias("event_id"),
            F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
            F.concat(F.lit("item_"), F.col("l_partkey").cast("string")).alias("item_id"),
            kind.alias("event_type"),
            rating.alias("rating"),
            F.col("l_shipdate").cast("timestamp").alias("timestamp"),
            F.to_json(F.struct(F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))).alias("metadata"),
        )
    )


def item_categories(spark: SparkSession, root: str) -> DataFrame:
    """Category array per item, from the parts table."""
    return table(spark, root, "part").select(
        F.concat(F.lit("item_"), F.col("p_partkey").cast("string")).alias("item_id"),
        F.array("p_type", "p_brand").alias("categories"),
    )


def item_factors(spark: SparkSession, root: str) -> DataFrame:
    """Latent factors per item, from the embeddings table."""
    return table(spark, root, "embeddings").select(
        F.concat(F.lit("item_"), F.col("vec_id").cast("string")).alias("item_id"),
        F.col("embedding").alias("features"),
    )
