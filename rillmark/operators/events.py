"""Event records: decoding, normalising, validating, de-duplicating and retaining."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.columns import event_time, sha_hex
from rillmark.operators.scale import top_per_group
from rillmark.schemas import EVENT, EVENT_JSON, SERVED_JSON

# Event types of the topic contract and the rating range.
EVENT_TYPES = ("view", "click", "rating")
RATING_MIN, RATING_MAX = 1.0, 5.0
# ISO 8601 with microseconds, so that a time survives the round trip through JSON.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def decode(df: DataFrame, schema: T.StructType = EVENT_JSON, value: str = "value") -> DataFrame:
    """Topic payload (JSON bytes or text) to columns; a payload that is no JSON object gives nulls."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("r")).select("r.*")


def encode(df: DataFrame, key: str = "user_id", value: str = "value") -> DataFrame:
    """Columns to (key, value) rows; the key keeps each user's events in order in a keyed topic."""
    body = F.to_json(F.struct(*df.columns), {"timestampFormat": TIME_FORMAT})
    return df.select(F.col(key).cast("string").alias("key"), body.alias(value))


def normalise_events(df: DataFrame) -> DataFrame:
    """Bring both producer shapes to the event layout.

    A missing id becomes the hash of the content, so that a replay yields the same id. Times that cannot be read
    stay null and are rejected with a reason by :func:`validate_events`.
    """
    have = set(df.columns)

    def first_of(*names: str) -> Column:
        found = [F.col(n) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None)

    text_time = first_of("timestamp", "received_at").cast("string")
    meta = first_of("metadata", "context").cast("string")
    content = [first_of(n).cast("string") for n in ("user_id", "item_id", "event_type", "rating")]
    ident = sha_hex(*[F.coalesce(c, F.lit("")) for c in (*content, text_time, meta)])
    ts = F.col("timestamp") if isinstance(_type_of(df, "timestamp"), T.TimestampType) else event_time(text_time)
    return df.select(
        F.coalesce(first_of("event_id").cast("string"), ident).alias("event_id"),
        F.col("user_id"), F.col("item_id"), F.col("event_type"),
        first_of("rating").cast("double").alias("rating"),
        ts.alias("timestamp"), meta.alias("metadata"),
    )


def _type_of(df: DataFrame, name: str):
    return df.schema[name].dataType if name in df.columns else None


def _broken_rules() -> dict[str, Column]:
    """Rule name -> condition that is true (never null) when the event breaks it."""
    def blank(name: str) -> Column:
        return F.coalesce(F.length(F.col(name)) == 0, F.lit(True))

    kind, rating = F.col("event_type"), F.col("rating")
    is_rating = F.coalesce(kind == "rating", F.lit(False))
    return {
        "user_id_empty": blank("user_id"),
        "item_id_empty": blank("item_id"),
        "event_type_unknown": ~F.coalesce(kind.isin(*EVENT_TYPES), F.lit(False)),
        "rating_missing": is_rating & rating.isNull(),
        "rating_unexpected": ~is_rating & rating.isNotNull(),
        "rating_out_of_range": rating.isNotNull() & ~rating.between(RATING_MIN, RATING_MAX),
        "timestamp_missing": F.col("timestamp").isNull(),
    }


def rejection_reasons() -> Column:
    """Array of the rules an event breaks; empty for a valid event."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in _broken_rules().items()]))


def is_rejected() -> Column:
    """True when any rule is broken: a plain condition that compiles into the scan's code."""
    return reduce(or_, _broken_rules().values())


def validate_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, rejected); rejected rows carry ``reasons``, which are built for those rows only."""
    return df.where(~is_rejected()), df.where(is_rejected()).withColumn("reasons", rejection_reasons())


def validate_served(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split served-recommendation records by the same kind of rules."""
    rules = {
        "user_id_empty": F.coalesce(F.length("user_id") == 0, F.lit(True)),
        "no_items": F.coalesce(F.size("recommended_items") <= 0, F.lit(True)),
        "model_version_missing": F.col("model_version").isNull(),
        "latency_negative": F.coalesce(F.col("latency_ms") < 0, F.lit(False)),
    }
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    checked = df.withColumn("reasons", reasons)
    return checked.where(F.size("reasons") == 0).drop("reasons"), checked.where(F.size("reasons") > 0)


def explode_served(df: DataFrame) -> DataFrame:
    """One row per served item with its 1-based rank. Takes decoded records or raw topic rows."""
    if "recommended_items" not in df.columns:
        df = decode(df, SERVED_JSON)
    served_at = df.schema["timestamp"].dataType
    ts = F.col("timestamp") if isinstance(served_at, T.TimestampType) else event_time("timestamp")
    return df.select(
        "event_id", "user_id", "model_version",
        F.coalesce("experiment_group", F.lit("control")).alias("experiment_group"), "experiment_id",
        ts.alias("timestamp"), F.coalesce("latency_ms", F.lit(0.0)).alias("latency_ms"),
        F.posexplode("recommended_items").alias("pos", "item_id"),
    ).select(
        "event_id", "user_id", "item_id", (F.col("pos") + 1).alias("rank"), "model_version", "experiment_group",
        "experiment_id", "timestamp", "latency_ms",
    )


def dedup_events(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keep the earliest delivery of every event id.

    The group limit runs before the shuffle, so an id repeated a billion times is sent once per map task.
    """
    order = [F.col("timestamp").asc_nulls_last(), F.xxhash64(*df.columns)]
    return top_per_group(df, [key], order, 1, "_rn").drop("_rn")


def retain(df: DataFrame, as_of, days: int = 7, ts: str = "timestamp") -> DataFrame:
    """Drop events older than the retention time and those after the as-of time; the filter reaches the scan."""
    at = F.lit(as_of).cast("timestamp")
    return df.where((F.col(ts) > at - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col(ts) <= at))


def to_event_layout(df: DataFrame) -> DataFrame:
    """Columns in the order and type of the event layout."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in EVENT.fields])
