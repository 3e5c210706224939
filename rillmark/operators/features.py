"""Batch features: users, items, pairs, roll-ups, summaries and mergeable state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.functions.columns import hours_since, is_type, json_field, micros, safe_ratio
from rillmark.operators.scale import top_per_group
from rillmark.session import checkpointed

# Fixed value: how many favourite categories a user row keeps.
TOP_CATEGORIES = 3


def category_counts(df: DataFrame) -> DataFrame:
    """Events per user and category; events without a category are left out."""
    return (
        df.where(F.col("metadata").isNotNull())
        .select("user_id", json_field("metadata", "category").alias("category"))
        .where(F.col("category").isNotNull())
        .groupBy("user_id", "category").agg(F.count("*").alias("n"))
    )


def favorite_categories(df: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """The ``top`` most frequent categories of each user, ties by name, as an array in rank order."""
    return _favourites(category_counts(df), top)


def _favourites(counts: DataFrame, top: int) -> DataFrame:
    ranked = top_per_group(counts, ["user_id"], [F.desc("n"), F.asc("category")], top)
    # At most `top` rows per user reach the list.
    listed = F.array_sort(F.collect_list(F.struct("rank", "category")))
    return ranked.groupBy("user_id").agg(listed.alias("l")).select(
        "user_id", F.transform("l", lambda s: s["category"]).alias("favorite_categories")
    )


def user_features(df: DataFrame, top_categories: int = TOP_CATEGORIES) -> DataFrame:
    """Activity counts, mean rating, active days, favourite categories and last activity per user.

    Events are first combined by (user, day, category), which the activity and the categories are both taken from: the log is read
    once, a distinct count of days becomes a count of groups, and a very active user is spread over days and categories.
    """
    category = F.when(F.col("metadata").isNotNull(), json_field("metadata", "category")).alias("category")
    base = df.groupBy("user_id", F.to_date("timestamp").alias("day"), category).agg(
        F.count("*").alias("n"),
        F.count_if(is_type("click")).alias("clicks"),
        F.count_if(is_type("view")).alias("views"),
        F.count_if(is_type("rating")).alias("ratings"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.max("timestamp").alias("last"),
    )
    base = checkpointed(base, "user-days")  # each branch needs other columns of it, so a plan would read the log for both
    sums = ("n", "clicks", "views", "ratings", "rating_sum", "rating_n")
    daily = base.groupBy("user_id", "day").agg(*[F.sum(c).alias(c) for c in sums], F.max("last").alias("last"))
    per_user = daily.groupBy("user_id").agg(
        F.sum("n").alias("total_interactions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("views").alias("total_views"),
        F.sum("ratings").alias("total_ratings"),
        (F.sum("rating_sum") / F.nullif(F.sum("rating_n"), F.lit(0))).alias("avg_rating_given"),
        F.count("day").alias("interaction_days"),
        F.max("last").alias("last_active_timestamp"),
    )
    liked = base.where(F.col("category").isNotNull()).groupBy("user_id", "category").agg(F.sum("n").alias("n"))
    return per_user.join(_favourites(liked, top_categories), "user_id", "left")


def item_features(df: DataFrame) -> DataFrame:
    """Views, clicks, click-through rate, ratings, main category and first sighting per item, in one scan."""
    parts = df.select(
        "item_id", "event_type", "rating", "timestamp", json_field("metadata", "category").alias("category")
    ).groupBy("item_id", "category").agg(
        F.count_if(is_type("view")).alias("views"),
        F.count_if(is_type("click")).alias("clicks"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.count("*").alias("n"),
        F.min("timestamp").alias("first"),
    )
    main = F.when(F.col("category").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("category").alias("c")))
    return parts.groupBy("item_id").agg(
        F.sum("views").alias("total_views"),
        F.sum("clicks").alias("total_clicks"),
        (F.sum("rating_sum") / F.nullif(F.sum("rating_n"), F.lit(0))).alias("avg_rating_received"),
        F.sum("rating_n").alias("rating_count"),
        F.min(main).alias("main"),
        F.min("first").alias("created_timestamp"),
    ).select(
        "item_id", "total_views", "total_clicks",
        safe_ratio("total_clicks", "total_views").alias("click_through_rate"),
        "avg_rating_received", "rating_count", F.col("main.c").alias("category"), "created_timestamp",
    )


# Order of event kinds at equal times: the stronger signal is the newer one. Fixed values.
_SIGNAL = ("view", "click", "rating")


def pair_features(df: DataFrame, as_of) -> DataFrame:
    """Count, mean rating, newest event kind and hours since it, per user and item.

    Newest time and kind travel in one long (time * 4 + kind), so the whole thing is a single hash aggregation with
    fixed-width buffers: no window, no join, no sort.
    """
    code = F.lit(0)
    for i, name in enumerate(_SIGNAL):
        code = F.when(is_type(name), i + 1).otherwise(code)
    grouped = df.groupBy("user_id", "item_id").agg(
        F.count("*").alias("interaction_count"),
        F.avg("rating").alias("user_item_rating"),
        F.max(micros("timestamp") * 4 + code).alias("_newest"),
    )
    kind = F.element_at(F.array(F.lit("other"), *[F.lit(s) for s in _SIGNAL]), F.pmod(F.col("_newest"), F.lit(4)).cast("int") + 1)
    last = F.timestamp_micros(F.shiftright("_newest", 2))  # rounds down before 1970 too, and stays a whole number
    return grouped.select(
        "user_id", "item_id", "interaction_count",
        kind.alias("last_interaction_type"),
        hours_since(last, as_of).alias("time_since_last_interaction"),
        "user_item_rating",
    )


def hourly_pairs(df: DataFrame) -> DataFrame:
    """One-hour tumbling aggregate per pair: the batch twin of the stream, with (sum, n) kept for exact merging."""
    return df.groupBy(F.window("timestamp", "1 hour").alias("w"), "user_id", "item_id").agg(
        F.count("*").alias("interaction_count_1h"),
        F.max("timestamp").alias("last_event_time"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
    ).select(
        "user_id", "item_id", "interaction_count_1h", "last_event_time", "rating_sum", "rating_n",
        (F.col("rating_sum") / F.nullif(F.col("rating_n"), F.lit(0))).alias("avg_rating"),
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
    )


def user_sliding(df: DataFrame, window: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    """Sliding-window event count and mean rating per user; events are first combined per user and slide."""
    base = df.groupBy("user_id", F.window("timestamp", slide).alias("s")).agg(
        F.count("*").alias("n"), F.sum("rating").alias("rs"), F.count("rating").alias("rn"),
        F.max("timestamp").alias("last"),
    ).select("user_id", F.col("s.start").alias("at"), "n", "rs", "rn", "last")
    return base.groupBy("user_id", F.window("at", window, slide).alias("w")).agg(
        F.sum("n").alias("event_count"),
        (F.sum("rs") / F.nullif(F.sum("rn"), F.lit(0))).alias("avg_rating"),
        F.max("last").alias("last_event_time"),
    ).select(
        "user_id", "event_count", "avg_rating", "last_event_time",
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
    )


def item_hourly(df: DataFrame) -> DataFrame:
    """Events per item and hour."""
    return df.groupBy("item_id", F.window("timestamp", "1 hour").alias("w")).agg(
        F.count("*").alias("item_popularity_1h")
    ).select("item_id", "item_popularity_1h", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def rollup_hourly(hourly: DataFrame) -> DataFrame:
    """Hourly pair rows rolled up per pair; the mean rating is weighted by the number of ratings."""
    by_item_hour = hourly.groupBy("item_id", "window_start").agg(F.sum("interaction_count_1h").alias("n"))
    item_total = by_item_hour.groupBy("item_id").agg(F.sum("n").alias("total_item_interactions"))
    pairs = hourly.groupBy("user_id", "item_id").agg(
        F.sum("interaction_count_1h").alias("total_user_interactions"),
        F.max("last_event_time").alias("last_interaction_time"),
        (F.sum("rating_sum") / F.nullif(F.sum("rating_n"), F.lit(0))).alias("avg_rating"),
    )
    return pairs.join(item_total, "item_id", "left")


def user_frequency(df: DataFrame) -> DataFrame:
    """Events per active day of each user."""
    daily = df.groupBy("user_id", F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"))
    return daily.groupBy("user_id").agg(
        F.sum("n").alias("events"), F.count("*").alias("active_days"),
        (F.sum("n") / F.count("*")).alias("events_per_day"),
    )


def daily_summary(df: DataFrame) -> DataFrame:
    """Events, active users and events by kind per day, counted through (day, user) partial rows."""
    per_user = df.groupBy(F.to_date("timestamp").alias("day"), "user_id").agg(
        F.count("*").alias("n"), F.count_if(is_type("view")).alias("views"),
        F.count_if(is_type("click")).alias("clicks"), F.count_if(is_type("rating")).alias("ratings"),
    )
    return per_user.groupBy("day").agg(
        F.sum("n").alias("events"), F.count("*").alias("active_users"), F.sum("views").alias("views"),
        F.sum("clicks").alias("clicks"), F.sum("ratings").alias("ratings"),
    )


def event_report(checked: DataFrame) -> DataFrame:
    """Totals, distinct users and items, and the share of each kind of event, as (metric, value) rows.

    ``checked`` has events with a column ``valid``. It is read once: every event gives a row for its user, item, type and verdict,
    which are counted together. The mergeable form with estimated distinct counts is in ``sketches``.
    """
    ok = F.col("valid")

    def seen(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))

    each = F.array(seen("verdict", ok), *[F.when(ok, seen(c, F.col(c))) for c in ("user_id", "item_id", "event_type")])
    counts = checked.select(F.explode(F.array_compact(each)).alias("s")).groupBy("s.kind", "s.value").agg(F.count("*").alias("n"))

    def total(when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("double")

    kind = F.col("kind")
    types = F.collect_list(F.when(kind == "event_type", F.struct("value", "n")))  # one entry per valid type
    one = counts.groupBy().agg(
        total(kind == "verdict").alias("received"), total((kind == "verdict") & (F.col("value") == "true")).alias("valid"),
        total((kind == "verdict") & (F.col("value") == "false")).alias("invalid"),
        *[F.count_if((kind == c) & F.col("value").isNotNull()).cast("double").alias(f"unique_{c}") for c in ("user_id", "item_id")],
        types.alias("types"))

    def row(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metric"), value.cast("double").alias("value"))

    fixed = F.array(*[row(F.lit(c), F.col(c)) for c in ("received", "valid", "invalid", "unique_user_id", "unique_item_id")])
    by_type = F.flatten(F.transform("types", lambda t: F.array(
        row(F.concat(F.lit("count_"), t["value"]), t["n"]),
        row(F.concat(F.lit("share_"), t["value"]), t["n"] * F.lit(100.0) / F.col("received")))))
    return one.select(F.inline(F.concat(fixed, by_type)))


def entity_state(df: DataFrame, key: str, rating_default: float | None = None) -> DataFrame:
    """Mergeable running state per user or item: event count, rating (sum, n), views, clicks and last event time.

    With ``rating_default`` an event without a rating counts as that rating.
    """
    rating = F.col("rating") if rating_default is None else F.coalesce("rating", F.lit(float(rating_default)))
    return df.groupBy(key).agg(
        F.count("*").alias("interaction_count"),
        F.sum(rating).alias("rating_sum"), F.count(rating).alias("rating_n"),
        F.count_if(is_type("view")).alias("views"), F.count_if(is_type("click")).alias("clicks"),
        F.max("timestamp").alias("last_active_timestamp"),
    )


_ADD = ("interaction_count", "rating_sum", "rating_n", "views", "clicks")


def merge_state(old: DataFrame, batch: DataFrame, key: str, rating_default: float | None = None) -> DataFrame:
    """Old state plus a batch of events. Sums and maxima merge exactly, in any order."""
    new = entity_state(batch, key, rating_default)
    return old.select(*new.columns).unionByName(new).groupBy(key).agg(
        *[F.sum(c).alias(c) for c in _ADD], F.max("last_active_timestamp").alias("last_active_timestamp")
    )


def state_view(state: DataFrame, key: str) -> DataFrame:
    """State as features: running mean rating and click-through rate."""
    return state.select(
        key, "interaction_count",
        (F.col("rating_sum") / F.nullif(F.col("rating_n"), F.lit(0))).alias("running_avg_rating"),
        "views", "clicks", safe_ratio("clicks", "views").alias("click_through_rate"), "last_active_timestamp",
    )


def impute(df: DataFrame, cols: list[str], value=0) -> DataFrame:
    return df.na.fill(value, subset=cols)


def item_popularity(df: DataFrame) -> DataFrame:
    return df.groupBy("item_id").agg(F.count("*").alias("popularity"))


def hours_column(df: DataFrame, as_of, ts: str = "timestamp", out: str = "hours") -> DataFrame:
    return df.withColumn(out, hours_since(ts, as_of))


def rating_or(default: float) -> Column:
    return F.coalesce("rating", F.lit(float(default)))
