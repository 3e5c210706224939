"""Slowly changing rows: new profiles, partial updates, merged preferences and paged listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.session import checkpointed

def new_profiles(incoming: DataFrame, existing: DataFrame, order: Sequence[str] = (), keys: Sequence[str] = ("username", "email"),
                 ) -> DataFrame:
    """Incoming profiles that get all of their ``keys``, first come, first served: the same rows as taking requests one by one.

    A request is refused if an existing profile or an accepted earlier request holds one of its keys; a refused request takes nothing.
    Earlier means smaller in ``order``, then in the other columns; of equal requests one is taken. A null key is always free.

    What exists already goes by anti joins. Then rounds: a request that is the first of all open ones for each of its keys is
    accepted, since no earlier one can take them; its rivals go, and so on until none is open. A round is one minimum per key
    with partial aggregation, a join of the minima, and anti joins, so a name that a third of all requests want is one row per task.
    """
    columns = incoming.columns
    names = [*order, *[c for c in columns if c not in order]]
    for c in keys:
        incoming = incoming.join(existing.select(c).where(F.col(c).isNotNull()), c, "left_anti")
    open_ = checkpointed(incoming.select(*keys, F.struct(*names).alias("_r")), "requests")
    accepted = None
    while open_.limit(1).count():
        first = None
        for c in keys:
            least = open_.where(F.col(c).isNotNull()).groupBy(c).agg(F.min("_r").alias("_r")).select("_r")
            least = least.unionAll(open_.where(F.col(c).isNull()).select("_r")).distinct()
            first = least if first is None else first.join(least, "_r")
        won = checkpointed(first.select("_r", *[F.col(f"_r.{c}").alias(c) for c in keys]), "accepted")
        accepted = won if accepted is None else accepted.unionAll(won)
        for c in keys:
            open_ = open_.join(won.select(c).where(F.col(c).isNotNull()), c, "left_anti")
        open_ = open_.join(won.select("_r"), "_r", "left_anti")  # one whose keys are null is no rival of itself
        open_ = checkpointed(open_.select(*keys, "_r"), "requests")
    rows = open_.select("_r") if accepted is None else accepted.select("_r")
    return rows.select(*[F.col(f"_r.{c}").alias(c) for c in columns])


def upsert(base: DataFrame, updates: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Apply partial updates: per column the newest value that is set, else the base value.

    One aggregation by key; updates combine before the shuffle, so a row updated very often stays cheap.
    """
    values = [c for c in base.columns if c != key]
    first = base.select(key, *values, F.lit(0).alias("_set"), *[F.lit(None).alias(o) for o in order])
    both = first.unionByName(updates.withColumn("_set", F.lit(1)), allowMissingColumns=True)
    rank = F.struct("_set", *order)
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in values]
    return both.groupBy(key).agg(*newest)


def merge_preferences(updates: DataFrame, order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Ordered preference updates (user_id, preferences map) folded to one row per user and preference, later wins."""
    entries = updates.select("user_id", *order, F.explode("preferences").alias("name", "value"))
    return entries.groupBy("user_id", "name").agg(F.max_by("value", F.struct(*order)).alias("value"))


def preference_maps(merged: DataFrame) -> DataFrame:
    """Merged preferences as one map per user, the form a profile record holds."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value"))))
    return merged.groupBy("user_id").agg(entries.alias("preferences"))


def page(df: DataFrame, order_by: Sequence[str], skip: int, limit: int) -> DataFrame:
    """One page of a listing in a fixed order."""
    return df.orderBy(*order_by).offset(skip).limit(limit)
